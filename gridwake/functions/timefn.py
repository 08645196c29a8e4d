"""Time parsing and bucketing as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ALL_TIME_LABEL

LABEL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_dt(text) -> Column:
    """Parse ``y-M-d H:m:s`` or ``y-M-dTH:m:s``, fields padded or not, after
    cutting the text at its first ``.``; anything else, impossible dates
    included, gives null (rows are dropped by the caller, never raise)."""
    cut = F.substring_index(F.trim(_c(text).cast("string")), ".", 1)
    part = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?: +|T)(\d{1,2}):(\d{1,2}):(\d{1,2})$"

    def field(k: int) -> Column:
        return F.lpad(F.regexp_extract(cut, part, k), 2, "0")
    padded = F.concat(F.regexp_extract(cut, part, 1), F.lit("-"), field(2), F.lit("-"), field(3), F.lit(" "),
                      field(4), F.lit(":"), field(5), F.lit(":"), field(6))
    return F.when(cut.rlike(part), F.try_to_timestamp(padded, F.lit("yyyy-MM-dd HH:mm:ss")))


def bucket_start(ts, split: str) -> Column:
    """Start of the named time bucket as a timestamp.

    Names (case-insensitive): all, year, month, day, hour, 10min, minute;
    ``all`` maps every time to 9999-01-01 00:00:00; any other name leaves
    the timestamp as it is (whole seconds)."""
    ts = _c(ts)
    name = (split or "").lower()
    if name == "all":
        return F.when(ts.isNotNull(), F.make_timestamp(F.lit(9999), F.lit(1), F.lit(1),
                                                      F.lit(0), F.lit(0), F.lit(0)))
    if name in ("year", "month", "day", "hour", "minute"):
        return F.date_trunc(name, ts)
    if name == "10min":
        return F.date_trunc("hour", ts) + F.make_dt_interval(
            F.lit(0), F.lit(0), F.floor(F.minute(ts) / 10).cast("int") * 10, F.lit(0))
    return F.date_trunc("second", ts)


def temporal_bucket(ts, split: str) -> Column:
    """The named time bucket rendered as ``yyyy-MM-dd HH:mm:ss`` text."""
    if (split or "").lower() == "all":
        return F.when(_c(ts).isNotNull(), F.lit(ALL_TIME_LABEL))
    return F.date_format(bucket_start(ts, split), LABEL_FORMAT)


def format_ts(ts) -> Column:
    return F.date_format(_c(ts), LABEL_FORMAT)
