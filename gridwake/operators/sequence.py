"""Previous-row pairing that does not put a whole key into one task.

``Window.partitionBy(id)`` sends every row of an id to one task; an id that
holds a third of the data would then be sorted by a single core. So ids with
more than ``TARGET_ROWS`` rows are split into buckets of about that many
(equi-depth); all others are one bucket.

*Boundaries.* Rows are counted per id and hour. Runs of hours are put together
until a bucket is full. Hours that alone hold more are cut at quantiles of
``(dt, lat, lon)``, taken from a sample that a hash of the row decides: it can
be drawn in any order by any number of tasks, and rows of the same second are
told apart by their place. A row finds its bucket by an equi-join on (id,
hour) with one row per hour of a split id, and in cut hours by comparing it
with the few boundaries there.

*Pairing.* ``lag`` runs inside ``(id, bucket)`` and the first row of a bucket
takes the last row of the nearest earlier non-empty bucket from a small
per-bucket summary (one row per id and bucket, built with partial
aggregation). The summary is joined on ``(id, bucket)``, the same keys as the
window, so the large side is shuffled once: the rows are hash-partitioned on
``(id, bucket)`` a single time and the summary, the join and the window all
reuse that partitioning. Without split ids there is no summary and no forced
shuffle: a table stored in buckets by id is paired where it lies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import intermediate, release

BUCKET = "_bucket"


TARGET_ROWS = 2_000_000       # rows of a key that one task sorts at once
CELL_SECONDS = 3600
SAMPLES = 64                  # sampled rows per bucket of a cut cell
_CUTS = 1 << 24               # buckets that one cell may be cut into


def key_rows(points: DataFrame, key: str) -> tuple[int, int]:
    """Rows of the largest key and of all keys (one aggregate, two scalars
    back to the driver)."""
    top, total = (points.where(F.col(key).isNotNull()).groupBy(key).count()
                  .agg(F.max("count"), F.sum("count")).first())
    return top or 0, total or 0


def is_split(points: DataFrame, key: str, target_rows: int) -> bool:
    """Whether any key has more than ``target_rows`` rows."""
    return key_rows(points, key)[0] > target_rows


def spread(rows: DataFrame, total: int, task_rows: int, *by: str) -> DataFrame:
    """``rows`` partitioned by the columns ``by`` over one task per
    ``task_rows`` of ``total`` rows, and over all cores before that; one such
    lot stays as it is. For rows that multiply later on: Spark sizes the tasks
    of a shuffle by the bytes it moves, not by what is made of them."""
    tasks = math.ceil(total / task_rows)
    if tasks <= 1:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(tasks, min(cores, math.ceil(10 * total / task_rows))), *by)


def equi_depth(points: DataFrame, key: str, ts: str, order: Sequence[str], target_rows: int) -> DataFrame:
    """Add ``BUCKET``: buckets of about ``target_rows`` rows for keys that have
    more, ascending in ``order`` (which begins with ``ts``); 0 for the others
    and null without a time. Writes two small tables to the intermediate
    folder."""
    valid = points.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    cell = time_bucket(F.col(ts), CELL_SECONDS)
    whole = Window.partitionBy(key)
    before = F.sum("_n").over(whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = intermediate(
        valid.groupBy(key, cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_rows)))
        .withColumn("_all", F.sum("_n").over(whole)).where(F.col("_all") > target_rows).drop("_all"), "bucket-cells")

    # rows of cut cells, about ``samples`` per bucket, and every so-many-th of them in order
    row = F.struct(*[F.col(c) for c in order])
    samples = min(SAMPLES, target_rows)
    drawn = F.pmod(F.xxhash64(key, *order), F.lit(target_rows)) < samples
    sample = (valid.where(drawn).select(key, cell.alias("_cell"), row.alias("_row"))
              .join(cells.where(F.col("_n") > target_rows).select(key, "_cell"), [key, "_cell"]))
    turn = F.row_number().over(Window.partitionBy(key, "_cell").orderBy("_row"))
    cuts = (sample.withColumn("_turn", turn).where(F.col("_turn") % samples == 0)
            .groupBy(key, "_cell").agg(F.sort_array(F.collect_set("_row")).alias("_cuts")))
    lookup = intermediate(cells.join(cuts, [key, "_cell"], "left").select(key, "_cell", "_base", "_cuts"), "bucket-cuts")
    release(cells)

    passed = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= row)), F.lit(0))
    found = F.coalesce(F.col("_base") * _CUTS + F.when(F.col("_cuts").isNull(), 0).otherwise(passed), F.lit(0))
    return (points.withColumn("_cell", cell).join(lookup, [key, "_cell"], "left")
            .withColumn(BUCKET, F.when(F.col(ts).isNotNull(), found.cast("long")))
            .drop("_cell", "_base", "_cuts"))


def time_bucket(ts_col: Column, split_seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts_col) / F.lit(int(split_seconds)))


def partition_by_bucket(df: DataFrame, key: str, bucket: Column) -> DataFrame:
    """Add ``BUCKET`` and hash-partition on ``(key, BUCKET)`` (one shuffle).

    Rows without a key or bucket belong to no track and are dropped here; the
    explicit predicate also keeps both consumers of the exchange identical,
    so Spark reuses it instead of scanning the input twice."""
    return (df.withColumn(BUCKET, bucket)
            .where(F.col(key).isNotNull() & F.col(BUCKET).isNotNull())
            .repartition(key, BUCKET))


def with_previous(df: DataFrame, key: str, order: Sequence[str], carry: Sequence[str],
                  bucket: Column, prev_name: str = "prev") -> DataFrame:
    """Add a struct column ``prev_name`` holding ``order + carry`` fields of the
    previous row of the same ``key`` in ``order`` (ascending, nulls first),
    or null for the first row of the key. Also adds ``BUCKET``.

    ``order`` must identify a row's place uniquely up to identical rows.
    """
    fields = list(dict.fromkeys([*order, *carry]))
    d = partition_by_bucket(df, key, bucket)
    row = F.struct(*[F.col(c) for c in fields])

    # one row per (key, bucket): its last row; struct ordering = order columns first
    last = d.groupBy(key, BUCKET).agg(F.max(row).alias("_last"))
    wb = Window.partitionBy(key).orderBy(BUCKET)
    carry_in = last.select(key, BUCKET, F.lag("_last").over(wb).alias("_carry"))

    w = Window.partitionBy(key, BUCKET).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    joined = d.join(carry_in, [key, BUCKET], "left")
    return (joined
            .withColumn(prev_name, F.coalesce(F.lag(row).over(w), F.col("_carry")))
            .drop("_carry"))


def with_previous_whole(df: DataFrame, key: str, order: Sequence[str], prev_name: str = "prev") -> DataFrame:
    """``with_previous`` for keys that are one bucket each. Asks for nothing
    but rows together by key and sorted, which a stored layout may provide."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (df.where(F.col(key).isNotNull())
            .withColumn(prev_name, F.lag(F.struct(*[F.col(c) for c in order])).over(w)))


def with_previous_within(df: DataFrame, key: str, order: Sequence[str], ts: Column,
                         split_seconds: int, horizon_seconds: float,
                         prev_name: str = "prev") -> DataFrame:
    """Previous row of the same key, for rows whose predecessor matters only
    when it is at most ``horizon_seconds`` earlier (``horizon <= split``).

    Each row lying within the horizon of the next bucket's start is also
    emitted, marked as a copy, into that bucket (one ``explode``, no second
    scan). The window over ``(key, bucket)`` then sees a bucket's own rows
    preceded by the previous bucket's tail, so ``lag`` is exact whenever the
    true predecessor is within the horizon, and null (or a row beyond the
    horizon) otherwise. One shuffle and one sort; no summary, no join.
    Copies are dropped from the result."""
    if horizon_seconds > split_seconds:
        raise ValueError("horizon must not exceed the bucket width")
    fields = list(dict.fromkeys(order))
    secs = F.unix_timestamp(ts) if not isinstance(ts, str) else F.unix_timestamp(F.col(ts))
    b = F.floor(secs / F.lit(int(split_seconds)))
    reach = int(math.ceil(horizon_seconds))
    near_end = secs >= (b + 1) * int(split_seconds) - reach
    offsets = F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = (df.select("*", b.alias("_b0"), F.explode(offsets).alias("_copy"))
         .withColumn(BUCKET, F.col("_b0") + F.col("_copy"))
         .where(F.col(key).isNotNull() & F.col(BUCKET).isNotNull())
         .repartition(key, BUCKET))
    row = F.struct(*[F.col(c) for c in fields])
    w = Window.partitionBy(key, BUCKET).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (d.withColumn(prev_name, F.lag(row).over(w))
            .where(F.col("_copy") == 0)
            .drop("_b0", "_copy"))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``idx`` (place from 0 among the rows of equal ``keys``, by
    ``order``, nulls first) and ``n`` (how many there are).

    The rows are sorted by range over all tasks, so a key that holds most of
    them is numbered by many tasks; each partition's share of a key is counted
    and the shares before it are added up. ``rows`` is a written table."""
    keys, order = list(keys), list(order)
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())     # splits rows repeated very often
    by = [*[F.col(c).asc_nulls_first() for c in [*keys, *order]], F.col("_tie")]
    placed = intermediate(tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
                          .withColumn("_seq", F.monotonically_increasing_id()), "numbered-rows")
    placed = placed.withColumn("_part", F.shiftright("_seq", 33))
    # one row per partition and key
    starts = placed.groupBy(*keys, "_part").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(*keys)
    before = F.sum("_rows").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = intermediate(starts.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], "_part", "_first",
                                        F.coalesce(before, F.lit(0)).alias("_before"),
                                        F.sum("_rows").over(w).alias("n")), "numbered-starts")
    same = placed["_part"] == starts["_part"]
    for i, c in enumerate(keys):
        same = same & placed[c].eqNullSafe(starts[f"_key{i}"])
    return (placed.join(starts, same)
            .withColumn("idx", F.col("_seq") - F.col("_first") + F.col("_before"))
            .select(*rows.columns, "idx", "n"))
