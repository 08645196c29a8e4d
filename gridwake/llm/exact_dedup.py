"""Exact duplicates by counting quotient filters and byte verification.

1. One pass gives every row a 64-bit fingerprint and the SHA-256 of its text.
2. Every task builds a counting quotient filter of its fingerprints. A
   fingerprint is cut into *range* (top bits, which task merges it), quotient
   (which run of the filter) and remainder (stored, sorted within the run),
   with a counter beside each remainder. A copy only raises a counter, so a
   fingerprint that a third of all rows share travels once per task.
3. Filters of one range merge without loss: runs are interleaved by sorted
   remainder and counters of equal remainders added. The number of ranges
   follows the rows, so a merged filter holds about ``RANGE_ROWS`` entries.
4. Fingerprints with a count above one set their bit in a bitmap of at most
   ``BITMAP_BITS`` bits, each range its own stretch. Only texts whose bit is
   set leave the second scan. There equal bytes are one key of a
   pre-aggregated grouping, which decides; a shared bit or fingerprint alone
   makes nothing a copy.

Defined results: a null text counts as empty, so null, empty and repeated
texts are copies of each other as their bytes are. Very long texts are
handled whole (hashed in one piece, compared in full). Of equal texts the row
with the largest ``doc_id`` stays, a null id counting as the smallest; of
rows repeated with that id (a tie) exactly one stays. An empty table gives no
rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import arrow_rows, materialise, share, shared_value

RANGE_ROWS = 1 << 20       # rows a merged filter is meant for
MERGE_ROWS = 1 << 16
BITMAP_BITS = 1 << 26      # 8 MB
RUN_BITS = 2               # a filter has a run for every 4 rows it is meant for
_U = np.uint64


class CountingQuotientFilter:
    """Sorted multiset of 64-bit fingerprints that share their top
    ``range_bits`` bits. ``runs`` are the quotients in use, ``lengths[i]`` the
    number of remainders in run i, ``remainders`` the runs one after another,
    each sorted, and ``counts`` stand beside them."""

    __slots__ = ("range_bits", "quotient_bits", "runs", "lengths", "remainders", "counts")

    def __init__(self, range_bits: int, quotient_bits: int, runs: np.ndarray, lengths: np.ndarray,
                 remainders: np.ndarray, counts: np.ndarray):
        self.range_bits, self.quotient_bits = range_bits, quotient_bits
        self.runs, self.lengths, self.remainders, self.counts = runs, lengths, remainders, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, range_bits: int, quotient_bits: int) -> CountingQuotientFilter:
        """``fingerprints``: uint64 of one range, in any order, repeated or not."""
        below = fingerprints & _U((1 << (64 - range_bits)) - 1)
        unique, counts = np.unique(below, return_counts=True)
        return cls._laid_out(unique, counts.astype(np.int64), range_bits, quotient_bits)

    @classmethod
    def _laid_out(cls, below: np.ndarray, counts: np.ndarray, range_bits: int, quotient_bits: int
                  ) -> CountingQuotientFilter:
        rest = 64 - range_bits - quotient_bits
        quotient = (below >> _U(rest)).astype(np.uint32)
        start = np.flatnonzero(np.diff(quotient, prepend=-1, append=-1))
        return cls(range_bits, quotient_bits, quotient[start[:-1]], np.diff(start).astype(np.uint32),
                   below & _U((1 << rest) - 1), counts)

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """All multisets together, without loss: every run's remainders are
        sorted, so equal ones meet side by side and their counters add up."""
        below = np.concatenate([f.entries() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(below, kind="stable")      # a merge of sorted stretches
        below, counts = below[order], counts[order]
        start = np.flatnonzero(np.concatenate([[True], below[1:] != below[:-1]])) if len(below) else order
        return cls._laid_out(below[start], np.add.reduceat(counts, start) if len(start) else counts,
                             filters[0].range_bits, filters[0].quotient_bits)

    def _rest(self) -> int:
        return 64 - self.range_bits - self.quotient_bits

    def entries(self) -> np.ndarray:
        """The distinct fingerprints without the range's bits, ascending."""
        return np.repeat(self.runs, self.lengths).astype(_U) << _U(self._rest()) | self.remainders

    def repeated(self) -> np.ndarray:
        """Fingerprints (without the range's bits) with a count above one."""
        return self.entries()[self.counts > 1]

    def count(self, fingerprint: int) -> int:
        """How often ``fingerprint`` (of this range) was put in."""
        below = fingerprint & ((1 << (64 - self.range_bits)) - 1)
        run, remainder = below >> self._rest(), below & ((1 << self._rest()) - 1)
        i = int(np.searchsorted(self.runs, run))
        if i == len(self.runs) or self.runs[i] != run:
            return 0
        begin = int(self.lengths[:i].sum(dtype=np.int64))
        end = begin + int(self.lengths[i])
        at = begin + int(np.searchsorted(self.remainders[begin:end], _U(remainder)))
        return int(self.counts[at]) if at < end and int(self.remainders[at]) == remainder else 0

    def to_bytes(self) -> bytes:
        """Counters are stored only where they exceed one."""
        more = np.flatnonzero(self.counts > 1)
        head = np.array([self.range_bits, self.quotient_bits, len(self.remainders), len(more), len(self.runs)],
                        np.int64)
        return b"".join(x.tobytes() for x in (head, self.remainders, more, self.counts[more], self.runs,
                                              self.lengths))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        range_bits, quotient_bits, n, more, runs = np.frombuffer(raw, np.int64, 5).tolist()
        at = 40
        parts = []
        for kind, size in ((_U, n), (np.int64, more), (np.int64, more), (np.uint32, runs), (np.uint32, runs)):
            parts.append(np.frombuffer(raw, kind, size, at))
            at += parts[-1].nbytes
        counts = np.ones(n, np.int64)
        counts[parts[1]] = parts[2]
        return cls(range_bits, quotient_bits, parts[3], parts[4], parts[0], counts)


def _as_unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(_U)


def _build(range_bits: int, quotient_bits: int, rows: int):
    """One filter per range and ``rows`` fingerprints of a task."""
    def filters(parts: list[np.ndarray]) -> pa.RecordBatch:
        f = np.sort(np.concatenate(parts))
        which = (f >> _U(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(f), np.int64)
        cuts = np.flatnonzero(np.diff(which, prepend=-1))
        made = [CountingQuotientFilter.of(f[a:b], range_bits, quotient_bits).to_bytes()
                for a, b in zip(cuts, [*cuts[1:], len(f)])]
        return pa.record_batch([pa.array(which[cuts], pa.int64()), pa.array(made, pa.binary())],
                               names=["range", "filter"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_as_unsigned(batch.column(0)))
            n += len(held[-1])
            if n >= rows:
                yield filters(held)
                held, n = [], 0
        if n:
            yield filters(held)
    return run


def _merge(range_bits: int, bits: int):
    """Merges the filters of each range (rows come sorted by range); per range
    the merged filter and its stretch of the bitmap of repeated fingerprints."""
    def result(key: int, merged: CountingQuotientFilter) -> pa.RecordBatch:
        stretch = np.zeros(max(1, bits >> range_bits), dtype=bool)
        stretch[(merged.repeated() >> _U(64 - range_bits - _log2(len(stretch)))).astype(np.int64)] = True
        return pa.record_batch([pa.array([key], pa.int64()), pa.array([merged.to_bytes()], pa.binary()),
                                pa.array([int((merged.counts > 1).sum())], pa.int64()),
                                pa.array([np.packbits(stretch).tobytes()], pa.binary())],
                               names=["range", "filter", "n_repeated", "bits"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        key, held, waiting = None, [], 0
        for batch in batches:
            for r, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = CountingQuotientFilter.from_bytes(raw.as_py())
                if r != key:
                    if key is not None:
                        yield result(key, CountingQuotientFilter.merged(held))
                    key, held, waiting = r, [], 0
                held.append(f)
                waiting += len(f.remainders) if len(held) > 1 else 0
                if waiting > max(MERGE_ROWS, len(held[0].remainders)):    # merge as much as there is already
                    held, waiting = [CountingQuotientFilter.merged(held)], 0
        if key is not None:
            yield result(key, CountingQuotientFilter.merged(held))
    return run


def _log2(n: int) -> int:
    return n.bit_length() - 1


def _suspects(shared, bits: int):
    """Texts whose fingerprint has its bit set."""
    def run(batches):
        table = shared_value(shared)
        shift = _U(64 - _log2(bits))
        for batch in batches:
            at = (_as_unsigned(batch.column(0)) >> shift).astype(np.int64)
            yield batch.filter(pa.array((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))
    return run


def merged_filters(fingerprints: DataFrame, rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``fingerprints``: one column of 64-bit integers without nulls, about
    ``rows`` rows. Returns per range ``range, filter`` (serialised counting
    quotient filter of all its fingerprints), ``n_repeated`` (fingerprints
    with a count above one) and ``bits`` (their stretch of the bitmap)."""
    bits = bitmap_bits(rows)
    range_bits = min((-(-rows // range_rows) - 1).bit_length(), _log2(bits) - 3)
    quotient_bits = max(6, (min(rows, range_rows) >> RUN_BITS).bit_length())
    spark = fingerprints.sparkSession
    built = fingerprints.mapInArrow(_build(range_bits, quotient_bits, max(range_rows, 1 << range_bits)),
                                    "range long, filter binary")
    with arrow_rows(spark, 16):
        return materialise(built.repartition("range").sortWithinPartitions("range")
                           .mapInArrow(_merge(range_bits, bits),
                                       "range long, filter binary, n_repeated long, bits binary"), "dedup-filters")


def bitmap_bits(rows: int) -> int:
    """Bits of the bitmap for ``rows`` rows: 16 a row up to ``BITMAP_BITS``."""
    return min(BITMAP_BITS, max(1 << 10, 1 << (16 * rows).bit_length()))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id`` (id of the row that stays),
    ``group_size`` (rows with the same text), ``kept``, ``text_sha256``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    mark = F.xxhash64("text")
    meta = materialise(base.select("doc_id", F.monotonically_increasing_id().alias("row"), mark.alias("mark"),
                                   F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")), "dedup-rows")
    rows = meta.count()
    if not rows:
        return meta.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))

    merged = merged_filters(meta.select("mark"), rows, range_rows)
    bits = bitmap_bits(rows)
    table = np.zeros(bits // 8, dtype=np.uint8)
    ranges = merged.where("n_repeated > 0").select("range", "bits")
    for r in ranges.collect():                             # together at most BITMAP_BITS bits
        stretch = np.frombuffer(r["bits"], np.uint8)
        table[r["range"] * len(stretch):(r["range"] + 1) * len(stretch)] = stretch
    suspects = base.select(mark.alias("mark"), "text").mapInArrow(_suspects(share(spark, table), bits),
                                                                  "mark long, text string")
    # byte verification: the text itself is the key
    equal = (suspects.groupBy("mark", "text").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
             .select("mark", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), "group_size"))
    with arrow_rows(spark):
        equal = materialise(equal, "dedup-equal")
    stays = (meta.groupBy("mark", "sha").agg(F.max(F.struct("doc_id", "row")).alias("stays"),
                                             F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"))
    groups = materialise(equal.join(stays, ["mark", "sha"]), "dedup-groups")
    alone = F.col("group_size").isNull()
    # one row per group of copies: the small side of a join whose hot keys AQE may split
    return (meta.join(groups, ["mark", "sha"], "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (alone | (F.col("row") == F.col("stays.row"))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))
