"""Hard negatives by an inverted multi-index (exact).

*Index.* Vectors are cut into halves; each half has a codebook of its own
(k-means on a bounded sample, ``SAMPLE`` rows, which decides cells only, never
results). The pair of nearest codewords is a row's cell. Rows are stored
sorted by cell, and every task reads a stretch of cells.

*Search.* The score of a row is its inner product with the anchor. For one
half it is at most ``anchor half . codeword + |anchor half| * radius``, the
radius being the largest distance of a stored half to its codeword. A heap
walks the two descending lists of half bounds (multi-sequence order), so cells
come by falling sum of their half bounds. Rows of visited cells are scored;
the walk stops once no unvisited cell can change the answer:

* positives (rows of the anchor's label): the worst of the best ones found
  already beats the next bound;
* negatives: per positive there is a window ``low * p <= 100 * score <=
  high * p``; it is certified when it is full and its worst row beats the
  next bound, or when the next bound falls below the window.

Each task certifies the stretch it reads, so merging the tasks' few best rows
gives the exact answer.

*On Spark.* Equal vectors of one label are interchangeable but for their id,
so only the smallest ids of such a class can be asked for; the others are cut
before any shuffle, and a vector that a third of all rows share is a handful
of rows. Anchors go to the tasks in blocks of ``ANCHORS``, one pass over the
index per block for positives and one for negatives; tasks keep the best rows
of their whole stretch and emit them once.

Defined results: rows with a null label, a null vector or a null component
take no part. Components saturate at +-``LARGEST``; a shorter vector is filled
up with zeros, so an empty one scores 0. Ties in the score go to the smaller
id, a null id coming last. Rows repeated with the same id, label and vector
count once; rows that share only the id are different rows. An anchor without
other rows of its label, or whose windows hold no row, gives no rows, and an
empty table none. Columns with other names are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise, share, shared_value

SAMPLE = 8192              # rows that the codebooks are fitted on
CELL_ROWS = 64             # rows a cell is meant for
CODEWORDS = 256            # at most, per half
ANCHORS = 8192             # anchors searched in one pass
CHUNK_ROWS = 1 << 15       # rows a task searches at once
INDEX_BYTES = 16 << 20     # bytes of a stored stretch
LARGEST = 1 << 21
_LAST = np.iinfo(np.int64).max


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to ``dims``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(vectors.offsets.to_numpy())
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(size), dims), np.int32)
    out[row, place] = np.clip(flat, -LARGEST, LARGEST)
    return out


def codebook(half: np.ndarray, words: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """k-means centres of the rows of ``half``."""
    different = np.unique(half, axis=0).astype(np.float64)
    if not len(different):
        return np.zeros((1, half.shape[1]))
    pick = np.random.default_rng(seed).permutation(len(different))[:words]
    centres, points = different[np.sort(pick)], half.astype(np.float64)
    for _ in range(rounds):
        near = nearest(points, centres)
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row."""
    return np.argmin((centres ** 2).sum(1) - 2 * points @ centres.T, axis=1)


def _cells(shared, dims: int):
    """Stored form of the rows: cell, id, label and packed vector."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        books = shared_value(shared)
        cut = books[0].shape[1]
        for batch in batches:
            x = _matrix(batch.column(2), dims)
            code = [nearest(h.astype(np.float64), b) for h, b in zip((x[:, :cut], x[:, cut:]), books)]
            yield pa.record_batch([pa.array(code[0], pa.int32()), pa.array(code[1], pa.int32()), batch.column(0),
                                   batch.column(1), pa.array([v.tobytes() for v in x], pa.binary())],
                                  names=["c1", "c2", "id", "label", "vector"])
    return run


class Stretch:
    """An inverted multi-index over some stored rows."""

    def __init__(self, c1, c2, ids, null_id, labels, x, books):
        order = np.lexsort((labels, c2, c1))
        self.ids, self.null_id, self.labels = ids[order], null_id[order], labels[order]
        c1, c2, x = c1[order], c2[order], x[order]
        # sums of products up to 2 ** 24 are exact in single precision
        top = int(np.abs(x).max(initial=0))
        self.x = x.astype(np.float32 if top * top * x.shape[1] < 1 << 23 else np.float64)
        self.top = top
        self.words1, self.words2 = np.unique(c1), np.unique(c2)
        cut = books[0].shape[1]
        self.halves = []
        for half, code, words, book in ((x[:, :cut], c1, self.words1, books[0]), (x[:, cut:], c2, self.words2, books[1])):
            away = np.sqrt(((half - book[code]) ** 2).sum(1))
            radius = np.zeros(len(words))
            np.maximum.at(radius, np.searchsorted(words, code), away)
            self.halves.append((book[words], radius))
        cell = np.searchsorted(self.words1, c1) * len(self.words2) + np.searchsorted(self.words2, c2)
        self.offsets = np.searchsorted(cell, np.arange(len(self.words1) * len(self.words2) + 1))
        self.cut = cut

    def bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """Half-score bounds of every anchor for every codeword present; a
        little above the exact value, to stay bounds after rounding."""
        out = []
        for part, (centres, radius) in zip((anchors[:, :self.cut], anchors[:, self.cut:]), self.halves):
            length = np.sqrt((part ** 2).sum(1))[:, None]
            reach = length * (radius + np.sqrt((centres ** 2).sum(1)))
            out.append(part @ centres.T + length * radius + 1e-9 * reach + 1e-6)
        return out

    def visit(self, bound1: np.ndarray, bound2: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """``(bound, first row, last row + 1)`` of the cells that hold rows, by
        falling bound (multi-sequence order over the two sorted lists)."""
        by1, by2 = np.argsort(-bound1), np.argsort(-bound2)
        first, second = bound1[by1].tolist(), bound2[by2].tolist()
        row = (by1 * len(by2)).tolist()
        column, offsets = by2.tolist(), self.offsets
        heap = [(-(first[0] + second[0]), 0, 0)]
        while heap:
            bound, p, q = heapq.heappop(heap)
            cell = row[p] + column[q]
            if offsets[cell] < offsets[cell + 1]:
                yield -bound, int(offsets[cell]), int(offsets[cell + 1])
            if q + 1 < len(second):
                heapq.heappush(heap, (-(first[p] + second[q + 1]), p, q + 1))
            if q == 0 and p + 1 < len(first):
                heapq.heappush(heap, (-(first[p + 1] + second[0]), p + 1, 0))

    def search(self, anchor: np.ndarray, bound1: np.ndarray, bound2: np.ndarray, wanted, best: list[Best]) -> None:
        """Visit cells until all of ``best`` are certified. ``wanted``: keeps
        of the rows of a cell those that may be answers."""
        a = anchor.astype(self.x.dtype if np.abs(anchor).max(initial=0) <= self.top else np.float64)
        held, n, enough = [], 0, 64
        for bound, lo, hi in self.visit(bound1, bound2):
            if all(b.certified(bound) for b in best):
                break
            held.append((lo, hi))
            n += hi - lo
            if n >= enough:
                self._score(a, held, wanted, best)
                held, n, enough = [], 0, min(4 * enough, 4096)
        if held:
            self._score(a, held, wanted, best)

    def _score(self, a: np.ndarray, held: list[tuple[int, int]], wanted, best: list[Best]) -> None:
        rows = np.concatenate([np.arange(lo, hi) for lo, hi in held])
        rows = rows[wanted(rows)]
        scores = np.rint(self.x[rows] @ a).astype(np.int64)
        for b in best:
            b.add(scores, self.ids[rows], self.null_id[rows])


class Best:
    """The first ``size`` rows by falling score and rising id (null last)
    among those with a score in ``[low, high]``."""

    __slots__ = ("size", "low", "high", "scores", "ids", "null_id")

    def __init__(self, size: int, low: float, high: float):
        self.size, self.low, self.high = size, low, high
        self.scores, self.ids, self.null_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def certified(self, bound: float) -> bool:
        """No row that scores at most ``bound`` can change the answer."""
        return bound < self.low or len(self.scores) == self.size and bound < self.scores[-1]

    def add(self, scores: np.ndarray, ids: np.ndarray, null_id: np.ndarray) -> None:
        least = self.scores[-1] if len(self.scores) == self.size else self.low
        keep = (scores >= least) & (scores <= self.high)
        if not keep.any():
            return
        scores = np.concatenate([self.scores, scores[keep]])
        ids, null_id = np.concatenate([self.ids, ids[keep]]), np.concatenate([self.null_id, null_id[keep]])
        order = np.lexsort((null_id, ids, -scores))[:self.size]
        self.scores, self.ids, self.null_id = scores[order], ids[order], null_id[order]


def _stretches(batches, books, dims: int) -> Iterator[Stretch]:
    def made(rows: list[pa.RecordBatch]) -> Stretch:
        t = pa.Table.from_batches(rows).combine_chunks()
        ids = t.column("id").fill_null(_LAST).to_numpy()
        x = np.frombuffer(b"".join(t.column("vector").to_pylist()), np.int32).reshape(t.num_rows, dims)
        return Stretch(t.column("c1").to_numpy(), t.column("c2").to_numpy(), ids,
                       t.column("id").is_null().to_numpy(), t.column("label").to_numpy(), x, books)

    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            held.append(batch.slice(at, CHUNK_ROWS))
            n += held[-1].num_rows
            if n >= CHUNK_ROWS:
                yield made(held)
                held, n = [], 0
    if n:
        yield made(held)


def _found(best: list[tuple[int, int, Best]]) -> pa.RecordBatch:
    """Rows ``anchor, turn, id, score`` of the best rows of each search."""
    n = [len(b.scores) for _, _, b in best]
    kept = [b for _, _, b in best]
    columns = [np.repeat([a for a, _, _ in best], n), np.repeat([t for _, t, _ in best], n),
               np.concatenate([np.zeros(0, np.int64), *[b.ids for b in kept]]),
               np.concatenate([np.zeros(0, np.int64), *[b.scores for b in kept]])]
    nulls = np.concatenate([np.zeros(0, bool), *[b.null_id for b in kept]])
    return pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                            pa.array(columns[2], pa.int64(), mask=nulls), pa.array(columns[3], pa.int64())],
                           names=["anchor", "turn", "id", "score"])


FOUND = "anchor int, turn int, id long, score long"


def _positives(shared, dims: int, size: int):
    """Best other rows of each anchor's label in a task's rows."""
    def run(batches):
        books, ids, labels, x = shared_value(shared)
        best = [Best(size, -np.inf, np.inf) for _ in ids]
        for s in _stretches(batches, books, dims):
            b1, b2 = s.bounds(x)
            for i, b in enumerate(best):
                def wanted(rows, i=i):
                    keep = s.labels[rows] == labels[i]
                    same = np.flatnonzero(keep & (s.ids[rows] == ids[i]) & ~s.null_id[rows])
                    keep[same[(s.x[rows[same]] == x[i]).all(1)]] = False          # the anchor itself
                    return keep
                s.search(x[i], b1[i], b2[i], wanted, [b])
        yield _found([(i, 0, b) for i, b in enumerate(best)])
    return run


def _negatives(shared, dims: int, size: int, low: int, high: int):
    """Best rows of other labels in each positive's window in a task's rows.
    Positives with the same score share a window."""
    def run(batches):
        books, labels, x, positives = shared_value(shared)
        best = [{p: Best(size, -(-low * p // 100), high * p // 100) for p in sorted(set(scores))
                 if low * p <= high * p} for scores in positives]
        for s in _stretches(batches, books, dims):
            b1, b2 = s.bounds(x)
            for i, windows in enumerate(best):
                if windows:
                    s.search(x[i], b1[i], b2[i], lambda rows, i=i: s.labels[rows] != labels[i], list(windows.values()))
        yield _found([(i, turn, windows[p]) for i, windows in enumerate(best)
                      for turn, p in enumerate(positives[i]) if p in windows])
    return run


def _first(found: DataFrame, size: int) -> DataFrame:
    w = Window.partitionBy("anchor", "turn").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "id", vector_col: str = "vector",
                   label_col: str = "label", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   block: int = ANCHORS) -> DataFrame:
    """``rows``: an id (whole number), a vector of whole numbers and a label
    (whole number). ``anchors`` says which rows are anchors.

    Returns, for each anchor and each of its first ``positives`` rows of the
    same label, the first ``negatives`` rows of other labels whose score s
    satisfies ``low * p <= 100 * s <= high * p``, p being the positive's:
    ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``."""
    spark = rows.sparkSession
    taken = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).cast("array<bigint>").alias("vector"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor"))
    taken = (taken.where(F.col("label").isNotNull() & F.forall("vector", lambda c: c.isNotNull()))
             .groupBy("id", "label", "vector").agg(F.max("anchor").alias("anchor")))
    taken = materialise(taken, "mining-rows")
    # of equal vectors only the smallest ids can be among the first ones
    w = Window.partitionBy("label", "vector").orderBy(F.col("id").asc_nulls_last())
    kept = (taken.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= max(positives + 1, negatives))
            .select("id", "label", "vector"))
    kept = materialise(kept, "mining-classes")
    n, dims = kept.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    n_anchors = taken.where("anchor").count()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    if not n_anchors:
        return empty
    dims = max(dims, 2)

    sample = kept.orderBy(F.xxhash64("id", "label"), "id").limit(SAMPLE).select("vector").toArrow().column(0)
    x = _matrix(sample, dims)
    words = int(min(CODEWORDS, max(2, round((n / CELL_ROWS) ** 0.5))))
    books = [codebook(x[:, :dims // 2], words), codebook(x[:, dims // 2:], words)]
    cells = "c1 int, c2 int, id long, label long, vector binary"
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-n * (4 * dims + 32) // INDEX_BYTES))
    shared_books = share(spark, books)
    stored = (materialise(kept.mapInArrow(_cells(shared_books, dims), cells)
                          .repartitionByRange(parts, "c1", "c2", "id").sortWithinPartitions("c1", "c2", "label"),
                          "mining-index"))

    results, blocks = [], -(-n_anchors // block)
    asked = taken.where("anchor").withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)))
    for k in range(blocks):                                   # about ``block`` anchors each
        some = (asked.where(F.col("block") == k).select("id", "label", "vector")
                .orderBy("id", "label", "vector").toArrow())
        if not some.num_rows:
            continue
        ids, labels = some.column("id").fill_null(_LAST).to_numpy(), some.column("label").to_numpy()
        x = _matrix(some.column("vector"), dims).astype(np.float64)
        found = stored.mapInArrow(_positives(share(spark, (books, ids, labels, x)), dims, positives), FOUND)
        chosen = [[] for _ in ids]
        for r in _first(found, positives).collect():          # at most ``positives`` rows an anchor of the block
            chosen[r["anchor"]].append((r["rank"], r["id"], r["score"]))
        chosen = [sorted(c) for c in chosen]
        scores = [[s for _, _, s in c] for c in chosen]
        found = stored.mapInArrow(_negatives(share(spark, (books, labels, x, scores)), dims, negatives, low, high),
                                  FOUND)
        pairs = spark.createDataFrame(
            pa.table({"anchor": pa.array([a for a, c in enumerate(chosen) for _ in c], pa.int32()),
                      "turn": pa.array([t for c in chosen for t in range(len(c))], pa.int32()),
                      "anchor_id": pa.array([some.column("id")[a].as_py() for a, c in enumerate(chosen) for _ in c], pa.int64()),
                      "positive_id": pa.array([p for c in chosen for _, p, _ in c], pa.int64()),
                      "positive_score": pa.array([s for c in chosen for _, _, s in c], pa.int64())}))
        results.append(materialise(
            _first(found, negatives).join(pairs, ["anchor", "turn"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")), "mining-found"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the anchors whose ``vec_id`` is divisible by 100:
    rows with a component that is not a finite number are left out, labels of
    ids divisible by 7 move on by one (modulo 10), components become
    ``floor(256 * x)``."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.where(finite).select(
        F.col("vec_id").alias("id"), label.alias("label"),
        F.transform("embedding", lambda c: F.floor(c.cast("double") * 256)).alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)
