"""Hard negatives against a brute-force search over all rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridwake.llm import hard_negatives as hn
from gridwake.llm.hard_negatives import Best, Stretch, codebook, hard_negatives, mine_embeddings, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5):
    """Rows (vec_id, embedding, label) as given; the contract word for word."""
    clean = set()
    for v, e, label in rows:
        if label is None or e is None or any(c is None or not math.isfinite(c) for c in e):
            continue
        if v is not None and v % 7 == 0:
            label = (label + 1) % 10
        clean.add((v, tuple(math.floor(256 * float(np.float32(c))) for c in e), label))
    last = float("inf")
    out = Counter()
    for a, x, label in clean:
        if a is None or a % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), last if v is None else v, v, lab, (v, y, lab))
                         for v, y, lab in clean), key=lambda r: r[:2])
        for minus, _, p, lab, _ in [r for r in scored if r[3] == label and r[4] != (a, x, label)][:positives]:
            s = -minus
            found = [r for r in scored if r[3] != label and 80 * s <= -100 * r[0] <= 100 * s][:negatives]
            for rank, r in enumerate(found, 1):
                out[a, p, rank, r[2], s, -r[0]] += 1
    return out


def as_counter(df):
    return Counter(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


def test_embeddings_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert as_counter(mine_embeddings(df)) == brute(rows)


def rows_in_clusters(n, dims, hot, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    out = []
    for i in range(n):
        if hot and i % 3 == 0:
            out.append((i, [0.5] * dims, 4))
        else:
            out.append((i, (centres[i % 6] + 0.2 * rng.normal(size=dims)).astype(np.float32).tolist(), int(i % 5)))
    return out


def test_a_hot_vector_ties_and_blocks_of_anchors(spark, monkeypatch):
    rows = rows_in_clusters(900, 5, hot=True)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = brute(rows)
    assert as_counter(mine_embeddings(df)) == expected
    labelled = df.select(F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                         F.col("vec_id").alias("id"),
                         F.transform("embedding", lambda c: F.floor(c.cast("double") * 256)).alias("vector"))
    assert as_counter(hard_negatives(labelled, F.col("id") % 100 == 0, block=3)) == expected


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (200, [-1.0, -2.0], 2), (3, None, 1),
            (4, [1.0, None], 1), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (8, [1.0, 2.0], None), (9, [0.9, 1.9], 2),
            (10, [0.9, 1.9], 2), (11, [1.0], 3), (300, [], 3), (12, [], 1), (None, [0.9, 1.9], 2), (400, [0.5, 0.5], 9),
            (13, [0.0, 0.0], 3), (100, [2.0, 2.0], 5), (14, [1.5, 2.0], 5)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in (
        "id", "vector", "anchor", "turn", "score", "rank", "block", "c1", "c2", "anchor_id")])
    assert as_counter(mine_embeddings(df)) == brute(rows)
    assert mine_embeddings(df.where("false")).collect() == []
    assert mine_embeddings(df.where("vec_id = 9")).collect() == []
    huge = [(100 * i, [1e30, -3e38], 1) for i in range(3)] + [(1, [1e30, 1.0], 2)]
    assert mine_embeddings(spark.createDataFrame(huge, SCHEMA)).columns[0] == "anchor_id"


@pytest.mark.parametrize("dims", [7, 32])
def test_cells_come_by_falling_bound_and_the_walk_stops_early(dims):
    rng = np.random.default_rng(9)
    centres = rng.normal(scale=200, size=(40, dims))
    x = np.rint(centres[rng.integers(0, 40, 3000)] + rng.normal(scale=8, size=(3000, dims))).astype(np.int32)
    books = [codebook(x[:1500, :dims // 2], 80), codebook(x[:1500, dims // 2:], 80)]
    codes = [nearest(h.astype(float), b) for h, b in zip((x[:, :dims // 2], x[:, dims // 2:]), books)]
    ids, labels = np.arange(3000), rng.integers(0, 4, 3000)
    s = Stretch(codes[0], codes[1], ids, np.zeros(3000, bool), labels, x, books)
    scored = []
    anchors = x[:30].astype(float)
    b1, b2 = s.bounds(anchors)
    for i, a in enumerate(anchors):
        cells = list(s.visit(b1[i], b2[i]))
        bounds = [c[0] for c in cells]
        assert bounds == sorted(bounds, reverse=True) and sum(hi - lo for _, lo, hi in cells) == 3000
        for bound, lo, hi in cells:
            assert (s.x[lo:hi] @ a <= bound).all()
        best = Best(5, -np.inf, np.inf)
        seen = []
        s.search(a, b1[i], b2[i], lambda rows: seen.append(len(rows)) or labels[s.ids[rows]] == 1, [best])
        score = x @ x[i]
        expected = sorted((-int(score[j]), int(j)) for j in np.flatnonzero(labels == 1))[:5]
        assert [(-int(v), int(j)) for v, j in zip(best.scores, best.ids)] == expected
        scored.append(sum(seen))
    assert np.mean(scored) < 0.5 * 3000
