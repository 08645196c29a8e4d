"""Toxicity and quality: held-out rows, accuracy, training rules, edge rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from gridwake.llm import quality, toxicity
from gridwake.llm.labelled import labelled_sample
from gridwake.llm.textunits import text_slices


def split(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def test_held_out_rows_never_train(spark, documents, labels):
    rows = labelled_sample(documents, labels, "toxic", 4, 2, 50, ["lang"])
    assert rows and all(split(r["doc_id"], 4) != 2 for r in rows)
    assert max(np.bincount([r["label"] for r in rows])) <= 50


def test_held_out_labels_do_not_change_scores(spark, documents, labels):
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                  1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    a = quality.quality_scores(documents, labels).collect()
    b = quality.quality_scores(documents, flipped).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(r["held_out"] == (split(r["doc_id"], 3) == 1) for r in a)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in a)


def test_quality_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in got])
    assert len(got) > 80 and right > 0.93


def test_toxicity_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 500
    # some labels of this table mark texts without any toxic word, and the reverse
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.95
    assert all(r["flagged"] == int(r["score"] >= r["threshold"]) for r in got)


def test_max_pooling_reads_whole_texts():
    """A word at the far end of a long text scores like one at its start, and
    neighbours in a batch do not leak into each other."""
    bad, plain = "zork", " ".join(f"w{i % 97}" for i in range(5000))
    texts = [f"{bad} good day", "good day", f"{bad} well then", "well then"] * 20
    model = toxicity.train(texts, np.array([1, 0, 1, 0] * 20), epochs=20)

    def score(*t):
        part = next(iter(text_slices(pa.array(t, pa.string()), 1 << 40)))
        return model.scores(*toxicity.word_slots(part))
    long = score(f"{plain} {bad}", plain, f"{bad} {plain}")
    assert long[0] > 0.5 > long[1] and abs(long[0] - long[2]) < 0.3
    alone = np.concatenate([score(t) for t in ("", plain, f"{bad}", "good day")])
    assert np.allclose(score("", plain, bad, "good day"), alone, atol=1e-6)


def test_pairwise_term_equals_the_double_sum():
    rng = np.random.default_rng(0)
    model = quality.FactorisationMachine(3)
    model.w = rng.normal(size=quality.SLOTS)
    slot, x = rng.choice(quality.SLOTS, 9, replace=False), rng.normal(size=9)
    z = model.bias + model.w[slot] @ x + sum(model.v[slot[i]] @ model.v[slot[j]] * x[i] * x[j]
                                             for i in range(9) for j in range(i))
    got = model.scores(np.zeros(9, int), slot, x)[0]
    assert got == pytest.approx(1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("label", ["empty", "one class"])
def test_degenerate_labels_give_constant_scores(spark, documents, labels, label):
    some = labels.where("false") if label == "empty" else labels.selectExpr("doc_id", "0 quality", "0 toxic")
    assert len({round(r["score"], 9) for r in quality.quality_scores(documents, some).collect()}) == 1
    assert len({round(r["score"], 6) for r in toxicity.toxicity_scores(documents, some).collect()}) == 1


def test_edge_rows(spark, edge, empty, labels):
    from pyspark.sql import functions as F
    odd = labels.unionByName(spark.createDataFrame([(None, None, None), (900, 1, None), (900, 0, 1), (901, None, 0)],
                                                   "doc_id long, quality int, toxic int"))
    for got in (quality.quality_scores(edge, odd), toxicity.toxicity_scores(edge, odd)):
        rows = got.collect()
        assert len(rows) == edge.count()
        assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows)
        assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    assert quality.quality_scores(empty, odd).count() == 0
    assert toxicity.toxicity_scores(empty, odd).count() == 0
    kept = quality.keep_quality(edge, odd)
    assert kept.columns == edge.columns and kept.count() <= edge.count()
    same = quality.quality_scores(edge, odd).where("predicted = 1").where(F.col("doc_id").isNotNull())
    assert sorted(r[0] for r in same.select("doc_id").collect()) == sorted(
        r[0] for r in kept.where("doc_id is not null").select("doc_id").collect())


def test_toxicity_learns_from_every_training_row(spark):
    """Toxic rows past the first 1,500 by the hash of their id hold a word of
    their own; it is learned too, and how rows are dealt changes nothing."""
    from pyspark.sql import Window, functions as F
    plain = F.concat(F.lit("w"), F.col("doc_id") % 91, F.lit(" quiet day v"), F.col("doc_id") % 53)
    late = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")) > 1500
    ids = spark.range(4800).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    ids = ids.where(~(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).withColumn("late", late)
    word = F.when(F.col("toxic") == 0, "").when(F.col("late"), " zork").otherwise(" blip")
    docs = ids.select("doc_id", F.concat(plain, word).alias("text"), F.lit("en").alias("lang"))
    probe = spark.createDataFrame([(-1, "quiet day zork", "en"), (-2, "quiet day", None), (-3, "blip quiet day", "xx")],
                                  "doc_id long, text string, lang string")
    labels = ids.select("doc_id", "toxic")
    assert ids.where("toxic = 1 and late").count() > 100
    assert toxicity.training_shards(docs, labels, 4, 2).count() == ids.count()
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs.unionByName(probe), labels).collect()}
    assert got[-1]["score"] > 0.5 > got[-2]["score"] and got[-3]["score"] > 0.5
    again = toxicity.toxicity_scores(docs.unionByName(probe).repartition(7, "text"), labels.repartition(3)).collect()
    assert len(again) == len(got)                # scores of float32 products, which the cut of a batch may touch
    assert all(abs(r["score"] - got[r["doc_id"]]["score"]) < 1e-6 for r in again)
    assert {r["threshold"] for r in again} == {r["threshold"] for r in got.values()}


def test_best_thresholds_equal_a_loop(spark):
    rows = [("a", int(i * 7919 % 13 == 0), (i * 37) % 50) for i in range(200)] + [("b", 0, 3), ("b", 0, 4)]
    got = toxicity.best_thresholds(spark.createDataFrame(rows, "lang string, label int, bin long")).collect()
    assert [r["lang"] for r in got] == ["a"] and got[0]["n"] == 200

    def f1(cut):
        taken = [r for r in rows[:200] if r[2] >= cut]
        return 2 * sum(r[1] for r in taken) / (len(taken) + sum(r[1] for r in rows[:200]))
    best = max((f1(b), b) for b in {r[2] for r in rows[:200]})
    assert got[0]["threshold"] == best[1] / toxicity.SCORE_BINS
