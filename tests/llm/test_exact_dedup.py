"""Exact duplicates against a plain dictionary of texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from gridwake.llm import exact_dedup
from gridwake.llm.exact_dedup import CountingQuotientFilter, exact_duplicates, merged_filters


def plain(rows):
    """Expected (doc_id, keep_id, group_size, sha256) of (doc_id, text) rows."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = Counter()
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        for d in ids:
            out[d, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def as_counter(rows):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows)


def one_kept_per_text(rows):
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(kept) == {r["text_sha256"] for r in rows} and set(kept.values()) <= {1}
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_documents_against_a_dictionary(spark, documents):
    rows = exact_duplicates(documents).collect()
    assert as_counter(rows) == plain([(r["doc_id"], r["text"]) for r in documents.collect()])
    one_kept_per_text(rows)


def test_many_ranges_and_a_hot_text(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 800}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    found = exact_duplicates(df, range_rows=500).collect()
    assert as_counter(found) == plain(rows)
    one_kept_per_text(found)


def test_shared_bits_and_fingerprints_make_no_copies(spark, monkeypatch):
    """With a bitmap so small that every text passes, bytes alone decide."""
    monkeypatch.setattr(exact_dedup, "bitmap_bits", lambda rows: 1 << 6)
    rows = [(i, f"text {i}" if i % 10 else "copy") for i in range(900)]
    found = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert as_counter(found) == plain(rows)


def test_edge_rows(spark, edge, empty):
    found = exact_duplicates(edge).collect()
    assert as_counter(found) == plain([(r["doc_id"], r["text"]) for r in edge.collect()])
    one_kept_per_text(found)           # rows repeated with one id: one of them stays
    assert exact_duplicates(empty).collect() == []
    clash = edge.select("doc_id", "text", *[F.lit(7).alias(c) for c in (
        "mark", "row", "sha", "range", "filter", "bits", "stays", "group_size", "keep_id", "kept", "text_sha256")])
    assert as_counter(exact_duplicates(clash).collect()) == as_counter(found)


def test_filters_merge_without_loss(spark):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    drawn = rng.choice(prints, 9000)
    whole = Counter(drawn.tolist())
    for range_bits in (0, 3):
        one = drawn[drawn >> np.uint64(61) == 5] if range_bits else drawn
        parts = [CountingQuotientFilter.of(p, range_bits, 9) for p in np.array_split(one, 7)]
        parts = [CountingQuotientFilter.from_bytes(p.to_bytes()) for p in parts]
        merged = CountingQuotientFilter.merged(parts)
        assert all(merged.count(int(f)) == whole[int(f)] for f in np.unique(one))
        assert int(merged.counts.sum()) == len(one)
        again = CountingQuotientFilter.of(one, range_bits, 9)
        assert merged.to_bytes() == again.to_bytes()
        absent = int(prints[0]) ^ 1
        assert merged.count(absent) == whole[absent]

    signed = [(int(f.view(np.int64)),) for f in drawn]
    found = merged_filters(spark.createDataFrame(signed, "f long").repartition(9), len(drawn), 700).collect()
    assert len(found) == 16 and sum(r["n_repeated"] for r in found) == sum(n > 1 for n in whole.values())
    for r in found:
        f = CountingQuotientFilter.from_bytes(r["filter"])
        assert all(f.count(p) == n for p, n in whole.items() if p >> 60 == r["range"])
