"""Token counts and packing against the tokenizer libraries."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridwake.llm.packing import Stretches, combinations, nonnegative_least_squares, pack, plan_sequences
from gridwake.llm.textunits import text_slices
from gridwake.llm.token_counts import PieceRanks, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def all_rows(spark, documents, edge):
    return documents.unionByName(edge.select(*documents.columns))


def test_counts_equal_the_library(spark, documents, edge, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = all_rows(spark, documents, edge)
    got = token_counts(docs, MODEL).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "")))
            for r in docs.collect()]
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert token_counts(empty, MODEL).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeh int.,'\n\t▁é日😀<s>/0189-"), max_size=40))
def test_heap_merging_equals_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ranks = test_heap_merging_equals_the_library.__dict__.setdefault("ranks", PieceRanks(MODEL))
    want = len(library.encode(text))
    assert (ranks.count("▁" + text.replace(" ", "▁")) if text else 0) == want


def check_packing(docs, pieces, window=2048):
    tokenizer = Tokenizer.from_file(WORDS)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1,
                   np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4").tobytes())
                  for r in docs)
    # every document's pieces cover its ids once (equal ids: as many copies of each piece)
    expected, found = {}, {}
    for d, raw in want:
        n = len(raw) // 4
        for at in range(0, n, window):
            key = (d, at, min(window, n - at), zlib.crc32(raw[4 * at:4 * (at + window)]), n)
            expected[key] = expected.get(key, 0) + 1
    for p in pieces:
        key = (p["doc_id"] if p["doc_id"] is not None else -1, p["start"], p["length"], p["ids_crc32"], p["doc_tokens"])
        found[key] = found.get(key, 0) + 1
    assert found == expected
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return sum(p["length"] for p in pieces) / (window * max(1, len(sequences)))


def test_packing_covers_every_id_once_with_little_padding(spark, documents, edge, empty):
    assert check_packing(documents.collect(), pack(documents, WORDS).collect()) > 0.97
    docs = all_rows(spark, documents, edge)
    check_packing(docs.collect(), pack(docs, WORDS).collect())
    assert pack(empty, WORDS).count() == 0


@pytest.mark.parametrize("partitions", [1, 4, 8, 17])
def test_slices_of_empty_texts_at_any_layout(spark, edge, partitions):
    docs = spark.createDataFrame([(0, ""), (1, ""), (2, None), (3, ""), (4, None)], "doc_id long, text string")
    check_packing(docs.collect(), pack(docs.repartition(partitions), WORDS).collect())
    check_packing(edge.collect(), pack(edge.repartition(partitions), WORDS).collect())


def test_short_documents_fill_their_sequences(spark):
    docs = spark.createDataFrame([(i, "") for i in range(10000)], "doc_id long, text string")
    assert check_packing(docs.collect(), pack(docs, WORDS).collect()) > 0.95
    rng = np.random.default_rng(2)
    rows = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(0, 23, 6000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert check_packing(docs.collect(), pack(docs, WORDS).collect()) > 0.95


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcxyzABZ'st0189 .,\n\t<|>éÉ́日😀İ_"), max_size=60), max_size=6))
def test_stretches_equal_the_library(texts):
    """Batches are encoded one after another, so known and new stretches mix."""
    kept = test_stretches_equal_the_library.__dict__.setdefault("kept", Stretches(WORDS))
    for slice_ in text_slices(pa.array([*texts, *texts[:2]], pa.string())):
        got = [ids.tolist() for ids in kept.documents(slice_)]
        assert got == [kept.tokenizer.encode(t, add_special_tokens=False).ids for t in [*texts, *texts[:2]]]


def test_long_stretches_leave_no_trace():
    kept = Stretches(WORDS)
    letters = np.random.default_rng(1).integers(0, 26, 300_000) + 97
    for part in np.array_split(letters, 5):
        for slice_ in text_slices(pa.array([bytes(part.tolist()).decode() + " few words", "日本" * 20_000])):
            kept.documents(slice_)
    assert len(kept.keys) == 2 and len(kept.ids) < 10


def test_a_hot_length_is_ranked_in_parts(spark, monkeypatch):
    from gridwake.llm import packing
    monkeypatch.setattr(packing, "RANK_ROWS", 16)
    docs = spark.createDataFrame([(i, "same words in every text " * 30) for i in range(300)], "doc_id long, text string")
    assert check_packing(docs.collect(), pack(docs, WORDS).collect()) > 0.9


def test_combinations_fill_the_window():
    shapes = combinations(12)
    assert len(shapes) == len(set(shapes)) == 1 + 6 + 12
    assert all(sum(s) == 12 and list(s) == sorted(s) for s in shapes)


def test_least_squares_satisfies_the_optimality_conditions():
    rng = np.random.default_rng(4)
    a, b = rng.random((12, 30)), rng.normal(size=12)
    x = nonnegative_least_squares(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gain <= 1e-6).all() and np.allclose(gain[x > 1e-9], 0, atol=1e-5)


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    histogram = np.zeros(65, dtype=np.int64)
    histogram[1:] = rng.integers(0, 200, 64) * (rng.random(64) < (0.1 if seed else 1))
    used = np.zeros(65, dtype=np.int64)
    for parts, times in plan_sequences(histogram):
        assert sum(u * m for u, m in parts.items()) <= 64 and times > 0
        for u, m in parts.items():
            used[u] += m * times
    assert (used == histogram).all()
