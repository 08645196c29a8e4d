"""Text units, components, and the Jaccard join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridwake.llm import jaccard_join as jj
from gridwake.llm.components import connected_components
from gridwake.llm.textunits import ASCII_SPACE, LOWER, Units, text_slices

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingles(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset({tuple(w)} if len(w) < n else (tuple(w[i:i + n]) for i in range(len(w) - n + 1)))


def brute(rows, n, num, den):
    """rows: (id, text) -> list of (id, size, component, links)."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            groups[find(i)] = min(groups.get(find(i), d), d)
    return sorted(((d, len(s), groups.get(find(i)) if s else d, links[i])
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, n=4, num=85, den=100):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in jj.jaccard_join(df, words=n, num=num, den=den).collect()), key=str)


def test_units_follow_the_word_pattern():
    texts = ["", " a  B\tc\n", "x", None, "ÄB c\x1cd", "\x0b\x0c"]
    for part in text_slices(pa.array(texts, pa.string()), max_bytes=4):
        units = Units(part, ASCII_SPACE, LOWER[part.buf])
        for i in range(len(part)):
            got = [units.unit(k).decode() for k in range(units.bounds[i], units.bounds[i + 1])]
            assert got == words(texts[part.first + i])


def test_equal_words_have_equal_hashes_anywhere():
    part = next(iter(text_slices(pa.array(["aa b aa", "b aa", "aab"], pa.string()))))
    h = Units(part, ASCII_SPACE).hashes()
    assert h[0] == h[2] == h[4] and h[1] == h[3] and len(set(h.tolist())) == 3


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_matches_brute_force_on_families_and_common_passages(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for size in (3, 8, 20, 45, 90, 200):
        texts += family(rng, [rng.choice(vocabulary) for _ in range(size)], 25, 6)
    texts += [" ".join([rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] + passage) for _ in range(40)]
    texts += [texts[0].upper(), texts[30], texts[30], "", None, "   "]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    assert run(spark, rows) == brute(rows, 4, 85, 100)
    assert run(spark, rows, 5, 80, 100) == brute(rows, 5, 80, 100)


def test_many_blocks_give_the_same_links(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = list(enumerate(family(rng, base, 70, 5)))
    monkeypatch.setattr(jj, "BLOCK_CLASSES", 4)
    assert run(spark, rows) == brute(rows, 4, 85, 100)


def test_chain_of_links_reaches_the_smallest_id(spark):
    w = [f"c{i}" for i in range(200)]
    rows = []
    for i in range(12):
        w = list(w)
        w[i * 15] = f"new{i}"
        rows.append((100 - i, " ".join(w)))
    assert run(spark, rows) == brute(rows, 4, 85, 100)
    assert {r[2] for r in run(spark, rows)} == {89}


def test_threshold_is_exact():
    # 17 of 20 tokens common: 0.85 links; 16 of 19 does not
    bands = jj.Bands(85, 100)
    tokens = np.sort(np.random.default_rng(1).integers(1, 1 << 63, 40, dtype=np.uint64))
    a, b, c = tokens[:20], tokens[:17], np.sort(np.r_[tokens[:16], tokens[30:33]])
    i, j = jj.block_links(jj.Block.of([a]), jj.Block.of([b, c]), 85, 100)
    assert list(zip(i, j)) == [(0, 0)]
    own, sig, need = jj.cell_signatures([a, b], bands)
    assert len(set(sig[own == 0]) & set(sig[own == 1])) >= jj.SHARED_CELLS


def test_linked_sets_share_what_each_needs():
    """Pairs right at the threshold, at all sizes: in some band both hold as
    many common signatures as either needs."""
    rng = np.random.default_rng(7)
    for num, den in ((80, 100), (85, 100)):
        bands = jj.Bands(num, den)
        for _ in range(400):
            n = int(rng.integers(1, 600))
            both = rng.integers(1, 1 << 63, n, dtype=np.uint64)
            spare = int((den - num) * n // num)          # tokens outside the intersection
            k = int(rng.integers(0, spare + 1))
            extra = rng.integers(1, 1 << 63, spare, dtype=np.uint64)
            a, b = np.unique(np.r_[both, extra[:k]]), np.unique(np.r_[both, extra[k:]])
            if den * n < num * (n + spare) or len(a) != n + k or len(b) != n + spare - k or spare == 0:
                continue
            own, sig, need = jj.cell_signatures([a, b], bands)
            met = np.isin(sig, np.intersect1d(sig[own == 0], sig[own == 1]))
            best = [{v: (met & (own == i) & (need == v)).sum() for v in np.unique(need[own == i])} for i in (0, 1)]
            assert all(any(count >= v for v, count in found.items()) for found in best)
            common = len(set(sig[own == 0]) & set(sig[own == 1]))
            assert common >= max(need[own == i].min() for i in (0, 1))


def test_edge_rows_and_empty_table(spark, edge, empty):
    got = jj.jaccard_join(edge, words=4, num=85, den=100).collect()
    want = brute([(r["doc_id"], r["text"]) for r in edge.collect()], 4, 85, 100)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert jj.jaccard_join(empty).count() == 0
    kept = jj.keep_one_of_each_group(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id in (905, 906)").collect()) == [905]
    assert kept.where("doc_id is null").count() == 2
    assert jj.keep_one_of_each_group(empty).count() == 0


def test_components_only_mode_equals_the_join(spark, monkeypatch):
    """One of each group, whatever the block size; families in many blocks."""
    rng = random.Random(12)
    texts = []
    for size in (6, 12, 30, 80):
        texts += family(rng, [f"u{rng.randrange(400)}" for _ in range(size)], 40, 7)
    chain = [f"c{i}" for i in range(150)]
    for i in range(12):
        chain = list(chain)
        chain[i * 12] = f"new{i}"
        texts.append(" ".join(chain))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = sorted(d for d, *_, c, _ in brute(list(enumerate(texts)), 5, 80, 100) if c == d)
    for classes in (128, 3):
        monkeypatch.setattr(jj, "BLOCK_CLASSES", classes)
        assert sorted(r["doc_id"] for r in jj.keep_one_of_each_group(df).collect()) == expected


def test_a_repeated_id_is_no_key(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(1, a), (2, a), (2, b), (2, b), (3, None), (3, ""), (None, a), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = df.select("*", *[F.lit(c).alias(c) for c in ("_mark", "_word", "_mask", "mark", "component_id", "n", "one", "bit")])
    for docs in (df, clash):
        kept = sorted(((r["doc_id"], r["text"]) for r in jj.keep_one_of_each_group(docs).collect()), key=str)
        assert kept == sorted([(1, a), (2, b), (3, None), (3, ""), (None, a), (None, a)], key=str)
        assert jj.keep_one_of_each_group(docs).columns == docs.columns


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in
           connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1] or x in got}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
