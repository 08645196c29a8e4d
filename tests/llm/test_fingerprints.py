"""Order MinHash against a plain Python version of its definition."""

import hashlib
import re

from pyspark.sql import functions as F

from gridwake.llm.order_minhash import CELLS, EMPTY, likeness, order_fingerprints, signature


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        cut = len(t) // 4
        out.append(t[:len(t) - cut] + texts[(i + 1) % len(texts)][:cut])
    return out


def test_edited_texts_and_neighbours(spark, documents):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in documents.collect()))
    got = {r["doc_id"]: r for r in order_fingerprints(documents).collect()}
    texts = [t for _, t in rows]
    for (d, t), e in zip(rows, edited(texts)):
        assert got[d]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert got[d]["n_chars"] == len(t)
    by_text = {}
    for d, t in rows:
        assert by_text.setdefault(t, got[d]["fingerprint"]) == got[d]["fingerprint"]
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.95 * len(got)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got.values())


def test_cells_hold_the_smallest_numbered_kmers(spark):
    """Filled cells are exactly those that some (k-mer, occurrence) hashes to."""
    text = "alpha beta gamma alpha beta gamma alpha beta gamma delta epsilon"
    pieces = re.findall(r"\S{1,5}", text)
    grams = [tuple(pieces[i:i + 3]) for i in range(len(pieces) - 2)]
    seen, numbered = {}, []
    for g in grams:
        numbered.append((g, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + 1
    df = spark.createDataFrame([(list(g), o) for g, o in numbered], "g array<string>, o int")
    kmer = F.xxhash64(*[F.xxhash64(F.col("g")[j]) for j in range(3)])
    h = F.xxhash64(F.shiftright(F.shiftleft(kmer, 24), 24), "o")
    cells = {r[0] for r in df.select(h.bitwiseAND(F.lit(CELLS - 1).cast("long"))).collect()}
    got = spark.createDataFrame([(text,)], "t string").select(signature(F.col("t"))).first()[0]
    assert {i for i, s in enumerate(got) if s != EMPTY} == cells


def test_order_and_multiplicity_matter(spark):
    a = " ".join(f"w{i}x" for i in range(60))
    turned = " ".join(a.split()[30:] + a.split()[:30])
    twice = a + " " + a
    df = spark.createDataFrame([(a, a, turned, twice)], "a string, b string, c string, d string")
    same, order, more = df.select(*[likeness(signature(F.col("a")), signature(F.col(c))) for c in "bcd"]).first()
    assert same == 1.0 and order < 0.9 and more < 0.9


def test_unspaced_text_follows_edit_distance(spark):
    base = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(47))[:3000]
    han = "".join(chr(0x4E00 + int(base[i:i + 3], 16)) for i in range(0, 2997, 3))
    other = "".join(chr(0x4E00 + int(base[i:i + 3], 16)) for i in range(1, 2997, 3))
    rows = [(t, "+" + t, t[:500] + t[502:], o) for t, o in ((base, base[::-1]), (han, other))]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    for front, cut, far in df.select(*[likeness(signature(F.col("a")), signature(F.col(c))) for c in "bcd"]).collect():
        assert front > 0.8 and cut > 0.8 and far < 0.3
    lines = spark.createDataFrame([("a b c d e f g h", "a\nb\nc\nd\ne\nf\ng\nh")], "a string, b string")
    assert lines.select(likeness(signature(F.col("a")), signature(F.col("b")))).first()[0] < 1


def test_edge_rows(spark, edge, empty):
    got = order_fingerprints(edge).collect()
    assert len(got) == edge.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[900]["fingerprint"] == EMPTY * CELLS and by_id[900]["n_chars"] == 0
    assert by_id[900]["near_next"] == 1.0                       # both empty
    rows = sorted((r["doc_id"], r["text"] or "") for r in edge.collect() if r["doc_id"] is not None)
    want = edited([t for _, t in rows])
    for (d, _), e in zip(rows, want):
        if d not in (905,):                                     # repeated rows follow each other
            assert by_id[d]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
    assert order_fingerprints(empty).count() == 0
    one = spark.createDataFrame([(1, "only one text here")], "doc_id long, text string")
    assert order_fingerprints(one).first()["near_next"] == 1.0  # its own successor
