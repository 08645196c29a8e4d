"""Merkle manifest against a plain tree that hashes everything again."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from gridwake.llm.merkle import Run, climb, height, merkle_manifest, verify_tampering


def H(text):
    return sha256(text.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return H("".join(enc(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(nodes, fanout=8):
    """All levels from ``nodes`` to the single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def walk(levels, i, digest, fanout=8):
    proof = ""
    for nodes in levels[:-1]:
        lo = i - i % fanout
        run = nodes[lo:lo + fanout]
        proof += "".join(run[:i - lo] + run[i - lo + 1:])
        run[i - lo] = digest
        digest, i = H("".join(run)), i // fanout
    return proof, digest


def plain(rows, fanout=8):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append((r["doc_id"] is not None, r["doc_id"], leaf_of(r, r["text"]), r))
    langs = sorted(by_lang, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3] if x[0] else (False, 0, x[2]))
        trees[lang] = tree([x[2] for x in by_lang[lang]], fanout)
    top = tree([trees[lang][-1][0] for lang in langs], fanout) if langs else None
    out = Counter()
    for k, lang in enumerate(langs):
        for i, (_, doc_id, leaf, r) in enumerate(by_lang[lang]):
            text, digest = r["text"], leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                digest = leaf_of(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            proof, subroot = walk(trees[lang], i, digest, fanout)
            more, folded = walk(top, k, subroot, fanout)
            root = top[-1][0]
            out[doc_id, leaf, trees[lang][-1][0], root, H(proof + more), folded, folded == root] += 1
    return out


def as_counter(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                               "verified").collect())


def test_documents_against_a_plain_tree(spark, documents):
    found = as_counter(verify_tampering(documents))
    assert found == plain(documents.collect())
    assert {k[6] for k in found} == {True, False}


def test_edge_rows(spark, edge, empty):
    expected = plain(edge.collect())
    assert as_counter(verify_tampering(edge)) == expected
    clash = edge.select("*", *[F.lit(3).alias(c) for c in (
        "tree", "id", "digest", "replacement", "idx", "n", "path", "leaf", "root", "subroot", "proof", "_tie", "_seq",
        "_part", "folded_root")])
    assert as_counter(verify_tampering(clash)) == expected
    assert verify_tampering(empty).collect() == []
    lone = edge.where("doc_id = 903").limit(1)
    assert as_counter(verify_tampering(lone)) == plain(lone.collect())


def test_several_passes_and_many_trees(spark):
    """Blocks of 4 leaves, so that several steps up and down are needed; one
    language holds most rows, and there are more languages than a block has room for."""
    rows = [(i, f"Text {i % 7}", "en" if i % 3 else f"l{i % 60}", "s", i) for i in range(331)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    expected = plain(df.collect(), fanout=2)
    found = merkle_manifest(df.repartition(7), fanout=2, levels=2)
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == 331 and all(r["verified"] for r in got.values())
    proofs = {k[0]: k for k in expected}
    for d, r in got.items():
        assert (r["leaf"], r["subroot"], r["root"], H(r["proof"])) == proofs[d][1:5]


def test_a_state_resumes_without_its_left_siblings():
    digests = [H(str(i)) for i in range(13)]
    above, top = climb(digests, height(13))
    assert top == tree(digests)[-1][0]
    run = Run("".join(digests[:8]))
    run.text = "?" * 64 * 3 + run.text[64 * 3:]        # what stands left of slot 3 is not read again
    assert run.fold(3, H("x")) == H("".join([*digests[:3], H("x"), *digests[4:8]]))
