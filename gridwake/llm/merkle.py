"""Merkle manifest of a dataset: leaf, inclusion proof and root of every row.

A row's leaf is the SHA-256 of its encoded columns. The leaves of each tree
(here: of each language) ascend by id; while several nodes remain, every
``FANOUT`` consecutive ones become the digest of their concatenation. The
trees' own roots, ordered by key, are the leaves of one more tree.

*Midstates.* A parent keeps a copy of its hash state before each child slot.
To fold another digest into a slot, the matching state is copied and only the
replacement and the siblings to its right are hashed; nothing to the left is
read again.

*On Spark.* Leaves are sorted by range once and numbered by each partition's
start. ``FANOUT ** LEVELS`` consecutive leaves of a tree form a block, so a
tree that holds most rows is many blocks; one task hashes all levels of a
block, which leaves one node, and the nodes form blocks again until each tree
has one. On the way down every block gets the path above it (at most
``FANOUT`` digests a level) as one header row that is sorted in front of its
leaves. Each step reads written tables, so a lost executor repeats one step.

Defined results: null columns are encoded as ``-``, so a null and an empty
text differ. Very long texts are hashed whole. Rows without an id come first,
rows with a null tree key form the first tree. Rows that tie in their id are
ordered by their leaf; repeated rows are leaves of their own. A lone leaf is
its tree's root. An empty table gives no rows. Columns other than the named
ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import arrow_rows, materialise

FANOUT = 8
LEVELS = 4                    # levels hashed in one task
DIGEST = 64                   # characters of a hex digest
OUT_ROWS = 1024
_PATH = "array<struct<run: string, slot: int>>"
DOCUMENT_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*columns: Column) -> Column:
    """Digest of values in order, each as UTF-8 byte count, ``:`` and value,
    null as ``-``."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Run:
    """Consecutive children of one parent, with the parent's hash state before
    each of them."""

    __slots__ = ("text", "states", "digest")

    def __init__(self, text: str):
        self.text, self.states = text, []
        state = sha256()
        for at in range(0, len(text), DIGEST):
            self.states.append(state.copy())
            state.update(text[at:at + DIGEST].encode())
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> str:
        return self.text[:slot * DIGEST] + self.text[(slot + 1) * DIGEST:]

    def fold(self, slot: int, digest: str) -> str:
        """The parent's digest with ``digest`` in ``slot``."""
        state = self.states[slot].copy()
        state.update((digest + self.text[(slot + 1) * DIGEST:]).encode())
        return state.hexdigest()


def height(n: int, fanout: int = FANOUT) -> int:
    """Levels above ``n`` nodes up to the single one."""
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def climb(digests: list[str], levels: int, fanout: int = FANOUT) -> tuple[list[list[Run]], str]:
    """The runs of each level above ``digests`` and the single digest on top."""
    above = []
    for _ in range(levels):
        above.append([Run("".join(digests[i:i + fanout])) for i in range(0, len(digests), fanout)])
        digests = [r.digest for r in above[-1]]
    return above, digests[0]


def _blocks(batches, key: int) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows in runs of equal values of the first ``key`` columns."""
    held, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[c] for c in batch.schema.names[:key])
            if now != held:
                if rows:
                    yield held, rows
                held, rows = now, []
            rows.append(row)
    if rows:
        yield held, rows


def _table(rows: list[tuple], ddl: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), ddl.values())] if rows else
                           [pa.array([], t) for t in ddl.values()], names=list(ddl))


def _heads(fanout: int, levels: int):
    """The node above each block."""
    ddl = {"tree": pa.string(), "idx": pa.int64(), "n": pa.int64(), "digest": pa.string()}

    def run(batches):
        out, size = [], fanout ** levels
        for (tree, block), rows in _blocks(batches, 2):
            n = rows[0]["n"]
            _, top = climb([r["digest"] for r in rows], min(levels, height(n, fanout)), fanout)
            out.append((tree, block, -(-n // size), top))
            if len(out) == OUT_ROWS:
                yield _table(out, ddl)
                out = []
        yield _table(out, ddl)
    return run


_PATH_TYPE = pa.list_(pa.struct([("run", pa.string()), ("slot", pa.int32())]))


def _paths(fanout: int, levels: int):
    """The path from every node to the root: own block's runs, then the header's."""
    ddl = {"tree": pa.string(), "idx": pa.int64(), "path": _PATH_TYPE}

    def run(batches):
        for (tree, block), (head, *nodes) in _blocks(batches, 2):
            above, _ = climb([r["digest"] for r in nodes], min(levels, height(nodes[0]["n"], fanout)), fanout)
            out = []
            for i, node in enumerate(nodes):
                path, at = [], i
                for runs in above:
                    at, slot = divmod(at, fanout)
                    path.append({"run": runs[at].text, "slot": slot})
                out.append((tree, node["idx"], path + head["path"]))
                if len(out) == OUT_ROWS:
                    yield _table(out, ddl)
                    out = []
            yield _table(out, ddl)
    return run


def _proofs(fanout: int, levels: int, ids: pa.DataType):
    """Proof and folded root of every leaf."""
    ddl = {"id": ids, "leaf": pa.string(), "tree": pa.string(), "proof": pa.string(), "folded_root": pa.string()}

    def run(batches):
        for (tree, block), (head, *leaves) in _blocks(batches, 2):
            above, _ = climb([r["digest"] for r in leaves], min(levels, height(leaves[0]["n"], fanout)), fanout)
            upper = [(Run(step["run"]), step["slot"]) for step in head["path"]]
            shared = "".join(r.siblings(slot) for r, slot in upper)
            out = []
            for i, leaf in enumerate(leaves):
                digest, at, proof = leaf["replacement"] or leaf["digest"], i, []
                for runs in above:
                    at, slot = divmod(at, fanout)
                    proof.append(runs[at].siblings(slot))
                    digest = runs[at].fold(slot, digest)
                for r, slot in upper:
                    digest = r.fold(slot, digest)
                out.append((leaf["id"], leaf["digest"], tree, "".join(proof) + shared, digest))
                if len(out) == OUT_ROWS:
                    yield _table(out, ddl)
                    out = []
            yield _table(out, ddl)
    return run


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``idx`` (place from 0 within ``tree`` by ``order``, nulls first)
    and ``n`` (rows of the tree). ``rows`` is a written table."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())     # splits rows repeated very often
    keys = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie")]
    placed = materialise(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                         .withColumn("_seq", F.monotonically_increasing_id()), "merkle-sorted")
    placed = placed.withColumn("_part", F.shiftright("_seq", 33))
    # one row per partition and tree
    starts = placed.groupBy(tree, "_part").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(tree)
    before = F.sum("_rows").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialise(starts.select(tree, "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                                       F.sum("_rows").over(w).alias("n")), "merkle-starts")
    return (placed.join(starts, [tree, "_part"])
            .withColumn("idx", F.col("_seq") - F.col("_first") + F.col("_before"))
            .drop("_seq", "_part", "_first", "_before"))


def _by_block(nodes: DataFrame, size: int, headers: DataFrame | None, columns: list[str]) -> DataFrame:
    """Rows sorted by tree, block and place, each block's header in front."""
    rows = nodes.select("tree", F.floor(F.col("idx") / size).alias("block"), "idx", "n", "digest", *columns)
    if headers is not None:
        rows = rows.unionByName(headers.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"),
                                               "path"), allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _grow(leaves: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Tables of nodes from ``leaves`` (``tree, idx, n, digest``) up to one
    node per tree; at least one step."""
    grown = [leaves]
    while True:
        grown.append(materialise(_by_block(grown[-1], fanout ** levels, None, [])
                                 .mapInArrow(_heads(fanout, levels), "tree string, idx long, n long, digest string"),
                                 "merkle-nodes"))
        if (grown[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return grown


def _descend(grown: list[DataFrame], top: DataFrame, fanout: int, levels: int, last: int) -> DataFrame:
    """Paths (``tree, idx, path``) of the nodes of table ``last``, from the
    paths ``top`` of the topmost ones."""
    paths = top
    for nodes in reversed(grown[last:-1]):
        paths = materialise(_by_block(nodes, fanout ** levels, paths, [])
                            .mapInArrow(_paths(fanout, levels), f"tree string, idx long, path {_PATH}"),
                            "merkle-paths")
    return paths


def merkle_manifest(rows: DataFrame, columns: tuple[str, ...] = DOCUMENT_COLUMNS, tree_col: str = "lang",
                    id_col: str = "doc_id", replacement: Column | None = None, fanout: int = FANOUT,
                    levels: int = LEVELS) -> DataFrame:
    """One row per row: ``doc_id, leaf, subroot`` (root of its tree), ``root``
    (of all trees), ``proof`` (sibling digests, level by level from the leaf,
    left to right), ``folded_root`` and ``verified`` (it equals ``root``).

    ``replacement``: a leaf to fold in place of the row's own, null for none."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))    # null first, bytewise
    spark = rows.sparkSession
    leaves = materialise(rows.select(
        tree.alias("tree"), F.col(id_col).alias("id"), leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
        (F.lit(None).cast("string") if replacement is None else replacement).alias("replacement")), "merkle-leaves")
    leaves = numbered(leaves, "tree", ["id", "digest"])
    id_type = leaves.schema["id"].dataType.simpleString()
    with arrow_rows(spark, FANOUT ** LEVELS):
        leaves = materialise(leaves, "merkle-numbered")
        grown = _grow(leaves, fanout, levels)
        subroots = grown[-1].select("tree", F.col("digest").alias("subroot"))

        tops = numbered(grown[-1].select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest"), "all", ["name"])
        tops = materialise(tops.withColumnRenamed("all", "tree"), "merkle-tops")
        over = _grow(tops.select("tree", "idx", "n", "digest"), fanout, levels)
        found = over[-1].select("digest").first()
        root = F.lit(found[0] if found else None).cast("string")
        start = over[-1].select("tree", "idx", F.array().cast(_PATH).alias("path"))
        paths = _descend(over, start, fanout, levels, 0)
        paths = (paths.drop("tree").join(tops.select("idx", F.col("name").alias("tree")), "idx")
                 .select("tree", F.lit(0).cast("long").alias("idx"), "path"))
        headers = _descend(grown, paths, fanout, levels, 1)

        proved = _by_block(leaves, fanout ** levels, headers, ["id", "replacement"])
        kind = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
        proved = proved.mapInArrow(
            _proofs(fanout, levels, kind),
            f"id {id_type}, leaf string, tree string, proof string, folded_root string")
    return (proved.join(subroots, "tree")
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof", "folded_root",
                    (F.col("folded_root") == root).alias("verified")))


def verify_tampering(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` with every row whose crc32 of the id is
    divisible by 3 folded back with the A-Z of its text lower-cased; proofs
    as digests (``proof_sha256``)."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    others = [lower if c == "text" else F.col(c) for c in DOCUMENT_COLUMNS]
    found = merkle_manifest(docs, replacement=F.when(tampered, leaf_digest(*others)))
    return found.select("doc_id", "leaf", "subroot", "root",
                        F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")
