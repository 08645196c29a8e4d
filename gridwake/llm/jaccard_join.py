"""N-gram Jaccard self-join over a token-group matrix (exact).

Every text becomes the set of its distinct word shingles; equal sets form a
*class*, which is joined once. Classes are partitioned into groups of
similar ones, groups are stored with the union of their members' tokens (the
members are rows of a bit matrix over it), and a class is compared with a
group's members only where the overlap with that union still allows a link.

Finding the groups that can qualify. All sizes a <= b that can link satisfy
b <= a / s, and their sets differ in at most ``15 * (a + b) // 185`` tokens
(for s = 0.85). Sizes are cut into bands of ratio 1/s, so a pair lies in one
band or in two neighbouring ones. For each of its two bands a class hashes
its tokens into p cells, p exceeding the band's largest difference H by a
margin; every token in which two sets differ spoils at most one cell, so
linked sets agree on at least p - H whole cells. A cell's content hash is a
column of the matrix: sets without ``SHARED_CELLS`` common columns cannot
link, and a set with fewer empty cells than the margin needs as many more;
groups short of what their members need are not compared. Unlike single
tokens, whole cells are not made common by a passage that many texts contain.
A set with more empty cells than the margin allows also emits its empty
cells, so no link is lost.

Groups. A class joins the group of its most shared cell; a large group is
split at random into blocks of at most about ``BLOCK_CLASSES`` classes or
``BLOCK_TOKENS`` tokens, so a huge family of near copies becomes many blocks
compared pairwise (one small matrix product each), never all in one task.
Where only components are asked for, the blocks of a group are compared with
its first block; afterwards only blocks that are not in one component already
are compared with each other, so a family costs what its blocks hold.

Defined results: null, empty and blank texts have no shingles and stand
alone. Very long texts are sets like others (a set beyond ``BLOCK_TOKENS`` is
a block of its own). Repeated rows are rows of their own; there are no ties,
equality with the threshold links. A null ``doc_id`` row takes part;
``component_id`` is the smallest non-null id of its component (null if there
is none). An empty table gives no rows. Other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components, contract, labels
from .tables import arrow_rows, free_finished, fresh_name, materialise, release, share, shared_value
from .textunits import ASCII_SPACE, LOWER, Texts, Units, mix64, shingle_sets, text_slices

BLOCK_CLASSES = 128
BLOCK_TOKENS = 1 << 16
SHARED_CELLS = 2
FILTER_BITS = 1 << 26      # 8 MB
ROUNDS = 2
PAIR_ROWS = 12            # block pairs handed to Python at once
_U = np.uint64


def _shingles(texts: Texts, n: int) -> Iterator[np.ndarray]:
    return shingle_sets(Units(texts, ASCII_SPACE, LOWER[texts.buf]), n)


def _digest(s: np.ndarray) -> tuple[int, int]:
    a = int(np.add.reduce(mix64(s ^ _U(0x2545F4914F6CDD1D)))) ^ len(s)
    b = int(np.add.reduce(mix64(s * _U(0x9E3779B97F4A7C15))))
    return a - (1 << 63), b - (1 << 63)


class Bands:
    """Size bands and cell counts for similarity ``num/den``."""

    def __init__(self, num: int, den: int, top: int = 1 << 40):
        lows = [1]
        while lows[-1] < top:
            lows.append(max(lows[-1] + 1, -(-lows[-1] * den // num)))
        self.lows = np.array(lows, dtype=np.int64)
        small = self.lows[1:] - 1                          # largest smaller set of each band
        large = small * den // num
        self.differ = (den - num) * (small + large) // (den + num)
        self.margin = 3 + self.differ // 20                # empty cells that need no signature
        self.cells = self.differ + self.margin + SHARED_CELLS


def cell_signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``sets``, signature, need) of all cells of non-empty
    ``sets``. ``need``: how many signatures of the cell's band a linked set
    has in common at least; all cells agree but those with a differing token,
    and the set's empty cells are known."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    own, sig, need = [], [], []
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    tokens = np.concatenate(sets)
    at = np.repeat(np.arange(len(n)), n)
    mixed = mix64(tokens)
    home = np.searchsorted(bands.lows, n, side="right") - 1
    for band in (home, home - 1):
        used = (band >= 0) & (bands.differ[np.maximum(band, 0)] > 0)   # no difference allowed: equal sets only
        band = np.maximum(band, 0)
        p = bands.cells[band]
        cell = (((tokens >> _U(32)) * p[at].astype(_U)) >> _U(32)).astype(np.int64)
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (cell[1:] != cell[:-1]) | (at[1:] != at[:-1])
        start = np.flatnonzero(new)
        content = np.add.reduceat(mixed, start)
        doc, cell = at[start], cell[start]
        # a set short of filled cells also emits its empty ones
        empty_doc, empty_cell = [], []
        margin, empty = bands.margin[band], p - np.bincount(doc, minlength=len(n))
        least = np.where(empty > margin, SHARED_CELLS, margin + SHARED_CELLS - empty)
        for i in np.flatnonzero(used & (empty > margin)):
            gaps = np.setdiff1d(np.arange(p[i]), cell[doc == i], assume_unique=True)
            empty_doc.append(np.full(len(gaps), i))
            empty_cell.append(gaps)
        if empty_doc:
            doc = np.concatenate([doc, *empty_doc])
            cell = np.concatenate([cell, *empty_cell])
            content = np.concatenate([content, np.zeros(len(doc) - len(content), _U)])
        keep = used[doc]
        own.append(doc[keep])
        sig.append(mix64(content + band[doc].astype(_U) * _U(0x9E3779B97F4A7C15)
                         + cell.astype(_U) * _U(0xD6E8FEB86659FD93))[keep])
        need.append(least[own[-1]])
    return np.concatenate(own), np.concatenate(sig), np.concatenate(need)


def _sizes(n: int):
    def run(batches):
        for batch in batches:
            size, d1, d2 = [], [], []
            for texts in text_slices(batch.column(2)):
                for s in _shingles(texts, n):
                    a, b = _digest(s) if len(s) else (None, None)
                    size.append(len(s)); d1.append(a); d2.append(b)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                                   pa.array(d1, pa.int64()), pa.array(d2, pa.int64())],
                                  names=["doc_id", "mark", "n_shingles", "d1", "d2"])
    return run


def _signatures(n: int, num: int, den: int):
    def run(batches):
        bands, seen = Bands(num, den), set()
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                sets, nodes = [], []
                for s in _shingles(texts, n):
                    if len(s):
                        node = _digest(s)
                        if node not in seen:          # a copy in this task adds nothing
                            seen.add(node)
                            sets.append(s)
                            nodes.append(node[0])
                own, sig, need = cell_signatures(sets, bands)
                yield pa.record_batch([pa.array(sig.view(np.int64)), pa.array(np.array(nodes, np.int64)[own]),
                                       pa.array(need, pa.int32())], names=["sig", "node", "need"])
    return run


def _filter_bits(nodes: DataFrame) -> np.ndarray:
    """A bitmap with the bit of every node set: at most ``FILTER_BITS`` bits
    however many nodes there are (with more nodes it only lets more through)."""
    bits, wanted = FILTER_BITS, 32 * nodes.count()
    while bits > 1 << 10 and bits > wanted:
        bits >>= 1
    at = nodes.select(F.col("node").bitwiseAND(F.lit(bits - 1).cast("long")).alias("at"))
    words = (at.selectExpr("shiftright(at, 6) as word", "shiftleft(1L, cast(at & 63 as int)) as bit")
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())      # at most FILTER_BITS / 64 rows
    table = np.zeros(bits // 64, dtype=np.int64)
    for word, value in words:
        table[word] = value
    return table


def _token_sets(n: int, shared):
    def run(batches):
        table, seen = shared_value(shared), set()
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                d1, d2, tokens = [], [], []
                for s in _shingles(texts, n):
                    if len(s):
                        node = _digest(s)
                        at = node[0] & (64 * len(table) - 1)
                        if (int(table[at >> 6]) >> (at & 63)) & 1 and node not in seen:
                            seen.add(node)
                            d1.append(node[0]); d2.append(node[1]); tokens.append(s.tobytes())
                yield pa.record_batch([pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                                       pa.array(tokens, pa.binary())], names=["d1", "d2", "tokens"])
    return run


class Block:
    """Sets as the rows of a bit matrix over the sorted union of their tokens."""

    __slots__ = ("union", "rows")

    def __init__(self, union: np.ndarray, rows: np.ndarray):
        self.union, self.rows = union, rows

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Block:
        union = np.unique(np.concatenate(sets))
        rows = np.zeros((len(sets), len(union)), dtype=bool)
        for row, s in zip(rows, sets):
            row[np.searchsorted(union, s)] = True
        return cls(union, rows)

    def pack(self) -> tuple[bytes, bytes]:
        return self.union.tobytes(), np.packbits(self.rows, axis=1).tobytes()

    @classmethod
    def unpack(cls, union: bytes, rows: bytes, n: int) -> Block:
        tokens = np.frombuffer(union, _U)
        bits = np.frombuffer(rows, np.uint8).reshape(n, -1)
        return cls(tokens, np.unpackbits(bits, axis=1, count=len(tokens)).view(bool))

    def sizes(self) -> np.ndarray:
        return self.rows.sum(axis=1, dtype=np.int64)


def block_links(a: Block, b: Block | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked sets between blocks ``a`` and ``b`` (``None``:
    inside ``a``). The union bound comes first: a set is compared with the
    members only if its overlap with the other block's token union reaches
    what the smallest member it may link with demands."""
    other = a if b is None else b
    n, m = a.sizes(), other.sizes()
    if b is None:
        left, right, opened = a.rows, a.rows, np.arange(len(n))
    else:
        _, at, to = np.intersect1d(a.union, b.union, assume_unique=True, return_indices=True)
        left, right = a.rows[:, at], b.rows[:, to]
        least = np.maximum(m.min(), -(-num * n // den))
        need = (num * (n + least) + num + den - 1) // (num + den)
        opened = np.flatnonzero(left.sum(axis=1) >= need)
    if not len(opened):
        return opened, opened
    both = np.rint(left[opened].astype(np.float32) @ right.T.astype(np.float32)).astype(np.int64)
    total = n[opened][:, None] + m[None, :]
    hit = den * both >= num * (total - both)
    if b is None:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    return opened[i], j


_BLOCK = "struct<d1: array<bigint>, d2: array<bigint>, copies: array<bigint>, tokens: binary, bits: binary>"
_BLOCK_TYPE = pa.struct([("d1", pa.list_(pa.int64())), ("d2", pa.list_(pa.int64())),
                         ("copies", pa.list_(pa.int64())), ("tokens", pa.binary()), ("bits", pa.binary())])


def _store(batches):
    """Members of a block -> the block with its token union."""
    for batch in batches:
        out = []
        for members in batch.column(1):
            members = members.as_py()
            union, bits = Block.of([np.frombuffer(m["tokens"], dtype=_U) for m in members]).pack()
            out.append({**{k: [m[k] for m in members] for k in ("d1", "d2", "copies")}, "tokens": union, "bits": bits})
        yield pa.record_batch([batch.column(0), pa.array(out, _BLOCK_TYPE)], names=["block", "members"])


def _pair_links(num: int, den: int):
    """Per block pair: a spanning forest of its links (kind 0) and each
    class's links weighted by the other side's copies (kind 1)."""
    def members(cell):
        cell = cell.as_py()
        return (list(zip(cell["d1"], cell["d2"])), cell["copies"],
                Block.unpack(cell["tokens"], cell["bits"], len(cell["d1"])))

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("a1", "a2", "b1", "b2", "links")}
            for left, right in zip(batch.column(0), batch.column(1)):
                na, ca, sa = members(left)
                same = not right.is_valid
                nb, cb, sb = (na, ca, sa) if same else members(right)
                i, j = block_links(sa, None if same else sb, num, den)
                root = {}

                def find(x):
                    while root.setdefault(x, x) != x:
                        x = root[x]
                    return x
                degree = {}
                for x, y in zip(i.tolist(), j.tolist()):
                    u, v = na[x], nb[y]
                    degree[u] = degree.get(u, 0) + cb[y]
                    degree[v] = degree.get(v, 0) + ca[x]
                    ru, rv = find(u), find(v)
                    if ru != rv:
                        root[ru] = rv
                        for k, value in zip(out, (*u, *v, None)):
                            out[k].append(value)
                for u, count in degree.items():
                    for k, value in zip(out, (*u, None, None, count)):
                        out[k].append(value)
            yield pa.record_batch([pa.array(v, pa.int64()) for v in out.values()], names=list(out))
    return run


def _held_twice(rows: DataFrame) -> DataFrame:
    """Rows of the matrix (``sig, node, need``) whose column two classes hold."""
    w = Window.partitionBy("sig")
    return (rows.select("sig", "node", "need", F.min("node").over(w).alias("lo"), F.max("node").over(w).alias("hi"))
            .where("lo <> hi").drop("lo", "hi"))


def _edges(found: DataFrame) -> DataFrame:
    return found.where("links is null").select(F.struct(F.col("a1").alias("d1"), F.col("a2").alias("d2")).alias("u"),
                                               F.struct(F.col("b1").alias("d1"), F.col("b2").alias("d2")).alias("v"))


def _compared(blocks: DataFrame, pairs: DataFrame, assigned: DataFrame, inside: bool, num: int, den: int) -> DataFrame:
    """Links of the block pairs ``left, right``; with ``inside`` also those
    within blocks. Of a pair the smaller block travels to the larger one."""
    sizes = assigned.groupBy("block").agg(F.sum("n").alias("size"))
    swap = F.col("left_size") > F.col("right_size")
    pairs = (pairs.join(sizes.select(F.col("block").alias("left"), F.col("size").alias("left_size")), "left")
             .join(sizes.select(F.col("block").alias("right"), F.col("size").alias("right_size")), "right")
             .select(F.when(swap, F.col("right")).otherwise(F.col("left")).alias("left"),
                     F.when(swap, F.col("left")).otherwise(F.col("right")).alias("right")))
    left = blocks.select(F.col("block").alias("left"), F.col("members").alias("lm"))
    right = blocks.select(F.col("block").alias("right"), F.col("members").alias("rm"))
    asked = pairs.join(left, "left").join(right, "right").select("lm", "rm")
    if inside:
        asked = asked.unionByName(left.where(F.size("lm.d1") > 1)
                                  .select("lm", F.lit(None).cast(blocks.schema["members"].dataType).alias("rm")))
    spark = blocks.sparkSession
    with arrow_rows(spark, PAIR_ROWS):
        found = materialise(asked.mapInArrow(_pair_links(num, den), "a1 long, a2 long, b1 long, b2 long, links long"),
                            "jaccard-links")
    free_finished(spark)
    return found


def _joined(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int, links: bool) -> DataFrame:
    """``doc_id, mark`` (a hash of the text)``, n_shingles, component_id`` and,
    with ``links``, ``n_links``."""
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    with arrow_rows(spark):
        meta = materialise(base.mapInArrow(_sizes(words),
                                           f"doc_id {id_type}, mark long, n_shingles long, d1 long, d2 long"),
                           "jaccard-meta")
        shared = materialise(_held_twice(base.select("text").mapInArrow(
            _signatures(words, num, den), "sig long, node long, need int")).distinct(), "jaccard-shared")
    free_finished(spark)
    # a class with fewer shared columns than any link needs leaves the matrix,
    # and then columns that only one class still holds
    enough = shared.groupBy("node", "need").agg(F.count(F.lit(1)).alias("n")).where("n >= need").drop("n")
    before, shared = shared, materialise(_held_twice(shared.join(enough, ["node", "need"])), "jaccard-shared")
    release(before)
    classes = (meta.where("n_shingles > 0").groupBy("d1", "d2")
               .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                    F.first("n_shingles").alias("n")))

    # groups: the most shared cell; blocks: a bounded share of a group
    held = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("held"))
    key = (shared.join(held, "sig").groupBy("node")
           .agg(F.max(F.struct("held", "sig")).alias("top"), F.min("need").alias("need"))
           .select("node", F.col("top.sig").alias("key"), "need"))
    sized = key.join(classes.select(F.col("d1").alias("node"), "d2", "n", "copies"), "node")
    parts = sized.groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_TOKENS)).alias("parts"))
    block = F.xxhash64("key", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")))
    assigned = materialise(sized.join(parts, "key")
                           .select("key", "node", F.col("node").alias("d1"), "d2", "copies", "n", "need",
                                   block.alias("block")), "jaccard-blocks")
    least = assigned.groupBy("block").agg(F.min("need").alias("need"))
    columns = materialise(shared.join(assigned.select("node", "block"), "node").select("sig", "block").distinct(),
                          "jaccard-columns")
    release(shared)

    # token sets of classes in blocks: a bitmap lets (nearly) only these leave
    # the scan, the join on the full digest decides
    filter_bits = share(spark, _filter_bits(assigned.select("node")))
    tokens = (base.select("text").mapInArrow(_token_sets(words, filter_bits), "d1 long, d2 long, tokens binary")
              .join(assigned.select("block", "d1", "d2", "copies"), ["d1", "d2"])
              .dropDuplicates(["d1", "d2"]))
    with arrow_rows(spark, PAIR_ROWS):
        blocks = materialise(tokens.groupBy("block")
                             .agg(F.collect_list(F.struct("d1", "d2", "copies", "tokens")).alias("members"))
                             .mapInArrow(_store, f"block long, members {_BLOCK}"), "jaccard-tokens")
    free_finished(spark)

    def sharing(columns: DataFrame, different: Column | None = None) -> DataFrame:
        x, y = columns.alias("x"), columns.alias("y")
        met = x.join(y, "sig").where(F.col("x.block") < F.col("y.block"))
        if different is not None:
            met = met.where(different)
        return (met.groupBy(F.col("x.block").alias("left"), F.col("y.block").alias("right"))
                .agg(F.count(F.lit(1)).alias("common")).where(F.col("common") >= SHARED_CELLS)
                .join(least.select(F.col("block").alias("left"), F.col("need").alias("a")), "left")
                .join(least.select(F.col("block").alias("right"), F.col("need").alias("b")), "right")
                .where(F.col("common") >= F.greatest("a", "b")).drop("a", "b"))

    if links:
        found = _compared(blocks, sharing(columns), assigned, True, num, den)
        edges = _edges(found)
    else:
        first = Window.partitionBy("key")
        star = (assigned.select("key", "block").distinct().withColumn("left", F.min("block").over(first))
                .where("block <> left").select("left", F.col("block").alias("right")))
        near = _compared(blocks, star, assigned, True, num, den)
        # a few rounds tell nearly all: what is not recognised as connected is only compared once more
        near = contract(_edges(near), ROUNDS)
        roots = labels(near).select("node.*", "root")
        member = assigned.join(roots, ["d1", "d2"], "left").select(
            "block", F.coalesce("root", F.struct("d1", "d2")).alias("root"))
        # the component that holds all of a block, if one does
        whole = (member.groupBy("block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                 .select("block", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("whole")))
        tagged = columns.join(whole, "block")
        # a column whose blocks all lie in one component can join nothing
        open_sigs = (tagged.groupBy("sig").agg(F.min("whole").alias("lo"), F.max("whole").alias("hi"),
                                               F.count(F.when(F.col("whole").isNull(), 1)).alias("mixed"),
                                               F.count(F.lit(1)).alias("held"))
                     .where((F.col("held") > 1) & ((F.col("mixed") > 0) | (F.col("lo") != F.col("hi")))))
        tagged = materialise(tagged.join(open_sigs.select("sig"), "sig"), "jaccard-open")
        apart = (F.col("x.whole") != F.col("y.whole")) | F.col("x.whole").isNull() | F.col("y.whole").isNull()
        rest = sharing(tagged, apart).join(star, ["left", "right"], "left_anti")
        far = _compared(blocks, rest, assigned, False, num, den)
        release(tagged)
        edges = near.unionByName(_edges(far))
    roots = connected_components(edges)
    release(columns, blocks)
    roots = roots.select(F.col("node.d1").alias("d1"), F.col("node.d2").alias("d2"), "root")
    of_root = (classes.join(roots, ["d1", "d2"]).groupBy("root").agg(F.min("rep").alias("component_id")))
    per_class = (classes.select("d1", "d2", "rep", "copies")
                 .join(roots, ["d1", "d2"], "left").join(of_root, "root", "left")
                 .withColumn("component_id", F.coalesce("component_id", "rep")))
    if links:
        degree = (found.where("links is not null").groupBy(F.col("a1").alias("d1"), F.col("a2").alias("d2"))
                  .agg(F.sum("links").alias("links")))
        per_class = (per_class.join(degree, ["d1", "d2"], "left")
                     .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1))
    extra = ["n_links"] if links else []
    # few classes hold most copies: the class table is the small side of a join that AQE may split
    return (meta.join(per_class.select("d1", "d2", "component_id", *extra), ["d1", "d2"], "left")
            .select("doc_id", "mark", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in extra]))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                 num: int = 80, den: int = 100) -> DataFrame:
    """Exact similarity join on distinct ``words``-word shingles (A-Z
    lower-cased, words separated by ASCII white space): two rows link when
    ``den * |A & B| >= num * |A | B|``.

    Returns one row per input row: ``doc_id, n_shingles, component_id``
    (smallest id reachable by links) and ``n_links`` (linked rows, copies
    included). Writes its intermediate tables to the checkpoint folder."""
    return _joined(docs, id_col, text_col, words, num, den, True).drop("mark")


def keep_one_of_each_group(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when every group of linked
    rows keeps its row with the smallest ``doc_id``. Rows repeated with the
    same id and text stay once, rows that share only the id are rows of their
    own; rows without an id all stay.

    A bitmap of at most ``FILTER_BITS`` bits marks the rows that go or are
    repeated; the others stay where they are, and only marked rows are looked
    up by key."""
    found = materialise(_joined(docs, "doc_id", "text", words, num, den, False)
                        .where(F.col("doc_id").isNotNull()).select("doc_id", "mark", "component_id"), "jaccard-found")
    rows = found.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("n"), F.max("component_id").alias("component_id"))
    in_question = rows.where((F.col("n") > 1) | (F.col("component_id") != F.col("doc_id")))
    bits = FILTER_BITS
    wanted = 32 * max(1, in_question.count())
    while bits > 1 << 10 and bits > wanted:
        bits >>= 1
    mark, word, mask = (fresh_name(docs, c) for c in ("_mark", "_word", "_mask"))

    def place(doc_id: Column, text_hash: Column) -> Column:
        return F.xxhash64(doc_id, text_hash).bitwiseAND(F.lit(bits - 1).cast("long"))

    at = place(F.col("doc_id"), F.col("mark"))
    words_set = (in_question.select(F.shiftright(at, 6).alias(word),
                                    F.expr("1L").alias("one"), at.bitwiseAND(F.lit(63).cast("long")).cast("int").alias("bit"))
                 .groupBy(word).agg(F.expr("bit_or(shiftleft(one, bit))").alias(mask)))       # at most FILTER_BITS / 64 rows
    marked = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    own = place(F.col("doc_id"), F.col(mark))
    probed = (marked.withColumn(word, F.shiftright(own, 6)).join(F.broadcast(words_set), word, "left")
              .withColumn(mask, F.coalesce(F.expr(
                  f"shiftright(`{mask}`, cast(xxhash64(doc_id, `{mark}`) & 63 as int)) & 1"), F.lit(0)) == 1))
    asked = F.col(mask) & F.col("doc_id").isNotNull()
    stay = rows.where(F.col("component_id") == F.col("doc_id")).select("doc_id", F.col("mark").alias(mark))
    kept = probed.where(asked).join(stay, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", "text"])
    return probed.where(~asked).select(*docs.columns).unionByName(kept.select(*docs.columns))
