"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is cut into pieces of up to ``PIECE`` non-space characters (restarting
at every word), and every ``K`` consecutive pieces form a k-mer. In runs
without white space, every character with ``RUN`` others of its run before or
after it is a piece of its own (k-mers at every character position), so an
edit moves no cuts but those within ``2 * RUN`` characters. White space other
than one plain space is a piece; one space shows only as a cut. A k-mer that
occurs again gets the next occurrence number, so multiplicities count. One
hash of (k-mer, occurrence) both deals the numbered k-mers to ``CELLS`` cells
and ranks them there (one-permutation hashing: one pass stands for CELLS
permutations). Of each cell the ``KEEP`` smallest are selected, put back into
their order in the text, and hashed as a tuple. Two texts agree in a cell
only if they share the selected k-mers *in the same order*, which follows
edit distance, where plain MinHash ignores order and multiplicity.

The fingerprint is the cells' signatures as hex digits, ``EMPTY`` for a cell
without k-mers; likeness is the share of agreeing cells among those that one
of both texts fills (two empty texts: 1). A text with fewer than K pieces has
one k-mer, its whole sequence.

Positions inside a signature are exact up to 2**24 pieces; beyond that, k-mers
still count, in the order of their hashes.

Neighbours in id order are found without a global sort: ids fall into
arithmetic buckets of about ``BUCKET_ROWS`` rows, each bucket's first row is
also handed to the bucket before it, and a window runs per bucket.

Defined results: null texts are empty. Rows without an id have no next
document (their cut-off quarter is replaced by nothing). Rows with equal ids
follow each other in text order; equal rows (ties) have equal results. An
empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 5
RUN = 16
K = 3
CELLS = 32
KEEP = 2
EMPTY = "...."
PIECES = rf"(?<=\S{{{RUN}}})\S|\S(?=\S{{{RUN}}})|\S{{1,{PIECE}}}|\s{{2,}}|[^\S ]"
BUCKET_ROWS = 256
BUCKETS_PER_RANGE = 4096

_POS_BITS = 24
_RANK_BITS = 34
_CELL_SHIFT = _POS_BITS + _RANK_BITS


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _kmers(text: Column) -> Column:
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))

    def of(h: Column) -> Column:
        n = F.size(h)
        grams = F.transform(F.sequence(F.lit(0), n - K),
                            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(K)]))
        return (F.when(n >= K, grams)
                .when(n > 0, F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x))))
                .otherwise(F.array().cast("array<long>")))
    return _let(F.transform(pieces, lambda p: F.xxhash64(p)), of)


def _numbered(kmers: Column) -> Column:
    """Selection keys ``cell | rank | position``, sorted. Sorting by (k-mer,
    position) puts equal k-mers side by side; the occurrence number is the
    distance to the first of the run, found by halving steps."""
    top = (1 << _POS_BITS) - 1
    keyed = F.sort_array(F.transform(kmers, lambda g, i: F.shiftleft(g, _POS_BITS).bitwiseOR(
        F.least(i, F.lit(top)).cast("long"))))
    steps = F.array(*[F.lit(1 << b) for b in range(_POS_BITS, -1, -1)])

    def of(s: Column) -> Column:
        def kmer(x):
            return F.shiftright(x, _POS_BITS)

        def occurrence(x, i):
            first = F.aggregate(steps, i, lambda at, step: F.when(
                (at >= step) & (kmer(F.get(s, at - step)) == kmer(x)), at - step).otherwise(at))
            return F.when((i == 0) | (kmer(F.get(s, i - 1)) != kmer(x)), F.lit(0)).otherwise(i - first)

        def key(x, i):
            return _let(F.xxhash64(kmer(x), occurrence(x, i)), lambda v: (
                F.shiftleft(v.bitwiseAND(F.lit(CELLS - 1).cast("long")), _CELL_SHIFT)
                .bitwiseOR(F.shiftleft(F.shiftrightunsigned(v, 64 - _RANK_BITS), _POS_BITS))
                .bitwiseOR(x.bitwiseAND(F.lit(top).cast("long")))))
        return F.transform(s, key)
    return F.sort_array(_let(keyed, of))


def signature(text: Column) -> Column:
    """Array of ``CELLS`` cell signatures (four hex digits or ``EMPTY``)."""
    def cell(x):
        return F.shiftright(x, _CELL_SHIFT)

    def select(t: Column) -> Column:
        return F.filter(t, lambda x, i: (i < KEEP) | (cell(F.get(t, i - KEEP)) != cell(x)))

    def tuples(kept: Column) -> Column:
        low = F.lit((1 << _POS_BITS) - 1).cast("long")

        def one(x, i):
            mates = F.filter(F.slice(kept, i + 1, KEEP), lambda y: cell(y) == cell(x))
            # back into text order: position first, then rank
            turned = F.sort_array(F.transform(mates, lambda y: F.shiftleft(y.bitwiseAND(low), _RANK_BITS).bitwiseOR(
                F.shiftrightunsigned(y, _POS_BITS).bitwiseAND(F.lit((1 << _RANK_BITS) - 1).cast("long")))))
            whole = F.aggregate(turned, F.lit(0).cast("long"), lambda a, y: F.xxhash64(
                a, y.bitwiseAND(F.lit((1 << _RANK_BITS) - 1).cast("long"))))
            opens = (i == 0) | (cell(F.get(kept, i - 1)) != cell(x))
            return F.when(opens, F.struct(cell(x).cast("int").alias("key"),
                                          F.lpad(F.lower(F.hex(whole.bitwiseAND(F.lit(65535).cast("long")))), 4, "0")
                                          .alias("value")))
        return F.map_from_entries(F.filter(F.transform(kept, one), lambda e: e.isNotNull()))

    cells = F.array(*[F.lit(c) for c in range(CELLS)])
    chosen = _let(_numbered(_kmers(text)), select)
    return _let(_let(chosen, tuples),
                lambda m: F.transform(cells, lambda c: F.coalesce(F.try_element_at(m, c), F.lit(EMPTY))))


def likeness(a: Column, b: Column) -> Column:
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != EMPTY)), lambda z: z))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != EMPTY) | (y != EMPTY)), lambda z: z))
    return F.when(either == 0, F.lit(1.0)).otherwise(same / F.when(either > 0, either))


def with_next(docs: DataFrame, derived: dict[str, Column]) -> DataFrame:
    """Add the columns ``derived`` from ``doc_id, text``, and ``next_text`` and
    ``next_<name>`` of each: the values of the row that follows in (doc_id,
    text) order; after the last row comes the first. Null for rows without
    an id."""
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    width = max(1, (int(hi) - int(lo) + 1) * BUCKET_ROWS // n) if n else 1
    start = int(lo) if n else 0
    bucket = F.floor((F.col("doc_id").cast("decimal(38,0)") - F.lit(start)) / F.lit(width)).cast("long")
    rows = docs.withColumn("_bucket", bucket)

    # the non-empty bucket before each bucket: inside a range of buckets by a
    # window, across ranges from one row per range
    spans = F.floor(F.col("_bucket") / BUCKETS_PER_RANGE)
    ids = rows.where(F.col("doc_id").isNotNull()).select("_bucket").distinct().withColumn("_range", spans)
    ends = (ids.groupBy("_range").agg(F.max("_bucket").alias("_end"))
            .select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_before")))
    last = F.lit(int((int(hi) - start) // width) if n else 0).cast("long")
    before = (ids.join(ends, "_range")
              .select("_bucket", F.coalesce(
                  F.lag("_bucket").over(Window.partitionBy("_range").orderBy("_bucket")), "_before", last)
                  .alias("_to")))

    heads = (rows.where(F.col("doc_id").isNotNull()).groupBy("_bucket")
             .agg(F.min(F.struct("doc_id", "text")).alias("_head")).join(before, "_bucket")
             .select("_head.doc_id", "_head.text", F.col("_to").alias("_bucket"), F.lit(1).alias("_lent")))
    every = (rows.select("doc_id", "text", F.coalesce("_bucket", -1 - F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
                         .alias("_bucket"), F.lit(0).alias("_lent"))
             .unionByName(heads).withColumns(derived))       # derived once per row, before the shuffle
    w = Window.partitionBy("_bucket").orderBy("_lent", "doc_id", "text")
    return (every.select("*", *[F.when(F.col("doc_id").isNotNull(), F.lead(c).over(w)).alias(f"next_{c}")
                                for c in ("text", *derived)])
            .where("_lent = 0").drop("_bucket", "_lent"))


def order_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter of
    its code points replaced by the next document's first ones).

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row per input row."""
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    paired = with_next(base, {"cells": signature(F.col("text"))})
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - quarter), F.left(F.coalesce("next_text", F.lit("")), quarter))
    x = paired.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "cells", "next_cells")
    x = x.select("*", signature(F.col("edited")).alias("edited_cells"))
    return x.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("cells", "").alias("fingerprint"),
        F.array_join("edited_cells", "").alias("edited_fingerprint"),
        likeness(F.col("cells"), F.col("edited_cells")).alias("near_edited"),
        F.coalesce(likeness(F.col("cells"), F.col("next_cells")), F.lit(0.0)).alias("near_next"))
