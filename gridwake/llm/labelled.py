"""Labelled rows for training, and held-out splits by a checksum of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """True where ``crc32(doc_id as text) mod mod = rest``; rows without an
    id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(True))


def _marked(labels: DataFrame, label_col: str, mod: int, rest: int) -> DataFrame:
    """``doc_id, label`` (0 or 1) of the ids that may train: a repeated id
    counts once, label 1 wins; held-out ids never enter."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
            .where(~held_out(F.col("doc_id"), mod, rest))
            .groupBy("doc_id").agg(F.max(label_col).alias("label")))


def _with_texts(docs: DataFrame, chosen: DataFrame, columns: list[str]) -> DataFrame:
    """``chosen`` with the documents' ``columns``; of a repeated document the
    smallest text is taken."""
    names = list(dict.fromkeys(["doc_id", "text", *columns]))
    return (docs.select(*names).join(chosen, "doc_id").groupBy("doc_id", "label")
            .agg(F.min(F.struct("text", *[c for c in names if c not in ("doc_id", "text")])).alias("r"))
            .select("doc_id", "label", "r.*"))


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str, mod: int, rest: int,
                  columns: list[str]) -> DataFrame:
    """Every training row: ``doc_id, label, text`` and ``columns``."""
    return _with_texts(docs, _marked(labels, label_col, mod, rest), columns)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, mod: int, rest: int,
                    per_class: int, columns: list[str]) -> list:
    """At most ``per_class`` training rows of each label 0 and 1, as Rows of
    ``columns`` and ``label``, in id order.

    The sample is chosen among the labels (first by a hash of the id; a
    repeated id counts once, label 1 wins), so its size is bounded by
    ``2 * per_class`` ids before any text is read. Held-out rows never enter.
    Of a repeated document the smallest text is taken."""
    marked = _marked(labels, label_col, mod, rest)
    picks = [marked.where(F.col("label") == value)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for value in (0, 1)]
    chosen = F.broadcast(picks[0].unionByName(picks[1]))      # bounded by 2 * per_class ids
    return sorted(_with_texts(docs, chosen, columns).collect(), key=lambda r: r["doc_id"])
