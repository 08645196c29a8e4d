"""Quality classifier: a factorisation machine trained and run in numpy.

Inputs of a text, all computed over the whole text:

* its words (A-Z lower-cased runs of letters, digits and non-ASCII
  characters), hashed to ``WORD_SLOTS`` features, log counts scaled to
  length 1;
* structure statistics (shares of byte classes, repeated neighbours,
  distinct words, word lengths ...), each as one of ``BINS`` bins;
* metadata of the text itself: its length and number of lines, in octaves.

The score is logistic in ``b + sum(w x) + pairs``, where the pairwise
interactions sum((v_i . v_j) x_i x_j) come from rank-``RANK`` factors in
linear time as ``(|sum(v x)|^2 - sum(|v|^2 x^2)) / 2``.

Training (driver, numpy, fixed seed) uses at most ``per_class`` labelled rows
of each class; scoring runs in the tasks, one pass, no shuffle. An empty text
has its structure and metadata features and so a score too.

Defined results: a null text counts as empty. Very long texts are read whole.
Repeated rows are scored each, equal texts (ties) alike; rows without an id
are scored and count as held out. An empty table gives no rows. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, labelled_sample
from .tables import share, shared_value
from .textunits import ASCII_SPACE, LOWER, NOT_ALNUM, Texts, Units, text_slices

WORD_SLOTS = 1 << 15
BINS = 16
RANK = 4
PER_CLASS = 3000
_U = np.uint64

# byte classes whose shares are structure statistics (fixed values)
BYTE_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!?", "#$%&*@^~", "|/\\<>{}[]=_+", ".,;:", "\n", " ")
STATISTICS = len(BYTE_CLASSES) + 8
SLOTS = WORD_SLOTS + (STATISTICS + 2) * BINS


def _class_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    for k, chars in enumerate(BYTE_CLASSES, start=1):
        table[list(chars.encode("ascii"))] = k
    return table


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, value) triples sorted by text; every text has some."""
    docs = len(texts)
    size = np.diff(texts.offsets)
    at = np.repeat(np.arange(docs), size)
    kinds = len(BYTE_CLASSES) + 1
    counts = np.bincount(at * kinds + _class_table()[texts.buf], minlength=docs * kinds).reshape(docs, kinds)
    per_byte = counts[:, 1:] / np.maximum(size, 1)[:, None]

    words = Units(texts, NOT_ALNUM, LOWER[texts.buf])
    h = words.hashes()
    n = np.diff(words.bounds)
    doc = np.repeat(np.arange(docs), n)
    per_word = 1 / np.maximum(n, 1)
    length = words.end - words.begin

    def word_share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc[flags], minlength=docs) * per_word
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    slot = (h & _U(WORD_SLOTS - 1)).astype(np.int64)
    pairs, times = np.unique(doc * WORD_SLOTS + slot, return_counts=True)
    pair_doc = pairs // WORD_SLOTS
    distinct = np.bincount(pair_doc, minlength=docs) * per_word
    most = np.zeros(docs)
    np.maximum.at(most, pair_doc, times)
    chunks = Units(texts, ASCII_SPACE)
    pieces = np.maximum(np.diff(chunks.bounds), 1)
    statistics = np.column_stack([
        per_byte, word_share(again), distinct, most * per_word, word_share(length <= 3), word_share(length >= 12),
        np.minimum(np.bincount(doc, weights=length, minlength=docs) * per_word / 16, 1),
        np.minimum(n / pieces / 4, 1), np.minimum(counts[:, 1:].sum(axis=1) / np.maximum(size, 1), 1)])
    # square roots spread the small shares, where the differences are
    bins = np.minimum((np.sqrt(np.clip(statistics, 0, 1)) * BINS).astype(np.int64), BINS - 1)
    octaves = np.column_stack([np.minimum(np.log2(size + 1) * 0.75, BINS - 1).astype(np.int64),
                               np.minimum(np.log2(counts[:, 1 + BYTE_CLASSES.index("\n")] + 1) * 1.5, BINS - 1)
                               .astype(np.int64)])
    bins = np.concatenate([bins, octaves], axis=1)
    stat_slot = WORD_SLOTS + np.arange(bins.shape[1]) * BINS + bins

    value = np.log1p(times)
    norm = np.sqrt(np.bincount(pair_doc, weights=value * value, minlength=docs))
    value = value / np.maximum(norm, 1e-9)[pair_doc]
    all_doc = np.concatenate([pair_doc, np.repeat(np.arange(docs), bins.shape[1])])
    all_slot = np.concatenate([pairs % WORD_SLOTS, stat_slot.ravel()])
    all_value = np.concatenate([value, np.full(stat_slot.size, 0.5)])
    order = np.argsort(all_doc, kind="stable")
    return all_doc[order], all_slot[order], all_value[order]


class FactorisationMachine:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.w = np.zeros(SLOTS)
        self.v = rng.normal(0, 0.05, (SLOTS, RANK))

    def _sums(self, doc, slot, x):
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        vx = self.v[slot] * x[:, None]
        s = np.add.reduceat(vx, start, axis=0)
        linear = np.add.reduceat(self.w[slot] * x, start)
        squares = np.add.reduceat((vx * vx).sum(axis=1), start)
        return s, self.bias + linear + ((s * s).sum(axis=1) - squares) / 2

    def scores(self, doc, slot, x) -> np.ndarray:
        if not len(doc):
            return np.zeros(0)
        _, z = self._sums(doc, slot, x)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def step(self, doc, slot, x, y, weight, rate, memory, decay=1e-5) -> None:
        """One Adagrad step on the logistic loss."""
        s, z = self._sums(doc, slot, x)
        delta = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(y)
        d = delta[doc]
        unique, at = np.unique(slot, return_inverse=True)
        gw = np.bincount(at, weights=d * x) + decay * self.w[unique]
        pull = d[:, None] * x[:, None] * (s[doc] - self.v[slot] * x[:, None])
        gv = np.column_stack([np.bincount(at, weights=pull[:, r]) for r in range(RANK)]) + decay * self.v[unique]
        for name, value, grad in (("w", self.w, gw), ("v", self.v, gv)):
            seen = memory.setdefault(name, np.zeros_like(value))
            seen[unique] += grad * grad
            value[unique] -= rate * grad / (np.sqrt(seen[unique]) + 1e-8)
        memory["b"] = memory.get("b", 0.0) + delta.sum() ** 2
        self.bias -= rate * delta.sum() / (np.sqrt(memory["b"]) + 1e-8)


def train(texts: list[str | None], y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.08,
          seed: int = 11) -> FactorisationMachine:
    """Fit the machine; an empty or one-class sample gives a constant
    score on that side of one half."""
    model = FactorisationMachine(seed)
    y = np.asarray(y, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        model.v[:] = 0
        model.bias = 0.0 if len(y) == 0 else (6.0 if y[0] else -6.0)
        return model
    weight = np.ones(len(y))
    rng, memory = np.random.default_rng(seed), {}
    order = rng.permutation(len(y))
    groups = [order[i:i + batch] for i in range(0, len(y), batch)]
    data = [features(next(iter(text_slices(pa.array([texts[i] for i in g], pa.string()), 1 << 40)))) for g in groups]
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            model.step(*data[k], y[groups[k]], weight[groups[k]], rate, memory)
    return model


def _score(shared):
    def run(batches):
        model = shared_value(shared)
        for batch in batches:
            parts = [model.scores(*features(t)) for t in text_slices(batch.column(1))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            columns = [batch.column(0), *[batch.column(i) for i in range(2, batch.num_columns)]]
            names = [batch.schema.names[0], *batch.schema.names[2:]]
            yield pa.record_batch([*columns, pa.array(scores, pa.float64())], names=[*names, "score"])
    return run


def _keep(shared, column: int, cut: float):
    def run(batches):
        model = shared_value(shared)
        for batch in batches:
            parts = [model.scores(*features(t)) for t in text_slices(batch.column(column).cast(pa.string()))]
            yield batch.filter(pa.array((np.concatenate(parts) if parts else np.zeros(0)) >= cut))
    return run


def quality_model(docs: DataFrame, labels: DataFrame, mod: int = 3, rest: int = 1,
                  per_class: int = PER_CLASS) -> FactorisationMachine:
    """Train on labelled rows whose ``crc32(doc_id) mod mod`` is not ``rest``."""
    rows = labelled_sample(docs, labels, "quality", mod, rest, per_class, [])
    return train([r["text"] for r in rows], np.array([r["label"] for r in rows]))


def quality_scores(docs: DataFrame, labels: DataFrame, mod: int = 3, rest: int = 1, cut: float = 0.5,
                   per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, held_out,
    score, predicted`` (``score >= cut``). Null texts count as empty; repeated
    rows are scored each; other columns are ignored."""
    shared = share(docs.sparkSession, quality_model(docs, labels, mod, rest, per_class))  # fixed size
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id"), mod, rest).alias("held_out"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    scored = base.mapInArrow(_score(shared), f"doc_id {id_type}, held_out boolean, score double")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, mod: int = 3, rest: int = 1, cut: float = 0.5,
                 per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``cut``."""
    shared = share(docs.sparkSession, quality_model(docs, labels, mod, rest, per_class))
    return docs.mapInArrow(_keep(shared, docs.columns.index("text"), cut), docs.schema)
