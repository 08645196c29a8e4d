"""Toxicity: a convolutional text classifier trained and run in numpy.

Words (A-Z lower-cased runs of letters, digits and non-ASCII characters) get
the sum of two hashed embeddings, so two words are confused only if both
hashes collide. Filters of several widths slide over the embeddings; each
filter's largest response over the *whole* text feeds a logistic output.
Texts shorter than a filter are padded with zero embeddings; an empty text
is all padding and still gets a score.

The first embedding coordinate starts as the slot's association with the
label in the training rows (z-score of its document frequencies), and the
first filter of every width starts by reading it; everything is then trained.

Training reads every labelled row that is not held out, in the tasks. The rows
are written once in shards of about ``SHARD_ROWS`` by a hash of the id. In each
of ``ROUNDS`` passes every shard trains its own copy of the model in steps of
``STEP_ROWS`` texts, and the copies' moves are averaged: per embedding over the
shards that moved it, else over all. Moves are added up as whole numbers, so
their order changes nothing. The driver holds models only (fixed size).

Scoring runs in the tasks, one pass. Language never enters a score; it only
chooses the calibrated ``threshold``: the best F1 over all training rows of the
language, each scored by a model of the other half of the shards (languages
with fewer than ``MIN_CALIBRATION`` rows or one class, and null, take the
overall one). Scores are counted in ``SCORE_BINS`` bins for it.

Defined results: a null text counts as empty. Very long texts are pooled over
in whole. Repeated rows are scored each, equal texts (ties) alike; rows
without an id are scored and count as held out. An empty table gives no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import copy
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .labelled import held_out, labelled_rows
from .tables import arrow_rows, materialise, release, share, shared_value
from .textunits import LOWER, NOT_ALNUM, Texts, Units, mix64, text_slices

WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)
FILTERS = 8
DIM = 4
BUCKETS = 1 << 16
MIN_CALIBRATION = 30
SHARD_ROWS = 4096
STEP_ROWS = 32
STEP_CHARS = 1 << 21      # texts of a step, unless one alone is longer
ROUNDS = 4
SCORE_BINS = 1 << 16
BLOCK = 1 << 10           # embeddings whose moves travel as one row
SCALE = 2.0 ** 28         # moves are added up in units of 1 / SCALE
_U = np.uint64


def word_slots(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two embedding rows per word, with ``PAD`` zero rows (index BUCKETS)
    after every text: (slots (words, 2), first position of each text, valid
    window starts)."""
    units = Units(texts, NOT_ALNUM, LOWER[texts.buf])
    h = units.hashes()
    n = np.diff(units.bounds)
    first = units.bounds[:-1] + PAD * np.arange(len(n))
    slots = np.full((len(h) + PAD * len(n), 2), BUCKETS, dtype=np.int64)
    valid = np.zeros(len(slots), dtype=bool)
    where = np.arange(len(h)) + np.repeat(PAD * np.arange(len(n)), n)
    slots[where, 0] = (h & _U(BUCKETS - 1)).astype(np.int64)
    slots[where, 1] = (mix64(h ^ _U(0x94D049BB133111EB)) & _U(BUCKETS - 1)).astype(np.int64)
    valid[where] = True
    valid[first[n == 0]] = True            # an empty text has one window of padding
    return slots, first, valid


def document_frequencies(slots: tuple, labels: np.ndarray) -> np.ndarray:
    """Texts that hold a slot, by table, label and slot."""
    s, first, _ = slots
    doc = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(s))))
    out = np.zeros((2, 2, BUCKETS + 1), np.int64)
    for t in range(2):
        pairs = np.unique(doc * (BUCKETS + 1) + s[:, t])
        for c in (0, 1):
            out[t, c] = np.bincount((pairs % (BUCKETS + 1))[(labels > 0)[pairs // (BUCKETS + 1)] == c],
                                    minlength=BUCKETS + 1)
    return out


class TextCnn:
    """Embeddings (two tables), one filter bank per width, logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = [rng.normal(0, 0.1, (BUCKETS + 1, DIM)).astype(np.float32) for _ in range(2)]
        for t in self.table:
            t[BUCKETS] = 0
        self.bank = [rng.normal(0, 0.3, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(0.0)

    def start_from(self, slots: list, y: list) -> None:
        """Set the first coordinate of every slot from document frequencies."""
        classes = np.concatenate(y) > 0
        counts = sum(document_frequencies(s, labels) for s, labels in zip(slots, y))
        self.start_at(counts, (~classes).sum(), classes.sum())

    def start_at(self, counts: np.ndarray, n0: int, n1: int) -> None:
        """``counts``: as ``document_frequencies`` gives them, of ``n0`` and
        ``n1`` texts labelled 0 and 1."""
        for t in range(2):
            df = counts[t].astype(np.float64)
            share = df.sum(axis=0) / (n0 + n1)
            z = (df[1] / n1 - df[0] / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-9 + 0.25 / (n1 + n0))
            self.table[t][:, 0] = np.clip(z / 6, -1, 1)
            self.table[t][BUCKETS] = 0
        for w, bank, shift in zip(WIDTHS, self.bank, self.shift):
            bank[:, 0] = 0
            bank[::DIM, 0] = 2.0 if w == 1 else 1.0
            shift[0] = -1.0
        self.out[::FILTERS] = 1.0
        self.bias = np.float32(-2.0)

    def _windows(self, slots: np.ndarray, w: int) -> np.ndarray:
        e = self.table[0][slots[:, 0]] + self.table[1][slots[:, 1]]
        tail = np.zeros((w - 1, DIM), np.float32)
        e = np.concatenate([e, tail]) if w > 1 else e
        n = len(slots)
        return np.concatenate([e[j:j + n] for j in range(w)], axis=1)

    def pooled(self, slots, first, valid, with_place: bool = False):
        """Largest response per text and filter (and where it was)."""
        maxima, places = [], []
        for w, bank, shift in zip(WIDTHS, self.bank, self.shift):
            response = self._windows(slots, w) @ bank
            response[~valid] = -np.inf
            top = np.maximum.reduceat(response, first, axis=0) + shift
            if with_place:
                ends = np.append(first[1:], len(slots))
                places.append(np.stack([a + np.argmax(response[a:b], axis=0)
                                        for a, b in zip(first, ends)]))
            maxima.append(top)
        top = np.concatenate(maxima, axis=1)
        return (top, places) if with_place else top

    def scores(self, slots, first, valid) -> np.ndarray:
        if not len(first):
            return np.zeros(0)
        hidden = np.maximum(self.pooled(slots, first, valid), 0)
        return 1 / (1 + np.exp(-np.clip((hidden @ self.out + self.bias).astype(np.float64), -30, 30)))

    def step(self, slots, first, valid, y, weight, rate, memory) -> None:
        """One Adagrad step; the gradient of a maximum reaches only the
        window that attained it."""
        top, places = self.pooled(slots, first, valid, with_place=True)
        hidden = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.bias, -30, 30)))
        delta = ((p - y) * weight / len(y)).astype(np.float32)
        back = delta[:, None] * self.out[None, :] * (top > 0)
        self._move("out", self.out, hidden.T @ delta + 1e-4 * self.out, rate, memory)
        bias = np.array([self.bias])
        self._move("bias", bias, np.array([delta.sum()]), rate, memory)
        self.bias = bias[0]
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            place = places[k]
            picked = np.minimum(place[:, :, None] + np.arange(w)[None, None, :], len(slots) - 1)
            emb = (self.table[0][slots[picked, 0]] + self.table[1][slots[picked, 1]]).reshape(*place.shape, w * DIM)
            bank = self.bank[k].copy()
            self._move(f"bank{w}", self.bank[k], np.einsum("df,dfe->ef", g, emb), rate, memory)
            self._move(f"shift{w}", self.shift[k], g.sum(axis=0), rate, memory)
            to_words = (g[:, :, None] * bank.T[None, :, :]).reshape(-1, w, DIM)
            live = np.abs(g).reshape(-1) > 1e-7
            for t in range(2):
                rows = slots[picked, t].reshape(-1, w)[live].reshape(-1)
                grads = to_words[live].reshape(-1, DIM)
                keep = rows < BUCKETS
                unique, at = np.unique(rows[keep], return_inverse=True)
                total = np.zeros((len(unique), DIM), np.float32)
                np.add.at(total, at, grads[keep])
                seen = memory.setdefault(f"table{t}", np.zeros(BUCKETS, np.float32))
                seen[unique] += (total * total).mean(axis=1)
                self.table[t][unique] -= rate * total / (np.sqrt(seen[unique])[:, None] + 1e-6)

    @staticmethod
    def _move(name, value, grad, rate, memory) -> None:
        seen = memory.setdefault(name, np.zeros_like(value, dtype=np.float32))
        seen += grad * grad
        value -= rate * grad / (np.sqrt(seen) + 1e-6)


def _pieces(texts: list[str]) -> Texts:
    return next(iter(text_slices(pa.array(texts, pa.string()), max_bytes=1 << 40)))


def constant(n0: int, n1: int) -> TextCnn:
    """The model of rows that are all of one class, or none."""
    model = TextCnn()
    model.out[:] = 0
    model.bias = np.float32(6 if n1 else -6 if n0 else 0)
    return model


def train(texts: list[str | None], y: np.ndarray, epochs: int = 4, batch: int = 32, rate: float = 0.05,
          seed: int = 7) -> TextCnn:
    """Fit the classifier; classes weigh the same whatever their counts. An
    empty or one-class sample gives the class share as constant score."""
    y = np.asarray(y, dtype=np.float32)
    if len(y) == 0 or y.min() == y.max():
        return constant(int(len(y) - y.sum()), int(y.sum()))
    model = TextCnn(seed)
    weight = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    rng, memory = np.random.default_rng(seed), {}
    order_by_size = np.argsort([len(t or "") for t in texts], kind="stable")
    groups = [order_by_size[i:i + batch] for i in range(0, len(y), batch)]
    slots = [word_slots(_pieces([texts[i] for i in g])) for g in groups]
    model.start_from(slots, [y[g] for g in groups])
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            model.step(*slots[k], y[groups[k]], weight[groups[k]], rate, memory)
    return model


# ---------------------------------------------------------------- training in shards

MOVES_DDL = "model int, kind int, block int, moves binary"
_DENSE = ("out", "bias", *[f"bank{w}" for w in WIDTHS], *[f"shift{w}" for w in WIDTHS])


class Learner:
    """A model with its step memory and the weights of the two labels."""

    def __init__(self, counts: np.ndarray, n0: int, n1: int):
        self.trains = n0 > 0 and n1 > 0
        self.model = TextCnn() if self.trains else constant(n0, n1)
        self.weight = [(n0 + n1) / (2 * max(n, 1)) for n in (n0, n1)]
        self.memory = {f"table{t}": np.zeros(BUCKETS, np.float32) for t in range(2)}
        if self.trains:
            self.model.start_at(counts, n0, n1)

    def dense(self) -> np.ndarray:
        m = self.model
        values = dict(zip(_DENSE, [m.out, np.array([m.bias]), *m.bank, *m.shift]))
        seen = [self.memory.get(name, np.zeros_like(values[name])) for name in _DENSE]
        return np.concatenate([v.ravel() for v in [*values.values(), *seen]]).astype(np.float64)

    def set_dense(self, flat: np.ndarray) -> None:
        m, at = self.model, 0
        values = [m.out, np.array([m.bias]), *m.bank, *m.shift]
        fresh = []
        for v in [*values, *values]:
            fresh.append(flat[at:at + v.size].reshape(v.shape).astype(np.float32))
            at += v.size
        k = len(WIDTHS)
        m.out, m.bias, m.bank, m.shift = fresh[0], fresh[1][0], fresh[2:2 + k], fresh[2 + k:2 + 2 * k]
        self.memory.update(zip(_DENSE, fresh[len(values):]))

    def learn(self, texts: list[str], labels: np.ndarray, rate: float) -> None:
        weight = np.where(labels > 0, self.weight[1], self.weight[0])
        self.model.step(*word_slots(_pieces(texts)), labels, weight, rate, self.memory)

    def moves_from(self, base: "Learner") -> dict[int, np.ndarray]:
        """What training changed since ``base``, in units of 1 / SCALE. Kind 0
        and 1: the tables (slots, DIM moves, memory's move, shards that moved
        it); 2: all else, and a 1 at the end."""
        out = {}
        for t in range(2):
            seen = self.memory[f"table{t}"] - base.memory[f"table{t}"]
            moves = np.column_stack([self.model.table[t][:BUCKETS] - base.model.table[t][:BUCKETS], seen])
            out[t] = np.column_stack([np.rint(moves.astype(np.float64) * SCALE).astype(np.int64),
                                      (moves != 0).any(axis=1).astype(np.int64)])
        out[2] = np.append(np.rint((self.dense() - base.dense()) * SCALE).astype(np.int64), 1)
        return out

    def move(self, kind: int, block: int, moves: np.ndarray) -> None:
        """Take the mean of summed moves."""
        if kind == 2:
            self.set_dense(self.dense() + moves[:-1] / (SCALE * max(int(moves[-1]), 1)))
            return
        moves = moves.reshape(-1, DIM + 2)
        mean = moves[:, :-1] / (SCALE * np.maximum(moves[:, -1:], 1))
        at = slice(block * BLOCK, block * BLOCK + len(moves))
        self.model.table[kind][at] += mean[:, :DIM].astype(np.float32)
        self.memory[f"table{kind}"][at] += mean[:, DIM].astype(np.float32)


def _step_lots(batches):
    """``(shard, texts, labels)`` of a step each, from rows that lie together
    by shard, however they are cut into batches."""
    shard, texts, labels, chars = None, [], [], 0
    for batch in batches:
        for s, text, label in zip(*(batch.column(c).to_pylist() for c in ("shard", "text", "label"))):
            if texts and (s != shard or len(texts) == STEP_ROWS or chars + len(text) > STEP_CHARS):
                yield shard, texts, np.array(labels, np.float32)
                texts, labels, chars = [], [], 0
            shard, chars = s, chars + len(text)
            texts.append(text)
            labels.append(label)
    if texts:
        yield shard, texts, np.array(labels, np.float32)


def _moves(sums: dict):
    """Rows of ``MOVES_DDL`` from whole numbers by (model, kind); the tables
    travel in blocks of ``BLOCK`` rows, those without any move not at all."""
    for (model, kind), values in sums.items():
        step = BLOCK if values.ndim > 1 else len(values)
        for block in range(0, len(values), step):
            part = values[block:block + step]
            if part.any():
                yield pa.record_batch([pa.array([model], pa.int32()), pa.array([kind], pa.int32()),
                                       pa.array([block // step], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                      names=["model", "kind", "block", "moves"])


def _count_slots(batches):
    """Document frequencies (kinds 0 and 1: tables, slots by label) and numbers
    of texts (kind 2, by label) of each fold, which is the ``model``."""
    sums = {}
    for shard, texts, labels in _step_lots(batches):
        counts = document_frequencies(word_slots(_pieces(texts)), labels)
        parts = [counts[0].T, counts[1].T, np.array([(labels <= 0).sum(), (labels > 0).sum()])]
        for kind, part in enumerate(parts):
            key = (shard % 2, kind)
            sums[key] = sums[key] + part if key in sums else part
    yield from _moves({k: np.ascontiguousarray(v) for k, v in sums.items()})


def _train_shards(shared, rate: float):
    """One pass over the task's shards: the model of all rows (0) and the one
    of the shard's fold (1 or 2) each learn from a copy of their state."""
    def run(batches):
        state, shard, own, sums = shared_value(shared), None, {}, {}

        def close():
            for k, learner in own.items():
                for kind, moves in learner.moves_from(state[k]).items():
                    sums[k, kind] = sums[k, kind] + moves if (k, kind) in sums else moves
        for now, texts, labels in _step_lots(batches):
            if now != shard:
                close()
                shard, own = now, {k: copy.deepcopy(state[k]) for k in (0, 1 + now % 2) if state[k].trains}
            for learner in own.values():
                learner.learn(texts, labels, rate)
        close()
        yield from _moves(sums)
    return run


def _add_up(batches):
    """Sums of the ``moves`` of rows that lie together by (model, kind, block)."""
    key, total = None, None

    def out():
        return pa.record_batch([*[pa.array([k], pa.int32()) for k in key], pa.array([total.tobytes()], pa.binary())],
                               names=["model", "kind", "block", "moves"])
    for batch in batches:
        for *now, moves in zip(*(batch.column(c).to_pylist() for c in range(4))):
            moves = np.frombuffer(moves, np.int64)
            if now == key:
                total = total + moves
            else:
                if key is not None:
                    yield out()
                key, total = now, moves
    if key is not None:
        yield out()


def _summed(rows: DataFrame, job) -> list:
    keys = ["model", "kind", "block"]
    return (rows.mapInArrow(job, MOVES_DDL).repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_add_up, MOVES_DDL).collect())       # fixed size: models, whatever the rows


def train_on_rows(rows: DataFrame, rate: float = 0.05) -> list[TextCnn]:
    """Models of all ``rows`` (``shard, text, label``, rows of a shard
    together), of the even and of the odd shards."""
    spark = rows.sparkSession
    df, texts = np.zeros((2, 2, 2, BUCKETS + 1), np.int64), np.zeros((2, 2), np.int64)
    for fold, kind, block, counts in _summed(rows, _count_slots):
        part = np.frombuffer(counts, np.int64)
        if kind == 2:
            texts[fold] = part
        else:
            df[fold, kind, :, block * BLOCK:block * BLOCK + len(part) // 2] = part.reshape(-1, 2).T
    state = [Learner(df[f].sum(axis=0), *texts[f].sum(axis=0).tolist()) for f in ([0, 1], [0], [1])]
    for _ in range(ROUNDS if any(s.trains for s in state) else 0):
        shared = share(spark, state)
        for k, kind, block, moves in _summed(rows, _train_shards(shared, rate)):
            state[k].move(kind, block, np.frombuffer(moves, np.int64))
        shared.unpersist()
    return [s.model for s in state]


def _score_rows(shared):
    """Training rows, each scored by the model of the other fold."""
    def run(batches):
        models = shared_value(shared)
        for batch in batches:
            fold = batch.column("shard").to_numpy(zero_copy_only=False) % 2
            scores = np.zeros(len(fold))
            for f in (0, 1):
                at = np.flatnonzero(fold == f)
                parts = [models[2 - f].scores(*word_slots(t)) for t in text_slices(batch.column("text").take(pa.array(at)))]
                scores[at] = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.record_batch([batch.column("lang"), batch.column("label"),
                                   pa.array(np.minimum((scores * SCORE_BINS).astype(np.int64), SCORE_BINS - 1))],
                                  names=["lang", "label", "bin"])
    return run


def best_thresholds(binned: DataFrame) -> DataFrame:
    """``lang, threshold, n`` of the best F1 over rows ``lang, label, bin``: the
    lower end of the last bin taken, of equal ones the highest."""
    counts = binned.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
    whole = Window.partitionBy("lang")                  # at most SCORE_BINS rows
    taken = whole.orderBy(F.col("bin").desc())
    f1 = 2 * F.sum("hits").over(taken) / (F.sum("n").over(taken) + F.sum("hits").over(whole))
    return (counts.withColumns({"f1": F.when(F.sum("hits").over(whole) > 0, f1)})
            .groupBy("lang").agg(F.max(F.struct("f1", "bin")).alias("best"), F.sum("n").alias("n"), F.sum("hits").alias("hits"))
            .where((F.col("hits") > 0) & (F.col("hits") < F.col("n")))
            .select("lang", (F.col("best.bin") / F.lit(float(SCORE_BINS))).alias("threshold"), "n"))


def _score(shared):
    def run(batches):
        model = shared_value(shared)
        for batch in batches:
            parts = [model.scores(*word_slots(t)) for t in text_slices(batch.column(1))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.record_batch([batch.column(0), batch.column(2), batch.column(3), pa.array(scores, pa.float64())],
                                  names=["doc_id", "lang", "held_out", "score"])
    return run


def training_shards(docs: DataFrame, labels: DataFrame, mod: int, rest: int) -> DataFrame:
    """Every training row, written once: ``shard, lang, label, text``."""
    rows = labelled_rows(docs, labels, "toxic", mod, rest, ["lang"])
    at_most = labels.count()
    shards = 2 * max(1, math.ceil(at_most / (2 * SHARD_ROWS)))
    turn = F.xxhash64(F.col("doc_id").cast("string"))
    return materialise(
        rows.withColumn("shard", F.pmod(turn, F.lit(shards)).cast("int")).withColumn("_turn", turn)
        .repartition(shards, "shard").sortWithinPartitions("shard", "_turn", "doc_id")
        .select("shard", F.col("lang").cast("string").alias("lang"), F.col("label").cast("int").alias("label"),
                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "toxicity-rows")


def toxicity_scores(docs: DataFrame, labels: DataFrame, mod: int = 4, rest: int = 2, cut: float = 0.3) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, lang``): ``doc_id,
    held_out, score, predicted`` (``score >= cut``), ``threshold`` of the
    row's language and ``flagged`` (``score >= threshold``).

    Labels are learned from all rows whose ``crc32(doc_id) mod mod`` is not
    ``rest``. Null texts count as empty; repeated rows are scored each."""
    spark = docs.sparkSession
    rows = training_shards(docs, labels, mod, rest)
    with arrow_rows(spark):
        models = train_on_rows(rows)
        binned = materialise(rows.mapInArrow(_score_rows(share(spark, models)), "lang string, label int, bin long"),
                             "toxicity-bins")
    release(rows)
    overall = best_thresholds(binned.withColumn("lang", F.lit("all"))).first()
    overall = overall["threshold"] if overall else cut
    by_lang = materialise(best_thresholds(binned.where("lang is not null")).where(F.col("n") >= MIN_CALIBRATION)
                          .select("lang", "threshold"), "toxicity-thresholds")
    release(binned)
    shared = share(spark, models[0])       # fixed size: 2 tables of BUCKETS x DIM
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                       held_out(F.col("doc_id"), mod, rest).alias("held_out"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    scored = base.mapInArrow(_score(shared), f"doc_id {id_type}, lang string, held_out boolean, score double")
    threshold = F.coalesce("threshold", F.lit(float(overall)))
    return scored.join(by_lang, "lang", "left").select(
        "doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"),
        threshold.alias("threshold"), (F.col("score") >= threshold).cast("int").alias("flagged"))
