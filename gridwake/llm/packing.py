"""Packing documents into token windows by non-negative least squares.

1. Tokenise every document once (a task keeps what it has tokenised: text is
   cut at white space and between ASCII characters of different kinds, where
   no token can cross, and each distinct stretch goes through the tokenizer
   once per worker). A document's ids, ended by the end id, are cut into full
   windows and a rest; each piece gets the checksum of its ids.
2. The histogram of piece lengths, at most ``window`` numbers, is the only
   thing the driver sees.
3. Lengths are counted in units of ``UNIT`` tokens (rounded up) and all
   combinations of up to ``DEPTH`` of them that fill a window are enumerated;
   non-negative least squares finds how often to use each so that together
   they use up the histogram. Repeat counts are rounded down. A combination is
   made up of true lengths, and the tokens it leaves free are filled with
   short pieces. What is left over is packed greedily (largest first) by true
   lengths, again as combinations with repeat counts.
4. Every piece gets its rank within its length class (salted windows with
   offsets, so a class that holds most pieces is spread over tasks), looks up
   which combination covers that rank, and so its sequence. Offsets are
   running sums inside a sequence, which holds at most ``window`` tokens.

Defined results: null and empty texts are one piece holding the end id. Very
long texts are cut into as many windows as they fill. Repeated rows and null
ids are packed as documents of their own; pieces that tie in length are taken
in id order within a part. Documents that contain one of the tokenizer's
special strings are tokenised whole. An empty table gives no rows. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import arrow_rows, materialise, worker_cache
from .textunits import ASCII_SPACE, Texts, Units, text_slices

UNIT = 8
DEPTH = 3
RANK_ROWS = 1024          # rows of a length class ranked in one window
CACHE_STRETCHES = 600_000
CACHE_IDS = 4_000_000
CACHE_BYTES = 48
JOINED = 4096             # words handed to the tokenizer as one text
END_OF_WORD = "</w>"
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")


def _cut_table() -> np.ndarray:
    """True where a token cannot span two neighbouring bytes: ASCII letters,
    digits (each on its own) and other characters are tokenised apart, except
    that an apostrophe may take the letters after it."""
    kind = np.full(256, 3)
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kind[0x30:0x3A] = 2
    cut = kind[:, None] != kind[None, :]
    cut[0x30:0x3A, 0x30:0x3A] = True
    cut[0x27, kind == 1] = False
    cut[0x80:, :] = cut[:, 0x80:] = False
    return cut


class Stretches:
    """Token ids of the stretches met so far in this worker process: hashes
    in ascending order, and for each the place and number of its ids."""

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = _cut_table().ravel()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)    # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [np.array(e.ids, dtype=np.uint32)
                 for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([self.ids[:0], *lists]), np.array([len(x) for x in lists], dtype=np.int64)

    def _words(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and numbers of ids of stretches of ASCII letters: each is one
        word of the tokenizer, so many go in as one text and are told apart
        by the ids that end a word."""
        length = end - begin + 1                                          # a space stands after each
        stop = np.cumsum(length)
        joined = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
        at = np.arange(len(joined)) - np.repeat(stop - length, length)
        inside = at < np.repeat(length - 1, length)
        joined[inside] = buf[(np.repeat(begin, length) + at)[inside]]
        edges = [0, *stop[JOINED - 1::JOINED].tolist(), len(joined)]
        ids, _ = self._batch([joined[a:b].tobytes().decode("ascii") for a, b in zip(edges[:-1], edges[1:]) if b > a])
        ends = np.flatnonzero(self.last[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(begin) else None

    def _learn(self, units: Units, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the units ``at``, and each one's place and number of ids."""
        begin, end = units.begin[at], units.end[at]
        other = np.concatenate([[0], np.cumsum(~LETTER[units.buf])])
        plain = other[end] == other[begin]
        words = self._words(units.buf, begin[plain], end[plain]) if plain.any() else None
        if words is None:
            plain[:] = False
            words = self.ids[:0], self.size[:0]
        rest, rest_size = self._batch([units.unit(i).decode("utf-8") for i in at[~plain].tolist()])
        size, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        size[plain], size[~plain] = words[1], rest_size
        place[plain] = np.cumsum(words[1]) - words[1]
        place[~plain] = len(words[0]) + np.cumsum(rest_size) - rest_size
        return np.concatenate([words[0], rest]), place, size

    def _keep(self, keys: np.ndarray, ids: np.ndarray, place: np.ndarray, size: np.ndarray) -> None:
        self.keys = np.concatenate([self.keys, keys])
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids[_ranges(place, size)]])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.begin, self.size = self.keys[order], self.begin[order], self.size[order]

    def documents(self, texts: Texts) -> list[np.ndarray]:
        """Token ids of each text of a slice."""
        buf = texts.buf.copy()
        if not len(buf):
            return [self.ids[:0] for _ in range(len(texts))]
        upper = (buf >= 0x41) & (buf <= 0x5A)
        capital = upper.copy()
        upper[:-1] &= buf[1:] < 0x80            # a letter may compose with a following mark: leave it
        ends = texts.offsets[1:-1]
        ends = ends[ends > 0] - 1               # last bytes of texts
        upper[ends] |= capital[ends]
        buf[upper] += 32
        between = np.zeros(len(buf), dtype=bool)
        between[1:] = self.cut[buf[:-1].astype(np.uint16) << 8 | buf[1:]]
        units = Units(texts, ASCII_SPACE, buf, cut=between)
        if len(self.keys) > CACHE_STRETCHES or len(self.ids) > CACHE_IDS:
            self.clear()
        unique, first, at = np.unique(units.hashes(), return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, unique)
        known = where < len(self.keys)
        known[known] = self.keys[where[known]] == unique[known]
        ids, place, size = self._learn(units, first[~known])
        begin, length = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        begin[known], length[known] = self.begin[where[known]], self.size[where[known]]
        begin[~known], length[~known] = len(self.ids) + place, size
        begin, length = begin[at], length[at]
        found = np.concatenate([self.ids, ids])[_ranges(begin, length)]
        edge = np.concatenate([[0], np.cumsum(length)])[units.bounds]
        out = [found[a:b] for a, b in zip(edge[:-1], edge[1:])]
        short = (units.end - units.begin)[first[~known]] <= CACHE_BYTES     # longer ones may be of any size
        self._keep(unique[~known][short], ids, place[short], size[short])
        whole = texts.buf.tobytes()
        if any(s in whole for s in SPECIAL):
            for i in range(len(texts)):
                raw = whole[texts.offsets[i]:texts.offsets[i + 1]]
                if any(s in raw for s in SPECIAL):
                    out[i] = self.encode(raw.decode("utf-8"))
        return out


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``begin, begin + size``, one after another."""
    total = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(begin - total[:-1], size) + np.arange(total[-1])


def _pieces(tokenizer_file: str, end_id: int, window: int):
    def run(batches):
        kept = worker_cache("packing")
        if kept.get("file") != tokenizer_file:
            kept.clear()
            kept.update(file=tokenizer_file, stretches=Stretches(tokenizer_file))
        stretches = kept["stretches"]
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for texts in text_slices(batch.column(1)):
                row, start, length, crc, total = [], [], [], [], []
                for i, ids in enumerate(stretches.documents(texts)):
                    raw = np.concatenate([ids, end]).astype("<u4").tobytes()
                    n = len(ids) + 1
                    for at in range(0, n, window):
                        row.append(texts.first + i); start.append(at); length.append(min(window, n - at))
                        crc.append(zlib.crc32(raw[4 * at:4 * (at + window)])); total.append(n)
                yield pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())),
                                       *[pa.array(v, pa.int64()) for v in (start, length, crc, total)]],
                                      names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All non-decreasing tuples of at most ``depth`` lengths adding up to ``units``."""
    def grow(least: int, left: int, parts: int):
        if left >= least:
            yield (left,)
        if parts > 1:
            for first in range(least, left // 2 + 1):
                for rest in grow(first, left - first, parts - 1):
                    yield (first, *rest)
    return list(grow(1, units, depth))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """min |a x - b| with x >= 0 by the active-set method: bring in the
    column with the steepest gain, solve on the columns in use, step back to
    where the first of them would turn negative, and repeat. ``rounds`` bounds
    the number of columns brought in; stopping early leaves a valid x."""
    target = a.T @ b
    x = np.zeros(a.shape[1])
    used = np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds or 3 * a.shape[0]):
        gain = target - a.T @ (a @ x)
        gain[used] = -np.inf
        k = int(np.argmax(gain))
        if gain[k] <= tolerance:
            break
        used[k] = True
        while True:
            at = np.flatnonzero(used)
            z = np.linalg.solve(a[:, at].T @ a[:, at] + 1e-9 * np.eye(len(at)), target[at])
            if (z > 0).all():
                x[at] = z
                break
            low = z <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300))
            x[at] += step * (z - x[at])
            gone = at[low & (x[at] <= 1e-9 * max(1.0, x.max()))]
            if not len(gone):
                gone = at[low][:1]
            x[gone] = 0
            used[gone] = False
    return x


def plan_sequences(histogram: np.ndarray, depth: int = DEPTH, unit: int = UNIT) -> list[tuple[dict[int, int], int]]:
    """Combinations with repeat counts that use up ``histogram`` (entry n:
    pieces of n tokens; entry 0 unused) exactly: ``({length: pieces}, repeats)``.

    The least squares count lengths in units. A combination is made up of the
    largest true lengths of its classes, and what is left of its window is
    filled with short pieces by their true lengths."""
    window = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    plan = []

    def fill(parts: dict[int, int], room: int) -> None:
        """Add the largest pieces that fit until none does."""
        free = np.flatnonzero(left[:room + 1])[::-1].tolist()
        for n in free:
            m = min(int(left[n]) - parts.get(n, 0), room // n)
            if m > 0:
                parts[n] = parts.get(n, 0) + m
                room -= m * n

    def take(parts: dict[int, int], times: int) -> int:
        times = min([times, *(int(left[n]) // m for n, m in parts.items())])
        if times > 0:
            for n, m in parts.items():
                left[n] -= m * times
            plan.append((parts, times))
        return times

    def largest(shape: tuple[int, ...]) -> dict[int, int] | None:
        parts = {}
        for u in shape:
            free = [n for n in range(unit * u, unit * (u - 1), -1) if left[n] > parts.get(n, 0)]
            if not free:
                return None
            parts[free[0]] = parts.get(free[0], 0) + 1
        return parts

    if left.any():
        units = window // unit
        shapes = combinations(units, depth)
        a = np.zeros((units, len(shapes)))
        for k, shape in enumerate(shapes):
            for u in shape:
                a[u - 1, k] += 1
        x = nonnegative_least_squares(a, left[1:].reshape(units, unit).sum(1).astype(float))
        for k in np.argsort(-x, kind="stable"):
            times = int(x[k] + 1e-6)
            if times < 1:
                break
            while times > 0 and (parts := largest(shapes[k])):
                fill(parts, window - sum(n * m for n, m in parts.items()))
                times -= take(parts, times)
    while left.any():
        parts = {}
        fill(parts, window)
        take(parts, int(left.max()))
    return plan


def _assign(keys: np.ndarray, repeats: np.ndarray, sequences: np.ndarray):
    def run(batches):
        for batch in batches:
            key = batch.column("key").to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            turn = (key - keys[at]) // repeats[at]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*columns, pa.array(sequences[at] + turn, pa.int64())],
                                  names=[*batch.schema.names[:-1], "sequence_id"])
    return run


def pack(docs: DataFrame, tokenizer_file: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. ``window`` must be a multiple of ``UNIT``;
    ``tokenizer_file`` must be at the same place on all executors."""
    if window % UNIT:
        raise ValueError(f"window must be a multiple of {UNIT}")
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    with arrow_rows(docs.sparkSession):
        pieces = materialise(base.mapInArrow(
            _pieces(tokenizer_file, end_id, window),
            f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"), "packing-pieces")

    histogram = np.zeros(window + 1, dtype=np.int64)
    for n, pieces_of_n in pieces.groupBy("length").count().collect():       # at most ``window`` rows
        histogram[n] = pieces_of_n
    keys, repeats, sequences = [], [], []
    used, sequence = np.zeros(window + 1, dtype=np.int64), 0
    for parts, times in plan_sequences(histogram):
        for n, m in parts.items():
            # the m pieces of a sequence have consecutive ranks
            keys.append((n << 48) + int(used[n]))
            repeats.append(m)
            sequences.append(sequence)
            used[n] += times * m
        sequence += times
    order = np.argsort(keys, kind="stable")
    keys, repeats, sequences = (np.array(v, dtype=np.int64)[order] for v in (keys, repeats, sequences))

    # rank inside a length class: salted parts, each part's offset from the parts before it
    parts = F.expr(f"array({', '.join(str(max(1, -(-int(n) // RANK_ROWS))) for n in histogram)})")
    p = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"),
                                         F.get(parts, F.col("length").cast("int"))))
    counts = p.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")
                             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = (p.withColumn("rn", F.row_number().over(inside)).join(offsets, ["length", "part"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      (F.shiftleft("length", 48) + F.col("before") + F.col("rn") - 1).alias("key")))
    placed = ranked.mapInArrow(
        _assign(keys, repeats, sequences),
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long")
    w = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
         .rowsBetween(Window.unboundedPreceding, -1))
    return placed.select("*", F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long").alias("offset"))
