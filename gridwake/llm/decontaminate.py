"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Seeds. Every n-gram of a test item is a seed. Its expected number of chance
occurrences follows from the frequencies of its words over *all* training
texts (words as independent); a leaked passage stays rare however often it was
copied, since copies raise its words' frequencies but not their product much.
N-grams rare by a fixed measure are strong, and so are an item's rarest
quarter and the rarest of every ``PASSAGE`` words in a row: a property of the
item and the texts, not of the other items. A text that shares a strong seed,
or two weak ones on nearly one diagonal (text position minus item position),
proposes that diagonal; overlapping proposals merge into windows.

Alignment. Each window is aligned with the item by Smith-Waterman over words
(match +2, mismatch -1, gap -1), vectorised over a row: the left-to-right gap
recursion is a running maximum. The score is the alignment's share of the
item's perfect score, so verbatim copies score 1 and edited or partial copies
less. A window whose words cannot reach the threshold even if all common
words matched is not aligned (the bound is exact). A long passage of an item
counts too, however small its share: a second, strict alignment (match +1,
mismatch and gap -4, so at least about 80 % identity) must reach ``PASSAGE``.

Items with fewer than ``MIN_WORDS`` words match a whole line or a whole text
of exactly their words (inside a line they would match common phrases).

The item index goes to all tasks, so benchmarks are searched in blocks of at
most ``BLOCK_CHARS`` characters, one pass over the texts per block.

Defined results: null and empty texts and items match nothing. Very long texts
are searched whole. Repeated rows of texts report each; repeated items report
each, and all items that tie are reported. Empty tables match nothing. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import share, shared_value
from .textunits import LOWER, NOT_ALNUM, Texts, Units, ngram_hashes, text_slices

N = 3
MIN_WORDS = 5
THRESHOLD = 0.5
PASSAGE = 13                  # strict score from which a passage counts: as many words word for word
CHANCE = 1e-5                 # chance occurrences per text up to which one seed proposes alone
BLOCK_CHARS = 4_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
STRICT = (1, -4, -4)
_TABLE_BITS = 20
_U = np.uint64


def word_hashes(text: str) -> np.ndarray:
    texts = next(iter(text_slices(pa.array([text], pa.string()), 1 << 40)))
    return Units(texts, NOT_ALNUM, LOWER[texts.buf]).hashes()


def align(item: np.ndarray, window: np.ndarray, match: int = MATCH, mismatch: int = MISMATCH,
          gap: int = GAP) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: (score, first and end
    position of the aligned part of ``window``)."""
    n = len(window)
    slope = -gap * np.arange(1, n + 1)
    row = np.zeros(n + 1, dtype=np.int64)
    origin = np.arange(n + 1)                # where in the window the path of a cell began
    best, begin, end = 0, 0, 0
    for word in item:
        step = row[:-1] + np.where(window == word, match, mismatch)
        down = row[1:] + gap
        fresh = np.maximum(np.maximum(step, down), 0)
        start = np.where(step >= down, origin[:-1], origin[1:])
        start = np.where(fresh == 0, np.arange(1, n + 1), start)
        # gaps to the right: the best earlier cell, less the distance
        lifted = fresh + slope
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n), 0))
        value = np.maximum(top - slope, 0)
        start = np.where(value > fresh, start[source], start)
        row = np.concatenate([[0], value])
        origin = np.concatenate([[0], start])
        k = int(np.argmax(value))
        if value[k] > best:
            best, begin, end = int(value[k]), int(start[k]), k + 1
    return best, begin, end


class ItemIndex:
    """Seeds of a block of items: sorted n-gram hashes with (item, position,
    whether strong)."""

    def __init__(self, items: list[tuple[object, np.ndarray]], frequency: dict[int, int], words: int, texts: int):
        self.items = items
        self.short = {}                          # words of an item of fewer than MIN_WORDS -> items
        for k, (_, w) in enumerate(items):
            if len(w) < MIN_WORDS:
                self.short.setdefault(tuple(w.tolist()), []).append(k)
        self.short_first = np.array(sorted({w[0] for w in self.short}), dtype=_U)
        per_text = words / max(texts, 1)
        total = max(words, 1)
        grams = [ngram_hashes(w if len(w) >= MIN_WORDS else w[:0], N) for _, w in items]
        budget = np.log(CHANCE) - np.log(max(per_text, 1))
        self.band = np.array([len(w) // 4 + 4 for _, w in items], dtype=np.int64)
        seeds, owner, place, strong = [], [], [], []
        for k, ((_, w), g) in enumerate(zip(items, grams)):
            if not len(g):
                continue
            p = np.log([max(frequency.get(int(h), 0), 0.5) / total for h in w])
            rarity = np.sum([p[j:len(p) - N + 1 + j] for j in range(N)], axis=0)
            alone = rarity <= budget
            alone[np.argsort(rarity, kind="stable")[:-(-len(g) // 4)]] = True
            stretch = np.lib.stride_tricks.sliding_window_view(rarity, min(PASSAGE - N + 1, len(g)))
            alone[np.argmin(stretch, axis=1) + np.arange(len(stretch))] = True
            seeds.append(g); owner.append(np.full(len(g), k)); place.append(np.arange(len(g))); strong.append(alone)
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        seeds, owner, place = join(seeds, _U), join(owner, np.int64), join(place, np.int64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], owner[order], place[order]
        self.strong = join(strong, bool)[order]
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.seeds & _U((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True

    def proposals(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(gram position, item, diagonal, strong) of every shared seed."""
        maybe = np.flatnonzero(self.table[(grams & _U((1 << _TABLE_BITS) - 1)).astype(np.int64)])
        lo = np.searchsorted(self.seeds, grams[maybe], side="left")
        count = np.searchsorted(self.seeds, grams[maybe], side="right") - lo
        where = np.repeat(maybe, count)
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        return where, self.owner[at], where - self.place[at], self.strong[at]

    def search(self, words: np.ndarray, item: int, diagonals: np.ndarray, threshold: float):
        """Best alignment of an item in a text given its proposed diagonals:
        (score, start, end) or None."""
        target = self.items[item][1]
        m = len(target)
        need = threshold * MATCH * m
        pad = int(self.band[item])
        # a strict score of PASSAGE with e errors takes PASSAGE + 4e matches in e + 1 runs, so as many shared n-grams
        passage = len(diagonals) >= PASSAGE - N + 1
        lows = np.maximum(np.unique(diagonals) - pad, 0)
        found = None
        lo = hi = None
        for low in [*lows.tolist(), None]:
            if lo is not None and (low is None or low > hi):
                window = words[lo:hi]
                a, b = Counter(target.tolist()), Counter(window.tolist())
                common = sum(min(c, b[h]) for h, c in a.items())
                long = passage and common >= PASSAGE
                if MATCH * common >= need or long:
                    score, begin, end = align(target, window)
                    if ((score >= need or long and align(target, window, *STRICT)[0] >= PASSAGE)
                            and (found is None or score / (MATCH * m) > found[0])):
                        found = (score / (MATCH * m), lo + begin, lo + end)
                lo = None
            if low is not None:
                lo = low if lo is None else lo
                hi = min(low + m + 2 * pad, len(words))
        return found


def _frequencies(vocabulary: np.ndarray):
    def run(batches):
        table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        table[(vocabulary & _U((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True
        count, words, texts_seen = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                h = Units(texts, NOT_ALNUM, LOWER[texts.buf]).hashes()
                words += len(h)
                texts_seen += len(texts)
                h = h[table[(h & _U((1 << _TABLE_BITS) - 1)).astype(np.int64)]]
                if len(vocabulary) and len(h):
                    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                    count += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        seen = np.flatnonzero(count)
        yield pa.record_batch([pa.array(["word"] * len(seen) + ["words", "texts"]),
                               pa.array([*vocabulary.view(np.int64)[seen], 0, 0], pa.int64()),
                               pa.array([*count[seen], words, texts_seen], pa.int64())], names=["what", "word", "n"])
    return run


def _whole(index: ItemIndex, units: Units, h: np.ndarray):
    """(text, item, (1.0, start, end)) of short items that are a whole line or
    a whole text, once per text and item."""
    if not len(index.short_first) or not len(h):
        return
    opens = np.zeros(len(h) + 1, dtype=bool)     # word begins a text
    opens[units.bounds] = True
    breaks = np.flatnonzero((units.texts.buf == 10) | (units.texts.buf == 13))
    lines = opens.copy()
    lines[np.searchsorted(units.begin, breaks)] = True
    seen = set()
    for edges in (np.flatnonzero(lines), np.flatnonzero(opens)):
        first, size = edges[:-1], np.diff(edges)
        for a, n in zip(first[k := (size < MIN_WORDS) & np.isin(h[first], index.short_first)].tolist(), size[k].tolist()):
            doc = int(np.searchsorted(units.bounds, a, side="right")) - 1
            for item in index.short.get(tuple(h[a:a + n].tolist()), ()):
                if (doc, item) not in seen:
                    seen.add((doc, item))
                    at = a - int(units.bounds[doc])
                    yield doc, item, (1.0, at, at + n)


def _hits(index: ItemIndex, texts: Texts, threshold: float):
    """(text, item, (score, start, end)) of every aligned pair of a slice."""
    units = Units(texts, NOT_ALNUM, LOWER[texts.buf])
    h = units.hashes()
    yield from _whole(index, units, h)
    where, owner, diagonal, strong = index.proposals(ngram_hashes(h, N))
    doc = np.searchsorted(units.bounds, where, side="right") - 1
    inside = where + N <= units.bounds[doc + 1]
    doc, owner, diagonal, strong = doc[inside], owner[inside], diagonal[inside], strong[inside]
    if not len(doc):
        return
    order = np.lexsort((diagonal, owner, doc))
    doc, owner, diagonal, strong = doc[order], owner[order], diagonal[order], strong[order]
    near = (doc[1:] == doc[:-1]) & (owner[1:] == owner[:-1]) & (np.diff(diagonal) <= index.band[owner[1:]])
    kept = strong | np.r_[near, False] | np.r_[False, near]
    doc, owner, diagonal = doc[kept], owner[kept], diagonal[kept]
    if not len(doc):
        return
    cuts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1])])
    for a, b in zip(cuts, [*cuts[1:], len(doc)]):
        lo, hi = units.bounds[doc[a]], units.bounds[doc[a] + 1]
        found = index.search(h[lo:hi], owner[a], diagonal[a:b] - lo, threshold)
        if found:
            yield int(doc[a]), int(owner[a]), found


def _scan(shared, threshold: float):
    def run(batches):
        index = shared_value(shared)
        for batch in batches:
            row, item, score, start, end = [], [], [], [], []
            for texts in text_slices(batch.column(1)):
                for doc, owner, found in _hits(index, texts, threshold):
                    row.append(texts.first + doc); item.append(owner)
                    score.append(found[0]); start.append(found[1]); end.append(found[2])
            yield pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int64()),
                                   pa.array(score, pa.float64()), pa.array(start, pa.int64()),
                                   pa.array(end, pa.int64())],
                                  names=["doc_id", "item", "score", "start_word", "end_word"])
    return run


def _clean(shared, column: int, threshold: float):
    def run(batches):
        index = shared_value(shared)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for texts in text_slices(batch.column(column).cast(pa.string())):
                for doc, _, _ in _hits(index, texts, threshold):
                    keep[texts.first + doc] = False
            yield batch.filter(pa.array(keep))
    return run


def item_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[ItemIndex]:
    """Indexes over blocks of at most about ``BLOCK_CHARS`` characters of
    items, each with word frequencies counted over all texts of ``docs``."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()   # one block of items
        block = [(r["item_id"], w) for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
                 if len(w := word_hashes(r["text"]))]
        if not block:
            continue
        vocabulary = np.unique(np.concatenate([w for _, w in block]))
        counts = (texts.mapInArrow(_frequencies(vocabulary), "what string, word long, n long")
                  .groupBy("what", "word").agg(F.sum("n").alias("n")).collect())                   # words of the block
        frequency = {r["word"] % (1 << 64): r["n"] for r in counts if r["what"] == "word"}
        total = {r["what"]: r["n"] for r in counts if r["what"] != "word"}
        yield ItemIndex(block, frequency, total.get("words", 0), total.get("texts", 0))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per text (``docs``: ``doc_id, text``) and test item
    (``benchmark``: ``item_id, text``) that align with at least ``threshold``
    or share a passage (then ``score`` may be less), or short items found whole:
    ``doc_id, item_id, score, start_word, end_word`` (aligned words of the
    text, counted from 0). Clean texts have no row."""
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    result = None
    for index in item_blocks(docs, benchmark):
        shared = share(spark, index)                                               # bounded by BLOCK_CHARS
        numbers = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(index.items)],
                                        f"item long, item_id {item_type}")
        found = (base.mapInArrow(_scan(shared, threshold),
                                 f"doc_id {id_type}, item long, score double, start_word long, end_word long")
                 .join(F.broadcast(numbers), "item").select("doc_id", "item_id", "score", "start_word", "end_word"))
        result = found if result is None else result.unionByName(found)
    if result is None:
        return (base.where("false").select("doc_id", F.lit(None).cast(item_type).alias("item_id"),
                                           F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("start_word"),
                                           F.lit(0).cast("long").alias("end_word")))
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text aligns with no item."""
    kept = docs
    for index in item_blocks(docs, benchmark):
        kept = kept.mapInArrow(_clean(share(docs.sparkSession, index), docs.columns.index("text"), threshold),
                               docs.schema)
    return kept
