"""Token counts by heap-and-linked-list byte-pair merging.

A string starts as one symbol per character, linked to its neighbours. A heap
holds every adjacent pair whose concatenation is a piece, by the piece's rank
(ties: leftmost). The lowest-ranked pair is merged, pairs with the new
neighbours are pushed, and stale heap entries are recognised by their length.
When the heap is empty the count is the initial symbols minus the merges; a
character outside the vocabulary falls back to its UTF-8 bytes, one token
each. No identifiers are built.

Strings are counted once per distinct *stretch*: text is cut between two ASCII
characters that stand side by side in no piece (no merge can cross such a
place), a rule read off the vocabulary. This covers word ends, since pieces
hold a space at their start only. Stretches seen before in a worker process
are looked up (at most ``CACHE_STRETCHES`` are kept).

The piece model here has identity normalisation, a space put before every
non-empty text, spaces written as U+2581, byte fallback, and ordinary-text
treatment of special strings; ``PieceRanks`` checks the model for what it
relies on.

Defined results: null and empty texts have no tokens. Very long texts are
counted whole. Pairs that tie in rank merge from left to right. Repeated rows
are counted each. An empty table gives no rows. Other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import worker_cache
from .textunits import Texts, Units, text_slices

CACHE_STRETCHES = 1_000_000
CACHE_BYTES = 48          # longer stretches are counted but not kept
SPACE_MARK = "▁"


class PieceRanks:
    """Ranks of a sentencepiece BPE model's pieces and the cut table."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.encode("  a b", out_type=str) != [SPACE_MARK * 2, SPACE_MARK + "a", SPACE_MARK + "b"]:
            raise ValueError("the model does not keep spaces as they are")
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in ids}
        # adjacency of ASCII characters in pieces; a space stands for its mark
        joined = np.zeros((256, 256), dtype=bool)
        joined[0x80:, :] = joined[:, 0x80:] = True
        for piece in self.rank:
            raw = piece.replace(SPACE_MARK, " ")
            for a, b in zip(raw, raw[1:]):
                if a < "\x80" and b < "\x80":
                    joined[ord(a), ord(b)] = True
        self.cut = ~joined

    def count(self, text: str) -> int:
        """Tokens of a stretch in which spaces are already marks."""
        rank = self.rank
        symbol = list(text)
        n = len(symbol)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(symbol[i] + symbol[i + 1])
            if r is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            left = symbol[i]
            j = after[i] if left is not None else n
            if j >= n or len(left) + len(symbol[j]) != size:
                continue                       # one side has been merged since
            left += symbol[j]
            symbol[i], symbol[j] = left, None
            merges += 1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                r = rank.get(left + symbol[j])
                if r is not None:
                    heapq.heappush(heap, (r, i, len(left) + len(symbol[j])))
            h = before[i]
            if h >= 0:
                r = rank.get(symbol[h] + left)
                if r is not None:
                    heapq.heappush(heap, (r, h, len(symbol[h]) + len(left)))
        unknown = sum(len(s.encode("utf-8")) - 1 for s in symbol if s is not None and len(s) == 1 and s not in rank)
        return n - merges + unknown


def count_tokens(texts: Texts, ranks: PieceRanks, known: dict) -> np.ndarray:
    """Tokens of each text of a slice (texts already begin with their space)."""
    buf = texts.buf
    cut = np.zeros(len(buf), dtype=bool)
    cut[1:] = ranks.cut[buf[:-1], buf[1:]]
    stretches = Units(texts, np.zeros(256, dtype=bool), cut=cut)
    if not len(stretches):
        return np.zeros(len(texts), np.int64)
    unique, first, at = np.unique(stretches.hashes(), return_index=True, return_inverse=True)
    if len(known) > CACHE_STRETCHES:
        known.clear()
    counts = np.empty(len(unique), dtype=np.int64)
    for k, (h, i) in enumerate(zip(unique.tolist(), first.tolist())):
        c = known.get(h)
        if c is None:
            raw = stretches.unit(i)
            c = ranks.count(raw.decode("utf-8").replace(" ", SPACE_MARK))
            if len(raw) <= CACHE_BYTES:
                known[h] = c
        counts[k] = c
    total = np.concatenate([[0], np.cumsum(counts[at])])
    return total[stretches.bounds[1:]] - total[stretches.bounds[:-1]]


def _count(model_file: str):
    def run(batches):
        kept = worker_cache("token-counts")
        if kept.get("file") != model_file:
            kept.clear()
            kept.update(file=model_file, ranks=PieceRanks(model_file), known={})
        ranks, known = kept["ranks"], kept["known"]
        for batch in batches:
            text = batch.column(1)
            spaced = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(" ", text, ""))
            parts = [count_tokens(t, ranks, known) for t in text_slices(spaced)]
            n = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.record_batch([batch.column(0), pc.binary_length(text).cast(pa.int64()), pa.array(n, pa.int64())],
                                  names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes`` (UTF-8)``, n_tokens, over_limit`` (``n_tokens >
    limit``), one row per input row. ``model_file``: a sentencepiece BPE model
    at the same place on all executors. Null texts are empty (0 tokens);
    repeated rows are counted each; other columns are ignored."""
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    counted = base.mapInArrow(_count(model_file), f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
