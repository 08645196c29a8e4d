"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A *unit* is a maximal run of non-separator bytes inside one text. All
separators used here are ASCII, so byte classes and code point classes agree.
Each unit gets a 64-bit hash (polynomial over randomised byte values, then
mixed); hashes are stable over processes and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .tables import worker_cache

SLICE_BYTES = 1 << 20      # texts are handled in slices of about this many bytes
_U = np.uint64
_ROOT = 0x9E3779B97F4A7C15
_INVERSE = pow(_ROOT, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


BYTE_VALUES = mix64(np.arange(1, 257, dtype=_U) * _U(0xA0761D6478BD642F))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse; kept up to a bound."""
    kept = worker_cache("powers")
    if "both" not in kept or len(kept["both"][0]) < n:
        both = []
        for base in (_ROOT, _INVERSE):
            steps = np.full(max(n, 2 * SLICE_BYTES), base, dtype=_U)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if n > 8 * SLICE_BYTES:
            return both[0], both[1]
        kept["both"] = both
    return kept["both"][0], kept["both"][1]


def separators(spec: str) -> np.ndarray:
    """Boolean table over byte values: True where the byte separates units."""
    table = np.zeros(256, dtype=bool)
    table[list(spec.encode("ascii"))] = True
    return table


ASCII_SPACE = separators(" \t\n\x0b\x0c\r")
NOT_ALNUM = np.ones(256, dtype=bool)      # all ASCII but digits and letters
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Texts:
    """A slice of texts: ``buf`` holds their bytes, text i is
    ``buf[offsets[i]:offsets[i + 1]]``; ``first`` is its row in the batch."""

    __slots__ = ("buf", "offsets", "first")

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, first: int):
        self.buf, self.offsets, self.first = buf, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.buf[self.offsets[i]:self.offsets[i + 1]].tobytes().decode("utf-8")


def text_slices(column: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into slices of about ``max_bytes`` (a longer text
    is a slice of its own). Null texts are empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    base = 0
    for chunk in chunks:
        array = chunk.cast(pa.large_string()).fill_null("") if len(chunk) else chunk
        if not len(array):
            continue
        _, offs, data = array.buffers()
        offs = np.frombuffer(offs, dtype=np.int64)[array.offset:array.offset + len(array) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(array):
            hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), len(array))
            yield Texts(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], base + lo)
            lo = hi
        base += len(array)


class Units:
    """Units of a slice in text order. ``begin``/``end``: byte positions;
    ``bounds``: units of text i are ``bounds[i]:bounds[i + 1]``."""

    __slots__ = ("texts", "begin", "end", "bounds", "buf")

    def __init__(self, texts: Texts, separator: np.ndarray, buf: np.ndarray | None = None,
                 cut: np.ndarray | None = None):
        """``cut``: optional mask over bytes, True where a unit must also begin."""
        self.texts = texts
        self.buf = texts.buf if buf is None else buf
        n = len(self.buf)
        inside = ~separator[self.buf]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = texts.offsets[:-1][texts.offsets[:-1] < n]
        first[edges] = inside[edges]
        if cut is not None:
            first |= cut & inside
        self.begin = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.begin, texts.offsets)

    def __len__(self) -> int:
        return len(self.begin)

    def hashes(self) -> np.ndarray:
        if not len(self.begin):
            return np.zeros(0, _U)
        up, down = _powers(len(self.buf) + 1)
        total = np.zeros(len(self.buf) + 1, dtype=_U)
        np.cumsum(BYTE_VALUES[self.buf] * up[:len(self.buf)], out=total[1:])
        h = (total[self.end] - total[self.begin]) * down[self.begin]
        return mix64(h + (self.end - self.begin).astype(_U) * _U(0xE7037ED1A0B428DB))

    def unit(self, i: int) -> bytes:
        return self.buf[self.begin[i]:self.end[i]].tobytes()


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive units (``len(h) - n + 1`` values)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    out = np.zeros(m, dtype=_U)
    for j in range(n):
        out = (out ^ h[j:j + m]) * _U(0xA24BAED4963EE407) + _U(0x9FB21C651E98DF25 * (j + 1) % (1 << 64))
        out ^= out >> _U(29)
    return mix64(out)


def shingle_sets(units: Units, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its n-unit shingles; a shorter
    text's whole sequence counts as one; no units: an empty array."""
    h = units.hashes()
    grams = ngram_hashes(h, n)
    for a, b in zip(units.bounds[:-1], units.bounds[1:]):
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            yield ngram_hashes(h[a:b], b - a)
        else:
            yield np.zeros(0, _U)
