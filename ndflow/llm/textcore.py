"""Vectorised text primitives for the Arrow-batch operators of this subpackage.

Texts come as Arrow string columns; their UTF-8 buffer is used directly as a
numpy byte array.  A slice holds whole documents and about ``SLICE_BYTES`` of
text, so the temporary arrays stay small whatever the batch size; one very
long document is a slice of its own and its words are hashed piecewise.

Words are maximal runs of word bytes (a 256-entry mask).  Every byte of a
multi-byte UTF-8 character is >= 0x80, so byte classes that treat all of them
alike never cut a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

U64 = np.uint64
#: Odd 64-bit constants (fixed values): byte base, its inverse, window bases.
BYTE_BASE = 0x9E3779B97F4A7C15
BYTE_BASE_INV = pow(BYTE_BASE, -1, 1 << 64)
WINDOW_BASE = 0xD6E8FEB86659FD93
CHECK_BASE = 0xA0761D6478BD642F

#: Word bytes: anything but space and \t \n \v \f \r.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes after lower-casing: digits, a-z and everything above ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Slice:
    """Whole documents of one batch: rows ``lo..hi``, their bytes and the
    byte offsets of the documents (``hi - lo + 1`` values, first 0)."""

    __slots__ = ("lo", "hi", "data", "offsets")

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    @property
    def n_docs(self) -> int:
        return self.hi - self.lo

    def doc(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices; a null is a document without bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off_buf, data_buf = column.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Slice(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


_POW: dict[str, np.ndarray] = {"p": np.ones(1, U64), "i": np.ones(1, U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["p"]) < n:
        size = max(n, 1 << 16)
        for k, base in (("p", BYTE_BASE), ("i", BYTE_BASE_INV)):
            a = np.full(size, base, dtype=U64)
            a[0] = 1
            _POW[k] = np.cumprod(a, dtype=U64)
    return _POW["p"], _POW["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of the 64-bit hashes (xor-shift multiply), on a copy."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Words:
    """Words of a slice: byte spans ``start``/``end``, 64-bit ``hash``, and
    ``first`` (index of each document's first word; ``n_docs + 1`` values)."""

    __slots__ = ("start", "end", "hash", "first")

    def __init__(self, s: Slice, mask: np.ndarray, lower: bool = False):
        data = LOWER[s.data] if lower else s.data
        n = len(data)
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U64)
            self.first = np.zeros(s.n_docs + 1, np.int64)
            return
        w = mask[data]
        opens = w.copy()
        opens[1:] &= ~w[:-1]
        closes = w.copy()
        closes[:-1] &= ~w[1:]
        cuts = s.offsets[1:-1]  # a word never crosses into the next document
        cuts = cuts[(cuts > 0) & (cuts < n)]
        opens[cuts] |= w[cuts]
        closes[cuts - 1] |= w[cuts - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, s.offsets)
        self.hash = _span_hashes(data, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, piece: int = SLICE_BYTES) -> np.ndarray:
    """64-bit hash of every byte span (a polynomial in an odd base, from
    prefix sums, then mixed); equal bytes give equal hashes anywhere."""
    out = np.empty(len(start), U64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + piece, side="right")))
        base = int(start[a])
        seg = data[base:int(end[b - 1])]
        p, inv = _powers(len(seg) + 1)
        c = np.cumsum((seg.astype(U64) + U64(1)) * p[:len(seg)], dtype=U64)
        c = np.concatenate([np.zeros(1, U64), c])
        st, en = start[a:b] - base, end[a:b] - base
        out[a:b] = (c[en] - c[st]) * inv[st]
        a = b
    return mix64(out + U64(0x2545F4914F6CDD1D))


def window_hashes(h: np.ndarray, k: int, base: int = WINDOW_BASE) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (len - k + 1 values,
    crossing documents: mask them with ``window_starts``)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, U64)
    x = h[:m].copy()
    b = U64(base)
    for j in range(1, k):
        x *= b
        x += h[j:j + m]
    return mix64(x + U64(k))


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Word indexes at which a window of ``k`` words of one document starts."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, np.int64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(left >= k)


def cover(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``k`` words at ``starts``."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + k, n), minlength=n + 1)
    return np.cumsum(d[:n]) > 0


def doc_sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per-document sums of a per-word array."""
    c = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
    return c[first[1:]] - c[first[:-1]]


def member(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, index) of each ``x`` in a sorted array."""
    if len(sorted_keys) == 0:
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    i = np.searchsorted(sorted_keys, x)
    i[i == len(sorted_keys)] = 0
    return sorted_keys[i] == x, i


def run_lengths(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start, and how long each is."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])
    return at, np.diff(np.concatenate([at, [len(sorted_values)]]))


def separator_cuts(data: np.ndarray, word: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``max_bytes`` that cover a text and end before a byte
    that is no word byte, so no word is cut."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + max_bytes)
        while b < n and word[data[b]]:
            gaps = np.flatnonzero(~word[data[b:b + max_bytes]])
            b = b + int(gaps[0]) if len(gaps) else min(n, b + max_bytes)
        yield a, b
        a = b
