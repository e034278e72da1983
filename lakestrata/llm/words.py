"""Vectorised word splitting and hashing of Arrow text columns (numpy, inside Spark tasks).

A batch of texts is one byte buffer plus offsets, so word borders, 64-bit word hashes and hashes of
k consecutive words come from a few array operations per slice instead of a Python loop per word.
Nulls count as empty texts. A word never crosses a document border.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: text that is split at once: a task holds some twenty times as much in arrays
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: separators of the word class ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` (after lower-casing A-Z)
_NON_ALNUM = np.zeros(256, bool)
_NON_ALNUM[0x00:0x30] = True
_NON_ALNUM[0x3A:0x61] = True
_NON_ALNUM[0x7B:0x80] = True
SEPARATORS = {"space": _SPACE, "alnum": _NON_ALNUM}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_MASKS = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 9)], dtype=np.uint64)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _M2
    h = h ^ (h >> _U(27))
    h = h * _M3
    return h ^ (h >> _U(31))


@dataclass
class Words:
    """Words of a slice of documents: word i is ``buf[starts[i]:ends[i]]``, and document d holds the
    words ``first[d]:first[d + 1]``."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes (eight bytes at a time)."""
        n = len(self.starts)
        length = self.ends - self.starts
        h = mix64(length.astype(np.uint64) * _M1 + _U(0x243F6A8885A308D3))
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        eight = np.ndarray((max(len(self.buf), 1),), dtype="<u8", buffer=padded.data, strides=(1,))
        live = np.arange(n)
        step = 0
        while len(live):
            left = length[live] - 8 * step
            chunk = eight[self.starts[live] + 8 * step] & _MASKS[np.minimum(left, 8)]
            h[live] = mix64((h[live] ^ chunk) * _M1 + _U(step))
            live = live[left > 8]
            step += 1
        return h

    def windows(self, k: int, word_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, 64-bit hash) of each window of k words inside one document."""
        n = len(word_hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        ends = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(n) + k <= ends)
        g = word_hashes[: n - k + 1].copy()
        for j in range(1, k):
            g *= _M3
            g += word_hashes[j: n - k + 1 + j]
        return at, mix64(g[at] + _U(k))


def text_slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with at most ``limit`` bytes of text
    together; a longer single text is a slice of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


def split(buf: np.ndarray, offsets: np.ndarray, kind: str, lower: bool) -> Words:
    """Words of one slice. ``kind`` names the separator class; ``lower`` maps A-Z to a-z first."""
    if lower:
        buf = _LOWER[buf]
    word = ~SEPARATORS[kind][buf]
    begin, end = word.copy(), word.copy()
    if len(word):
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edges = offsets[1:-1]
        at = edges[edges < len(word)]
        begin[at] = word[at]
        at = edges[edges > 0]
        end[at - 1] = word[at - 1]
    starts = np.flatnonzero(begin)
    return Words(buf, offsets, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def word_slices(column, kind: str = "space", lower: bool = False,
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for lo, hi, buf, offsets in text_slices(column, limit):
        yield lo, hi, split(buf, offsets, kind, lower)
