"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on the UTF-8 bytes of a whole Arrow string column at once:
words are runs of bytes outside ``[\\x20\\x09-\\x0D]`` (all ASCII, so a cut never
falls inside a code point), and a word's 64-bit hash is a random-weight
polynomial over its bytes, computed for all words of a column with a few numpy
passes.  Columns are worked in segments of about ``SEGMENT`` bytes, cut at word
ends, so the memory used does not grow with the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19  # some 40 bytes of numpy arrays for each byte
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_KEY = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_KEY = _BYTE_KEY[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string/binary column and its ``len + 1`` offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64, count=n + 1, offset=col.offset * 8)
    if bufs[2] is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def _powers(n: int) -> np.ndarray:
    w = np.empty(n, np.uint64)
    w[0] = 1
    if n > 1:
        w[1:] = _BASE
        np.multiply.accumulate(w, out=w)
    return w


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of the column, in order."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each non-empty byte span (spans are in order and disjoint)."""
    key = _LOWER_KEY if lower else _BYTE_KEY
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
        s, e = starts[i:j], ends[i:j]
        length = e - s
        first = np.zeros(len(s), np.int64)
        np.cumsum(length[:-1], out=first[1:])
        total = int(first[-1] + length[-1])
        in_word = np.arange(total, dtype=np.int64) - np.repeat(first, length)
        where = in_word + np.repeat(s, length)
        value = key[data[where]] * _powers(int(length.max()))[in_word]
        out[i:j] = np.add.reduceat(value, first) + length.astype(np.uint64) * _BASE
        i = j
    return mix64(out)


def words(col, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the column, index of each row's first word, one more at the end)."""
    data, offs = column_bytes(col)
    starts, ends = word_spans(data, offs)
    return span_hashes(data, starts, ends, lower), np.searchsorted(starts, offs, side="left")


def windows(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hash of every run of ``size`` words of the array."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, w in enumerate(mix64(np.arange(11, 11 + size, dtype=np.uint64) * _BASE) | _U(1)):
        out += word_hash[k:k + n] * w
    return mix64(out)


def shingle_sets(col, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct ``size``-word shingle hashes of each row (A-Z lower-cased words).

    A row with fewer words has its whole word sequence as its one shingle; a
    null row or one without words has the empty set.
    """
    hashes, first = words(col, lower=True)
    every = windows(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        if n >= size:
            s = every[a:b - size + 1].copy()
            s.sort()
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif n:
            out.append(mix64(windows(hashes[a:b], n) + _U(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
