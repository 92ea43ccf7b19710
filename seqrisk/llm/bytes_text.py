"""Words and shingles of many texts at once, as numpy arrays over their bytes.

Used inside Arrow tasks (``mapInArrow``). A batch is worked through in blocks
of bounded bytes; every text is read whole. A word is a run of ASCII letters
and digits (A-Z lower-cased) and of bytes of non-ASCII characters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle


BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_U = np.uint64
cloudpickle.register_pickle_by_value(sys.modules[__name__])     # goes with the tasks that use it

_fold = np.zeros(256, np.uint8)
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalnum():
        _fold[_c] = ord(chr(_c).lower())
    elif _c >= 128:
        _fold[_c] = _c
FOLD = _fold


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def spread(i: int) -> np.uint64:
    """The i-th of a sequence of well mixed 64-bit offsets."""
    return _U(i * int(_BASE) % (1 << 64))


class _Powers:
    """base^i and base^-i modulo 2^64, grown when a longer block comes."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = base, _U(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, _U)

    def __reduce__(self):
        return _Powers, (self.base,)      # the tables are made anew where they are needed

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            ones = np.ones(n, _U)
            self.up, self.down = ones.copy(), ones
            self.up[1:], self.down[1:] = self.base, self.inverse
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up[:n], self.down[:n]


_powers = _Powers(_BASE)


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each span."""
    n = len(values)
    up, down = _powers.upto(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(values.astype(_U) * up[:n], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets within the bytes) of consecutive rows;
    a text longer than ``max_bytes`` is a block of its own. Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
        last = min(last, n)
        yield first, last - first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of true values; runs end at text borders."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    start = member.copy()
    start[1:] &= ~member[:-1] | border[1:n]
    end = member.copy()
    end[:-1] &= ~member[1:] | border[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, end and hash of every word, and each text's first word (n + 1)."""
    low = FOLD[data]
    start, end = runs(low != 0, offsets)
    return start, end, span_hashes(low, start, end), np.searchsorted(start, offsets)


def shingles(word: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle of ``size`` words; a text of fewer
    words has one shingle of all of them, a text of none has none."""
    n_words = np.diff(first)
    count = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(n_words)), count)
    skip = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=skip[1:])
    at = np.arange(len(doc)) - skip[doc] + first[doc]
    end = first[doc + 1] if len(doc) else at
    padded = np.concatenate([word, np.zeros(size, _U)])
    total = np.zeros(len(doc), _U)
    for j in range(size):
        part = mix(padded[at + j] + spread(j + 1))
        total = total * _U(31) + np.where(at + j < end, part, _U(0))
    return mix(total), doc


def weighted(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) with their counts, sorted by text and hash."""
    if not len(hashes):
        return hashes, doc, np.zeros(0, np.int64)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return h[at], d[at], np.diff(np.append(at, len(h)))
