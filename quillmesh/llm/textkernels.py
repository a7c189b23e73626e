"""Numpy kernels over UTF-8 text that arrives in Arrow batches.

A column of texts is packed into one byte buffer in which every text is followed by a line feed.
Words, lines and n-grams are then ranges of that buffer, and their 64-bit hashes come from two
prefix sums, one modulo 2^64 and one modulo the prime 2^31 - 1, so no Python object is made for a word.
The prime keeps apart strings that any polynomial modulo a power of two confuses (long Thue-Morse words). Buffers are cut to a quarter of a megabyte or one text, whatever
the size of the Arrow batch; a text is never cut.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_PRIME, _BASE31 = (1 << 31) - 1, 0x5DEECE66
_INVERSE31 = pow(_BASE31, -1, _PRIME)
#: Powers of the base and of its inverse, modulo 2^64 and modulo the prime.
_POWERS: list[np.ndarray] = [np.ones(1, U) for _ in range(4)]

#: ASCII white space: \x20 and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = ~SPACE
#: A to Z become lower case, all else stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def folded(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^63 to the same below 2^33, modulo the prime."""
    high = x >> U(31)
    high += x & U(_PRIME)
    return high


def reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^63 modulo the prime."""
    x = folded(folded(x))
    x[x >= U(_PRIME)] -= U(_PRIME)
    return x


def _powers(n: int, k: int) -> np.ndarray:
    if len(_POWERS[k]) < n:
        n += n >> 3
        if k < 2:
            p = np.full(n, (_BASE, _INVERSE)[k], U)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
        else:
            base, p = (_BASE31, _INVERSE31)[k - 2], np.ones(n, np.uint32)
            at = 1
            while at < n:
                step = min(at, n - at, PART)
                p[at : at + step] = reduced(p[:step].astype(U) * U(pow(base, at, _PRIME)))
                at += step
        _POWERS[k] = p
    return _POWERS[k]


#: Bytes for which prefix sums are made at a time.
PART = 1 << 19


class Packed:
    """``buf``: bytes of the texts, each followed by a line feed; text i is buf[off[i]:off[i+1]-1]."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self.n = buf, off, len(off) - 1
        self._sum: dict[tuple[int, bool], np.ndarray] = {}

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes for which ``table`` holds; it must not hold for \\n."""
        m = np.zeros(len(self.buf) + 1, np.int8)
        m[:-1] = table[self.buf]
        d = np.flatnonzero(np.diff(m, prepend=np.int8(0)))
        return d[0::2], d[1::2]

    def rows(self, starts: np.ndarray) -> np.ndarray:
        """The row that holds each of the sorted positions."""
        return np.repeat(np.arange(self.n), np.diff(np.searchsorted(starts, self.off)))

    def _sums(self, fold: np.ndarray, prime: bool) -> np.ndarray:
        if (key := (id(fold), prime)) not in self._sum:
            n = len(self.buf)
            power, c, last = _powers(n + 1, 2 * prime), np.zeros(n + 1, np.uint32 if prime else U), U(0)
            for a in range(0, n, PART):
                x = fold[self.buf[a : a + PART]].astype(U)
                x += U(1)
                x *= power[a : a + len(x)]
                x = np.cumsum(folded(x) if prime else x) + last
                c[a + 1 : a + 1 + len(x)] = x = reduced(x) if prime else x
                last = x[-1]
            self._sum[key] = c
        return self._sum[key]

    def rolling(self, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
        """64-bit hashes of buf[start:end] modulo 2^64 alone: for sampling and for features, where a rare collision does no harm."""
        c = self._sums(fold, False)
        return mix((c[ends] - c[starts]) * _powers(len(self.buf) + 1, 1)[starts])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
        """64-bit hashes of buf[start:end] after ``fold``, the same for the same bytes anywhere."""
        c = self._sums(fold, True)
        h = reduced((c[ends].astype(U) + U(_PRIME) - c[starts]) * _powers(len(self.buf) + 1, 3)[starts])
        return mix(self.rolling(starts, ends, fold) ^ mix(h + U(1)))

    def keys(self, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
        """64-bit hashes of mostly short buf[start:end] after ``fold``, the same for the same bytes anywhere: eight bytes at a time, without sums over all bytes."""
        length = ends - starts
        raw = np.zeros((len(self.buf) >> 3) + 2, U)  # aligned words, the last one beyond all bytes
        raw.view(np.uint8)[: len(self.buf)] = self.buf if fold is SAME else fold[self.buf]
        h = mix(length.astype(U))
        at, left, some = starts, length, slice(None)
        for _ in range(_KEY_BYTES // 8):
            word, bit = at >> 3, ((at & 7) << 3).astype(U)
            x = raw[word] >> bit | raw[word + 1] << U(1) << (U(63) - bit)
            h[some] = mix(h[some] ^ (x & _LOW[np.minimum(left, 8)]))
            more = np.flatnonzero(left > 8)
            if not len(more):
                break
            some = more if isinstance(some, slice) else some[more]
            at, left = at[more] + 8, left[more] - 8
        long = np.flatnonzero(length > _KEY_BYTES)
        if len(long):
            h[long] = self.hashes(starts[long], ends[long], fold)
        return h


#: What ``keys`` reads by words; longer parts are hashed by sums. And masks of the lowest bytes.
_KEY_BYTES = 512
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def strings(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_string())


def packs(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int, Packed]]:
    """(first row, row after the last, Packed) of parts of a text column; null counts as empty."""
    empty, feed = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    text = pc.binary_join_element_wise(strings(column), empty, feed, null_handling="replace", null_replacement="")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    n = len(text)
    if not n:
        return
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, b, Packed(data[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b
    trim()


def trim(keep: int = 1 << 22) -> None:
    """Hands freed memory back to the system, where the C library can, and with it tables that one very long text made large."""
    for k, p in enumerate(_POWERS):
        if len(p) > keep:
            _POWERS[k] = np.ones(1, U)
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, for steps that hold several copies of what they work on."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ngrams(word: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one row, and the index of each one's first word."""
    if len(word) < n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    first = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
    h = np.zeros(len(first), U)
    for k in range(n):
        h = (h + word[first + k]) * U(0xD6E8FEB86659FD93) + U(k + 1)
        h ^= h >> U(32)
    return mix(h), first


def sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each row, as long."""
    return np.bincount(row, values, n).astype(np.int64) if len(row) else np.zeros(n, np.int64)


def counts(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)
