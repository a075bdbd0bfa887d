"""Vectorised word helpers that run inside Arrow tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D.  Those
bytes never occur inside a multi-byte UTF-8 character, so words are found on
the UTF-8 bytes.  Memory is bounded by ``CHUNK_BYTES`` (or one word, if a
single word is longer), never by a document or a batch.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

CHUNK_BYTES = (1 << 18) - 1
#: Values that are hashed together at a time.
CHUNK_VALUES = (1 << 16) - 1

#: Odd multipliers of the two independent polynomial hashes.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
#: Words of this many bytes or more are hashed by XXH64 instead of a polynomial.
LONG_WORD = 512

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _inverse(b: int) -> int:
    return pow(int(b), -1, 1 << 64)


@functools.cache
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i < n, modulo 2**64."""
    out = []
    for b in (int(BASES[which]), _inverse(int(BASES[which]))):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return tuple(out)


@functools.cache
def _byte_values(which: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + _U(1)) * BASES[1 - which])


def _table(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n - 1).bit_length())
    return _powers(which, size)


def rolling(h: np.ndarray, k: int, which: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values of ``h`` (length ``len(h)-k+1``)."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    step = max(1, CHUNK_VALUES - k)
    for i in range(0, n, step):
        part = h[i:i + step + k - 1]
        p, inv = _table(which, len(part) + 1)
        s = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * p[:len(part)], out=s[1:])
        out[i:i + step] = mix((s[k:] - s[:-k]) * inv[:len(part) - k + 1] + _U(k))
    return out


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column, nulls as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw - np.uint8(9)) < 5)


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions in ``raw``) of all words of the rows
    ``off`` delimits, and per row the index of its first word (length rows+1)."""
    starts, ends = [], []
    lo, hi = int(off[0]), int(off[-1])
    cuts = np.zeros(0, dtype=np.int64)
    inner = off[1:-1]
    at = lo
    while at < hi:
        to = min(hi, at + CHUNK_BYTES)
        space = is_space(raw[at:to])
        flip = np.ones(to - at, dtype=bool)           # a word character that starts a word
        flip[1:] = space[:-1]
        if at > lo and not is_space(raw[at - 1:at])[0]:
            flip[0] = False
        stop = np.ones(to - at, dtype=bool)           # a word character that ends a word
        stop[:-1] = space[1:]
        if to < hi and not is_space(raw[to:to + 1])[0]:
            stop[-1] = False
        a, b = np.searchsorted(inner, [at, to])
        first = inner[a:b]                            # row starts inside this chunk
        flip[first - at] = True
        a, b = np.searchsorted(inner, [at + 1, to + 1])
        stop[inner[a:b] - 1 - at] = True
        starts.append(np.flatnonzero(flip & ~space) + at)
        ends.append(np.flatnonzero(stop & ~space) + at + 1)
        at = to
    s = np.concatenate(starts) if starts else cuts
    e = np.concatenate(ends) if ends else cuts
    return s, e, np.searchsorted(s, off)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.zeros(len(starts), dtype=np.uint64)
    values, i = _byte_values(which), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")))
        at, to = int(starts[i]), int(ends[j - 1])
        if to - at <= CHUNK_BYTES:
            p, inv = _table(which, CHUNK_BYTES + 1)
            s = np.zeros(to - at + 1, dtype=np.uint64)
            np.cumsum(values[raw[at:to]] * p[:to - at], out=s[1:])
            a, b = starts[i:j] - at, ends[i:j] - at
            out[i:j] = mix((s[b] - s[a]) * inv[a] + (b - a).astype(np.uint64))
        i = j
    long = np.flatnonzero(ends - starts >= min(LONG_WORD, CHUNK_BYTES))
    if len(long):
        import xxhash
        for k in long:
            out[k] = xxhash.xxh64_intdigest(raw[starts[k]:ends[k]].tobytes(), seed=which + 1)
    return out


def groups_by_bytes(off: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (one row, if that is longer)."""
    out, i, n = [], 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        out.append((i, min(j, n)))
        i = min(j, n)
    return out


def ranges(s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """All positions of the ranges [s, e), in order; no range is empty."""
    if not len(s):
        return np.zeros(0, dtype=np.int64)
    step = np.ones(int((e - s).sum()), dtype=np.int64)
    step[0] = s[0]
    step[np.cumsum(e - s)[:-1]] = s[1:] - e[:-1] + 1
    return np.cumsum(step)
