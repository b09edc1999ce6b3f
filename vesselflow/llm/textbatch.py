"""Vectorised text work on an Arrow batch: words, lines and n-grams as numpy arrays over the UTF-8 bytes.

Strings that must be compared are hashed to 64 bits with prefix sums of a polynomial, so no Python object is
made for a word. Work goes in chunks of whole documents of about CHUNK_BYTES, which bounds memory to a multiple
of the chunk or of the longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        for k, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(n + 1, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def release_memory() -> None:
    """Give freed memory back to the system: worker processes live on for later stages, beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[: at[-1]], at


def chunks(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows with about ``limit`` bytes."""
    buf, at = utf8(array)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, hi, buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def spans(buf: np.ndarray, at: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and rows of the maximal runs of bytes that aren't separators, within rows.
    ``separator``: a boolean for each of the 256 byte values."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[buf]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(at, starts, "right") - 1


# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotate(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rotate(acc + lane * P2, 31) * P1


@np.errstate(over="ignore")
def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each span of ``buf``."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    lane8 = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
    lane4 = np.ndarray(len(buf) + 1, "<u4", padded, strides=(1,))
    size, at, s = ends - starts, starts.copy(), np.uint64(seed)
    h = np.full(len(starts), s + P5)
    long = np.flatnonzero(size >= 32)
    if len(long):
        acc = [np.full(len(long), v) for v in (s + P1 + P2, s + P2, s, s - P1)]
        left = np.arange(len(long))
        while len(left):
            for k in range(4):
                acc[k][left] = _round(acc[k][left], lane8[at[long[left]] + 8 * k])
            at[long[left]] += 32
            left = left[ends[long[left]] - at[long[left]] >= 32]
        mixed = sum(_rotate(a, r) for a, r in zip(acc, (1, 7, 12, 18), strict=True))
        for a in acc:
            mixed = (mixed ^ _round(np.uint64(0), a)) * P1 + P4
        h[long] = mixed
    h += size.astype(np.uint64)
    for _ in range(3):
        own = np.flatnonzero(ends - at >= 8)
        h[own] = _rotate(h[own] ^ _round(np.uint64(0), lane8[at[own]]), 27) * P1 + P4
        at[own] += 8
    own = np.flatnonzero(ends - at >= 4)
    h[own] = _rotate(h[own] ^ (lane4[at[own]].astype(np.uint64) * P1), 23) * P2 + P3
    at[own] += 4
    for _ in range(3):
        own = np.flatnonzero(ends > at)
        h[own] = _rotate(h[own] ^ (buf[at[own]].astype(np.uint64) * P5), 11) * P1
        at[own] += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


class SpanHasher:
    """Hashes of any spans of one chunk by XXH64, which no periodic or mirrored text makes collide as it does the sums of
    ``Hasher``; a span costs a step for each eight bytes."""

    def __init__(self, buf: np.ndarray):
        self.buf = buf

    def __call__(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        return xxh64(self.buf, starts, ends, seed)


def equal_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> bool:
    """Whether each span has the bytes of the span number ``others`` of it."""
    size = ends - starts
    if (size != size[others]).any():
        return False
    own = np.flatnonzero(others != np.arange(len(others)))
    size = size[own]
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return bool((buf[within + np.repeat(starts[own], size)] == buf[within + np.repeat(starts[others[own]], size)]).all())


def exact_ids(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each span, equal where and only where the bytes are: numbers by hash, every span compared with the
    first of its number, under another seed if two differ."""
    seed = 0
    while True:
        _, first, ids = np.unique(xxh64(buf, starts, ends, seed), return_index=True, return_inverse=True)
        if equal_spans(buf, starts, ends, first[ids]):
            return ids.astype(np.uint64)
        seed += 1


def exact_windows(ids: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each ``size`` consecutive ids of one row, equal where and only where they are; and the index of
    each window's first item. Doubled from pairs of numbers, so that a pair fits 64 bits."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, have = ids, 1
    while have < size:
        step = min(have, size - have)
        pair = keys[: len(keys) - step] << np.uint64(32) | keys[step:]
        keys = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        have += step
    first = np.flatnonzero(rows[:n] == rows[size - 1 : size - 1 + n])
    return keys[first], first


class Hasher:
    """Hashes of any spans of one chunk, by prefix sums: a span costs the same whatever its length. Texts can be written
    that collide; where equality decides a result use ``exact_ids``."""

    def __init__(self, buf: np.ndarray):
        self.up, self.down = _power_tables(len(buf))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.up[: len(buf)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        poly = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix64(poly + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``size`` consecutive items of one row, and the index of each window's first item."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out = out * _BASE + hashes[k : k + n]
    first = np.flatnonzero(rows[:n] == rows[size - 1 : size - 1 + n])
    return mix64(out[first]), first


def per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of integer ``values`` by row (rows ascending)."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    at = np.searchsorted(rows, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether an equal key occurs earlier in its row, and its occurrence number from 0."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    k, r = keys[order], rows[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    at = np.arange(len(k))
    first = np.maximum.accumulate(np.where(new, at, 0)) if len(k) else at
    number = np.empty(len(k), np.int64)
    number[order] = at - first
    return number > 0, number
