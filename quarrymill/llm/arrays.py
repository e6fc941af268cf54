"""Texts of an Arrow batch as numpy arrays: bytes, words, hashes. Used inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 1 << 21
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_ROOT, _ODD = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
SHORT = 64  # bytes of a span that are hashed and compared eight at a time, all spans together
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # masks of the first k bytes


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts and ends; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, at, data = col.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def text_blocks(col: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each block of a text column."""
    buf, offsets = text_bytes(col)
    for lo, hi in blocks(offsets, limit):
        yield lo, hi, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each) of the words, which white space or a row's border ends."""
    n = len(buf)
    inside = ~SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1] | edge[1:n]
        last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, rows_of(offsets, starts)


def rows_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(offsets, at, side="right") - 1


def eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, the first byte lowest; 0 past the end."""
    w = np.zeros(len(buf) + 8, U64)
    w[: len(buf)] = buf
    for k in (1, 2, 4):
        w[:-k] |= w[k:] << U64(8 * k)
    return w[: len(buf)]


def _eight(padded: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same for some places, of which only the first `size` bytes count."""
    rows = np.lib.stride_tricks.sliding_window_view(padded, 8)[at]
    return np.ascontiguousarray(rows).view("<u8").ravel() & _FIRST[np.minimum(size, 8)]


def _padded(buf: np.ndarray) -> np.ndarray:
    return np.concatenate([buf, np.zeros(8, np.uint8)])


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span.

    Eight bytes at a time are mixed in, so no structure of a text makes two spans meet; where
    equality counts, number_spans compares the bytes as well. Long spans are digested one by one.
    """
    size = ends - starts
    h = mix(size.astype(U64) * _ROOT + _ODD)
    padded, live, j = _padded(buf), np.flatnonzero((size > 0) & (size <= SHORT)), 0
    while len(live):
        h[live] = mix(h[live] ^ (_eight(padded, starts[live] + j, size[live] - j) * _ODD))
        j += 8
        live = live[size[live] > j]
    for i in np.flatnonzero(size > SHORT).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return h


def same_bytes(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Are the `sizes` bytes of buf from `starts` those of other from `at`, span by span?"""
    out = np.ones(len(starts), bool)
    a, b, live, j = _padded(buf), _padded(other), np.flatnonzero((sizes > 0) & (sizes <= SHORT)), 0
    while len(live):
        left = sizes[live] - j
        out[live] = _eight(a, starts[live] + j, left) == _eight(b, at[live] + j, left)
        j += 8
        live = live[out[live] & (sizes[live] > j)]
    for i in np.flatnonzero(sizes > SHORT).tolist():
        out[i] = np.array_equal(buf[starts[i] : starts[i] + sizes[i]], other[at[i] : at[i] + sizes[i]])
    return out


def number_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each span, a span of each number): spans have one number where their bytes are equal."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, number = np.unique(span_hash(buf, starts, ends), return_index=True, return_inverse=True)
    size, like = ends - starts, first[number]
    if not ((size == size[like]).all() and same_bytes(buf, starts, size, buf, starts[like]).all()):
        data, seen = buf.tobytes(), {}  # two spans share a hash: number them by their bytes
        number = np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        first = np.unique(number, return_index=True)[1]
    return number, first


def number_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers from 0, equal where both are."""
    wide = int(b.max()) + 1 if len(b) else 1
    return np.unique(a.astype(np.int64) * wide + b, return_inverse=True)[1]


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of `width` words; rows with fewer words, but some, give one for all of them."""
    if len(hashes) == 0:
        return hashes, rows
    run = np.zeros(max(0, len(hashes) - width + 1), U64)
    for j in range(width):
        run = run * _ODD + hashes[j : j + len(run)]
    whole = rows[: len(run)] == rows[width - 1 :] if len(run) else np.zeros(0, bool)
    out, own = mix(run[whole] + U64(width)), rows[: len(run)][whole]
    counts = np.bincount(rows, minlength=n_rows)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        at, h = np.searchsorted(rows, short), np.zeros(len(short), U64)
        for j in range(width - 1):
            has = counts[short] > j
            h = np.where(has, h * _ODD + hashes[np.minimum(at + j, len(hashes) - 1)], h)
        out = np.concatenate([out, mix(h + counts[short].astype(U64))])
        own = np.concatenate([own, short])
        order = np.argsort(own, kind="stable")
        out, own = out[order], own[order]
    return out, own


def counts_by_row(rows: np.ndarray, n_rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Exact 64-bit counts, or sums of integers below 2**53, by row."""
    return np.bincount(rows, weights, minlength=n_rows).astype(np.int64)


class Memo:
    """Numbers that belong to byte strings: found by hash, confirmed by their bytes.

    It is emptied when it has grown beyond `most` strings; that costs time, never results.
    """

    LONGEST = 1024  # longer strings are not kept

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.values = np.zeros(0, U64), np.zeros(0, np.int64)
        self.at, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store, self.used = np.zeros(1 << 16, np.uint8), 0

    def get(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fill) -> np.ndarray:
        """Numbers of distinct spans of buf; fill(indices of spans) gives those that are not known."""
        keys, sizes = span_hash(buf, starts, ends), ends - starts
        at = np.searchsorted(self.keys, keys)
        held = np.flatnonzero(at < len(self.keys))
        held = held[self.keys[at[held]] == keys[held]]
        taken = np.zeros(len(keys), bool)
        taken[held] = True
        held = held[self.sizes[at[held]] == sizes[held]]
        held = held[same_bytes(buf, starts[held], sizes[held], self.store, self.at[at[held]])]
        out, known = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        out[held], known[held] = self.values[at[held]], True
        if not known.all():
            miss = np.flatnonzero(~known)
            out[miss] = fill(miss)
            new = miss[~taken[miss] & (sizes[miss] <= self.LONGEST)]
            new = new[np.unique(keys[new], return_index=True)[1]]
            self._keep(buf, starts[new], sizes[new], keys[new], out[new])
        return out

    def _keep(self, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray, values: np.ndarray) -> None:
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        end = self.used + np.cumsum(sizes)
        total = int(sizes.sum())
        if self.used + total > len(self.store):
            self.store = np.concatenate([self.store[: self.used], np.zeros(max(total, self.used), np.uint8)])
        self.store[self.used : self.used + total] = buf[np.repeat(starts - (end - sizes), sizes) + np.arange(self.used, self.used + total)]
        self.used += total
        order = np.argsort(both := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = both[order]
        self.values, self.at, self.sizes = (np.concatenate(x)[order] for x in ((self.values, values), (self.at, end - sizes), (self.sizes, sizes)))
