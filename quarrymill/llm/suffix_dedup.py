"""Removal of byte strings that occur in an earlier document, by suffix arrays of shards.

1. Equal texts are one: all but the first copy go as wholes.
2. Texts are dealt out by their ids into groups, and groups are cut into shards of some megabytes.
   Every 50-byte window has an anchor, its least 20-byte string by hash, so equal windows have equal
   anchors, and equal bytes on the longer side of it. A shard asks which of its anchors, with codes
   of the bytes beside them, other shards have; anchors are sent by range of their hashes, sorted,
   and the answer is a flag for each.
3. A shard sorts the suffixes of the windows that may repeat, in it or elsewhere, by Larsson-Sadakane
   refinement; Kasai's common prefixes cut the suffix array into classes of equal windows. Within a
   class the windows of all but its least document are removed at once; those of the least document
   go on where other shards may have them, as segments: the windows of one anchor.
4. Shards meet by anchor: sorted runs of windows are merged by binary search to the least document of
   each window, and every run looks its own windows up there. Anchors that very many windows have
   are hot: each of their windows goes by itself, keyed by all of its bytes.
5. Each document removes the union of its removed windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import suffixes
from .arrays import U64, blocks, eights, mix, number_pairs, rows_of, span_hash, text_bytes

WIDTH, GRAM = 50, 20
SIDE = 15  # of a window's bytes beside its anchor, so many at least are on one side
SPLIT = 16  # windows that start so far before their anchor have SIDE bytes left of it, others right
UNIT_BYTES = 1 << 21  # of texts in a shard, about
PIECE_BYTES, ANCHOR_BYTES = 1 << 20, 1 << 19  # of a long text; of texts whose anchors are found at a time
HOT_FROM = 1 << 16  # anchors found so often are hot; counts of a shard are rounded up to powers of two
RUNS = 8  # sorted runs that are merged at a time
LEFT, RIGHT, HOT = 1, 2, 4
_POS = 27  # bits of a sliding key that hold the position
_ID, _LOW, _CODE = 48, 32, 14  # bits: of an anchor's id, of its part that is sent as it is, of a code


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on that has so many."""
    w, n = eights(buf), len(buf) - GRAM + 1
    h = w[:n] * U64(0x9E3779B97F4A7C15) + w[8 : n + 8] * U64(0xC2B2AE3D27D4EB4F) + (w[16 : n + 16] & U64(0xFFFFFFFF)) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def anchors(buf: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, anchor position, anchor hash) of every window of the rows, in order."""
    empty = np.zeros(0, np.int64)
    n, span = len(buf) - gram + 1, width - gram + 1
    if len(buf) < width:
        return empty, empty, empty.view(U64)
    h = _gram_hashes(buf)
    bits = U64(max(_POS, len(buf).bit_length()))
    padded = np.full(-(-n // span) * span, ~U64(0), U64)
    padded[:n] = h >> bits << bits
    padded[:n] |= np.arange(n, dtype=U64)
    grid = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - span + 1], ahead[span - 1 : n])
    inside = np.ones(len(least), bool)
    for end in offsets[1:-1].tolist():  # windows across a border
        inside[max(0, end - width + 1) : end] = False
    starts = np.flatnonzero(inside)
    p = (least[starts] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    return starts, p, h[p]


class Shard:
    """Some texts (or pieces of long ones): where they come from, their bytes, and their anchors.

    Windows of one anchor follow each other; `first`, `count` and `place` say which and where the
    anchor is. A record is an anchor's id with the codes of the bytes beside it (0: there are none).
    """

    def __init__(self, docs: np.ndarray, copies: np.ndarray, bases: np.ndarray, texts: list[memoryview]):
        self.docs, self.copies, self.bases = docs, copies, bases
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        parts = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 3]
        for lo, hi in blocks(self.offsets, ANCHOR_BYTES):
            at, off = self.offsets[lo], self.offsets[lo : hi + 1] - self.offsets[lo]
            part = self.buf[at : self.offsets[hi]]
            starts, p, h = anchors(part, off)
            turn = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.zeros(0, np.int64)
            count, starts, p, h = np.diff(np.append(turn, len(p))), starts[turn], p[turn], h[turn]
            row = rows_of(off, p)
            left, right = (self._code(part, x, (x >= off[row]) & (x + SIDE <= off[row + 1])) for x in (p - SIDE, p + GRAM))
            parts.append((starts + at, count, p + at, h, left, right))
        self.first, self.count, self.place, self.hash, self.left, self.right = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.row = rows_of(self.offsets, self.place)
        self.id = mix(self.hash ^ U64(0xA0761D6478BD642F)) >> U64(64 - _ID)  # anchors have small hashes; ids are spread evenly
        codes = self.left << U64(_CODE) | self.right
        order = np.lexsort((codes, self.id))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.id[order]) != 0) | (np.diff(codes[order]) != 0)
        self.record = np.empty(len(order), np.int64)  # of each anchor
        self.record[order] = np.cumsum(new) - 1
        heads = order[new]
        times = np.ceil(np.log2(np.maximum(np.bincount(self.record), 1))).astype(U64)
        self.ids, self.codes = self.id[heads], (codes[heads] | np.minimum(times, U64(15)) << U64(2 * _CODE)).astype(np.uint32)

    @staticmethod
    def _code(part: np.ndarray, start: np.ndarray, ok: np.ndarray) -> np.ndarray:
        start = np.where(ok, start, 0)
        return np.where(ok, span_hash(part, start, start + np.where(ok, SIDE, 0)) % U64((1 << _CODE) - 1) + U64(1), U64(0))

    def bucket_slices(self, buckets: int) -> Iterator[tuple[int, int, int]]:
        """(bucket, first record, end) for ranges of the ids."""
        edges = np.searchsorted(bucket_of(self.ids, buckets), np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            yield b, int(edges[b]), int(edges[b + 1])


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The range that an id lies in; ranges do not cut the part that _pack sends as it is."""
    return (ids >> U64(_LOW)) * U64(buckets) >> U64(_ID - _LOW)


def _base(bucket: int, buckets: int) -> int:
    return -(-(bucket << (_ID - _LOW)) // buckets)


def pack_ids(ids: np.ndarray, codes: np.ndarray, bucket: int, buckets: int) -> bytes:
    """Sorted ids of a bucket: low parts, codes, and the high parts in unary."""
    ones = ((ids >> U64(_LOW)).astype(np.int64) - _base(bucket, buckets)) + np.arange(len(ids))
    bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    bits[ones] = 1
    return len(ids).to_bytes(4, "little") + (ids & U64(0xFFFFFFFF)).astype("<u4").tobytes() + codes.astype("<u4").tobytes() + np.packbits(bits).tobytes()


def unpack_ids(data: bytes, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    low, codes = np.frombuffer(data, "<u4", n, 4).astype(U64), np.frombuffer(data, "<u4", n, 4 + 4 * n)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=4 + 8 * n)))[:n]
    return (ones - np.arange(n) + _base(bucket, buckets)).astype(U64) << U64(_LOW) | low, codes


def _in_several(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: has another owner the same key? Also the order by key, and where each key begins there."""
    order = np.argsort(key)
    k, own = key[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    out = np.zeros(len(k), bool)
    if len(k):
        several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
        out[order] = np.repeat(several, np.diff(np.append(first, len(k))))
    return out, order, first


def sides(ids: np.ndarray, left: np.ndarray, right: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """LEFT and RIGHT where another owner has the id and the code on that side."""
    a, b = (_in_several(ids << U64(_CODE) | code, owner)[0] & (code > 0) for code in (left, right))
    return a * np.uint8(LEFT) | b * np.uint8(RIGHT)


_ASKED = "bucket int, unit long, asked binary"
_TOLD = "unit long, bucket int, flags binary"


def _answer(batches: Iterator[pa.RecordBatch], buckets: int, hot_from: int) -> Iterator[pa.RecordBatch]:
    """Rows _ASKED sorted by bucket to rows _TOLD: a byte of flags for each record, where any is set."""

    def flush(bucket: int, units: list[int], asked: list[bytes]) -> pa.RecordBatch:
        both = [unpack_ids(x, bucket, buckets) for x in asked]
        ids, codes = (np.concatenate(x) for x in zip(*both, strict=True))
        ends = np.cumsum([len(x[0]) for x in both])
        owner = np.repeat(np.arange(len(both)), np.diff(ends, prepend=0))
        mask = np.uint32((1 << _CODE) - 1)
        flags = sides(ids, (codes >> np.uint32(_CODE) & mask).astype(U64), (codes & mask).astype(U64), owner)
        _, order, first = _in_several(ids, owner)
        often = np.add.reduceat((1 << (codes[order] >> np.uint32(2 * _CODE)).astype(np.int64)), first) >= hot_from
        flags[order] |= np.repeat(often, np.diff(np.append(first, len(ids)))) * np.uint8(HOT)
        cut = [x.tobytes() for x in np.split(flags, ends[:-1])]
        some = [i for i, x in enumerate(cut) if x.strip(b"\0")]
        cols = [pa.array([units[i] for i in some], pa.int64()), pa.array([bucket] * len(some), pa.int32()), pa.array([cut[i] for i in some], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["unit", "bucket", "flags"])

    held: tuple[list[int], list[bytes]] = ([], [])
    last = None
    for b in batches:
        for bucket, unit, asked in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if bucket != last and held[0]:
                yield flush(last, *held)
                held = ([], [])
            last = bucket
            held[0].append(unit)
            held[1].append(asked)
    if held[0]:
        yield flush(last, *held)


_PIECE = "key long, doc long, copy int, start int, n int, bytes binary, more binary"
_SPAN = ["doc", "copy", "start", "n"]


def _rows(doc, copy, start, n, key=None, data=None, more=None) -> pa.RecordBatch:
    """Rows _PIECE; without data, windows that are removed already. n is 0 for a hot window.

    more: other places of the same text that hold the same bytes, as 32-bit numbers.
    """
    key = np.zeros(len(doc), np.int64) if key is None else key
    data = pa.nulls(len(doc), pa.binary()) if data is None else data
    cols = [pa.array(key), pa.array(doc), *(pa.array(x.astype(np.int32)) for x in (copy, start, n)), data, pa.nulls(len(doc), pa.binary()) if more is None else more]
    return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _PIECE.split(", ")])


def _runs(group: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of runs of neighbouring positions `at` within equal groups."""
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1])
    first = np.flatnonzero(head)
    return first, np.diff(np.append(first, len(at)))


def window_classes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A class number for each window start: equal where the windows' bytes are equal.

    starts: sorted; ends: where the text of each ends. Only the bytes under these windows are sorted.
    """
    edge = np.zeros(len(buf) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    used = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    # texts and gaps end a region; its last suffixes are shorter than a window
    end_of = np.zeros(len(buf), np.int64)
    end_of[starts] = ends
    owner = np.maximum.accumulate(np.where(end_of[used] > 0, end_of[used], 0))
    head = np.ones(len(used), bool)
    head[1:] = (used[1:] != used[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(head)
    stop = np.repeat(np.append(first[1:], len(used)), np.diff(np.append(first, len(used))))
    symbols = buf[used] + np.uint8(1)  # no byte of UTF-8 is 255, so 0 is free for "past the end"
    packed = np.zeros(len(used), U64)
    room = stop - np.arange(len(used))
    for j in range(8):
        ahead = np.zeros(len(used), np.uint8)
        ahead[: len(used) - j] = symbols[j:]
        ahead[room <= j] = 0
        packed = packed << U64(8) | ahead
    sa, ranks, _ = suffixes.refine(packed, stop, length=8)
    lcp = suffixes.kasai(symbols, sa, ranks, stop, width)
    number = np.zeros(len(used), np.int64)
    number[sa] = np.cumsum(lcp < width)
    return number[np.searchsorted(used, starts)]


def _once(at: np.ndarray, n: np.ndarray, hot: np.ndarray, number: np.ndarray, rows: np.ndarray, place) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The first of the segments with equal bytes in a text, and the places of the others.

    The first and the last window of a segment cover it, so their classes tell its bytes.
    """
    same = number_pairs(number_pairs(number_pairs(number[at], number[at + n - 1]), n), rows[at])
    order = np.argsort(same, kind="stable")
    head = np.flatnonzero(np.concatenate([[True], np.diff(same[order]) != 0])) if len(at) else order
    size = np.diff(np.append(head, len(at)))
    others = np.split(place(at[order]).astype("<i4"), head[1:])
    more = pa.array([x[1:].tobytes() if len(x) > 1 else None for x in others] if (size > 1).any() else [None] * len(head), pa.binary())
    one = order[head]
    return at[one], n[one], hot[one], more


def _shard(shard: Shard, flags: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows removed within the shard, and segments for the others that flags (of its records) ask for."""
    buf, docs = shard.buf, shard.docs
    away = flags[shard.record]
    here = sides(shard.id, shard.left, shard.right, docs[shard.row])
    turn = np.flatnonzero((away | here) & (LEFT | RIGHT))
    n = shard.count[turn]
    turn = np.repeat(turn, n)
    starts = shard.first[turn] + np.arange(len(turn)) - np.repeat(np.cumsum(n) - n, n)
    side = np.where(shard.place[turn] - starts >= SPLIT, LEFT, RIGHT)
    ok = ((away | here)[turn] & side) > 0
    starts, turn, side = starts[ok], turn[ok], side[ok]
    if not len(starts):
        return
    rows = shard.row[turn]
    doc = docs[rows]
    number = window_classes(buf, starts, shard.offsets[rows + 1])
    order = np.argsort(number, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], number[order][1:] != number[order][:-1]]))
    least = np.empty(len(starts), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))

    def place(at: np.ndarray) -> np.ndarray:
        return starts[at] - shard.offsets[rows[at]] + shard.bases[rows[at]]

    def made(at: np.ndarray, n: np.ndarray, *rest) -> pa.RecordBatch:
        return _rows(docs[rows[at]], shard.copies[rows[at]], place(at), n, *rest)

    gone = np.flatnonzero(doc > least)
    at, n = _runs(rows[gone], starts[gone])
    at = gone[at]
    yield made(at, n, mix(starts[at].astype(U64) + docs[rows[at]].astype(U64) * U64(0x9E3779B97F4A7C15)).view(np.int64))
    left = np.flatnonzero((doc == least) & ((away[turn] & side) > 0))
    hot = (away[turn[left]] & HOT) > 0
    at, n = _runs(np.where(hot, -1 - np.arange(len(left)), turn[left]), starts[left])
    at, hot = left[at], hot[at]
    at, n, hot, more = _once(at, n, hot, number, rows, place)
    key = np.where(hot, U64(0), shard.hash[turn[at]])
    key[hot] = span_hash(buf, starts[at[hot]], starts[at[hot]] + WIDTH)
    size = n + (WIDTH - 1)
    end = np.cumsum(size)
    data = buf[np.repeat(starts[at] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
    segments = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.concatenate([[0], end]).astype(np.int32)), pa.py_buffer(data)])
    yield made(at, np.where(hot, 0, n), key.view(np.int64), segments, more)


def merge_sorted(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted runs (key, doc, place), one row a key, to one: each key with its least document."""
    while len(runs) > 1:
        merged = []
        for a, b in zip(runs[::2], [*runs[1::2], None], strict=False):
            if b is None:
                merged.append(a)
                continue
            at = np.searchsorted(a[0], b[0])
            found = np.zeros(len(b[0]), bool)
            inside = at < len(a[0])
            found[inside] = a[0][at[inside]] == b[0][inside]
            doc, place = a[1].copy(), a[2].copy()
            less = np.flatnonzero(found)[b[1][found] < a[1][at[found]]]
            doc[at[less]], place[at[less]] = b[1][less], b[2][less]
            new = ~found
            merged.append(tuple(np.insert(x, at[new], y[new]) for x, y in zip((a[0], doc, place), b, strict=True)))
        runs = merged
    return runs[0]


def _meet(doc: np.ndarray, sizes: np.ndarray, buf: np.ndarray) -> np.ndarray:
    """For all windows of the segments (in order): does a lesser document have it?"""
    n = sizes - (WIDTH - 1)
    ends = np.cumsum(sizes)
    own = np.repeat(np.arange(len(n)), n)
    places = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + (ends - sizes)[own]
    keys = span_hash(buf, places, places + WIDTH)
    docs = doc[own]
    while True:
        runs = []
        for part in np.array_split(np.arange(len(own)), min(RUNS, max(1, len(own)))):
            order = part[np.argsort(keys[part], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
            runs.append((keys[order[first]], np.minimum.reduceat(docs[order], first), places[order[first]]))
        key, least, place = merge_sorted(runs)
        at = np.searchsorted(key, keys)
        gone = least[at] < docs
        check = np.flatnonzero(gone)
        same = np.ones(len(check), bool)
        for lo in range(0, len(check), 200_000):
            c = check[lo : lo + 200_000]
            same[lo : lo + len(c)] = (buf[places[c][:, None] + np.arange(WIDTH)] == buf[place[at[c]][:, None] + np.arange(WIDTH)]).all(axis=1)
        if same.all():
            return gone
        # two windows share a hash: number the windows by their bytes instead
        _, number = np.unique(np.ascontiguousarray(buf[places[:, None] + np.arange(WIDTH)]).view(f"V{WIDTH}").ravel(), return_inverse=True)
        keys = number.astype(U64)


def _removed(doc: np.ndarray, copy: np.ndarray, start: np.ndarray, n: np.ndarray, shift: np.ndarray, more: list[bytes | None]) -> pa.RecordBatch:
    """Rows _SPAN of removed windows: at start, and as far (shift) into the same bytes at other places."""
    again = [(i, np.frombuffer(x, "<i4")) for i, x in enumerate(more) if x]
    if again:
        at = np.concatenate([np.full(len(x), i) for i, x in again])
        start = np.concatenate([start, np.concatenate([x for _, x in again]) + shift[at]])
        doc, copy, n = (np.concatenate([x, x[at]]) for x in (doc, copy, n))
    return _rows(doc, copy, start, n).select(_SPAN)


def _gone_of_hot(key: np.ndarray, doc: np.ndarray, window: np.ndarray, state: dict) -> np.ndarray:
    """For hot windows sorted by (key, doc): does a lesser document have it? state: what the last key began with."""
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    run = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    own_doc, own = doc[heads], window[heads]
    if state.get("key") == key[0]:
        own_doc[0], own[0] = state["doc"], state["window"]
    same = np.ones(len(key), bool)
    for lo in range(0, len(key), 200_000):
        same[lo : lo + 200_000] = (window[lo : lo + 200_000] == own[run[lo : lo + 200_000]]).all(axis=1)
    gone = same & (doc > own_doc[run])
    for i in np.flatnonzero(~same).tolist():  # another window with the same hash
        if state.get("odd_key") != key[i]:
            state["odd_key"], state["odd"] = key[i], {}
        gone[i] = doc[i] > state["odd"].setdefault(window[i].tobytes(), doc[i])
    state.update(key=key[-1], doc=own_doc[-1], window=own[-1])
    return gone


def _merge(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of _shard, sorted by key and doc: removed windows pass, segments of one key meet.

    Hot windows are decided as they come; a key that is not hot has fewer than hot_from segments.
    """

    def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
        data = t.column(5).combine_chunks()
        sizes = pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64)
        doc, copy, start = (t.column(i).to_numpy() for i in (1, 2, 3))
        buf = np.frombuffer(b"".join(data.to_pylist()), np.uint8)
        gone = np.flatnonzero(_meet(doc, sizes, buf))
        n = sizes - (WIDTH - 1)
        own = np.repeat(np.arange(len(n)), n)[gone]
        at = start[own] + gone - (np.cumsum(n) - n)[own]
        first, count = _runs(own, at)
        own, places = own[first], t.column(6).to_pylist()
        yield _removed(doc[own], copy[own], at[first], count, at[first] - start[own], [places[i] for i in own.tolist()])

    held: list[pa.RecordBatch] = []
    size, state = 0, {}
    for b in batches:
        known = b.column(5).is_null()
        if (done := b.filter(known)).num_rows:
            yield done.select(_SPAN)
        b = b.filter(pc.invert(known))
        hot = pc.equal(b.column(4), 0)
        if (one := b.filter(hot)).num_rows:
            window = np.frombuffer(b"".join(one.column(5).to_pylist()), np.uint8).reshape(-1, WIDTH)
            doc = one.column(1).to_numpy()
            at = np.flatnonzero(_gone_of_hot(one.column(0).to_numpy(), doc, window, state))
            places = one.column(6).to_pylist()
            yield _removed(doc[at], one.column(2).to_numpy()[at], one.column(3).to_numpy()[at], np.ones(len(at), np.int64), np.zeros(len(at), np.int64), [places[i] for i in at.tolist()])
        b = b.filter(pc.invert(hot))
        if not b.num_rows:
            continue
        held.append(b)
        size += b.column(5).nbytes
        if size > most and held[0].column(0)[0] != b.column(0)[-1]:
            t = pa.Table.from_batches(held)
            key = t.column(0).to_numpy()
            whole = int(np.searchsorted(key, key[-1]))
            if whole:
                yield from flush(t.slice(0, whole))
                held = t.slice(whole).combine_chunks().to_batches()
                size = sum(x.column(5).nbytes for x in held)
    if held:
        yield from flush(pa.Table.from_batches(held))


def _texts(rows: pa.Table) -> tuple[np.ndarray, list[memoryview], list[bytes], np.ndarray]:
    """(doc, text, digest, copy) of the rows of a group; copy numbers the different texts of a doc."""
    doc = rows.column("doc_id").to_numpy()
    buf, offsets = text_bytes(rows.column("text"))
    data = memoryview(np.ascontiguousarray(buf))
    texts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    digests = [hashlib.sha256(t).digest() for t in texts]
    copy, numbers = np.zeros(len(doc), np.int64), {}
    if len(np.unique(doc)) < len(doc):
        for d, x in sorted(set(zip(doc.tolist(), digests, strict=True))):
            own = numbers.setdefault(d, {})
            own[x] = len(own)
        copy = np.array([numbers[d][x] for d, x in zip(doc.tolist(), digests, strict=True)])
    return doc, texts, digests, copy


def _is_first(doc: np.ndarray, digests: list[bytes], side: pa.Table) -> np.ndarray:
    """Which rows are the first with their text, as the side rows with a sha say?"""
    firsts = side.filter(side.column("sha").is_valid())
    known = set(zip(firsts.column("doc").to_pylist(), firsts.column("sha").to_pylist(), strict=True))
    return np.array([x in known for x in zip(doc.tolist(), digests, strict=True)], bool)


def _shards(g: int, rows: pa.Table, side: pa.Table) -> Iterator[tuple[int, Shard]]:
    """The shards of a group, in an order that depends on its ids and texts only."""
    doc, texts, digests, copy = _texts(rows)
    at = np.flatnonzero(_is_first(doc, digests, side))
    at = at[np.lexsort((copy[at], doc[at]))]
    if len(at):
        at = at[np.concatenate([[True], (np.diff(doc[at]) != 0) | (np.diff(copy[at]) != 0)])]
    step = PIECE_BYTES - WIDTH + 1  # pieces of a long text overlap, so that each window is in one
    pieces = [(i, base, texts[i][base : base + PIECE_BYTES]) for i in at.tolist() for base in range(0, max(1, len(texts[i]) - WIDTH + 1), step)]
    sizes = np.cumsum([len(x[2]) for x in pieces], dtype=np.int64)
    unit = -(-int(sizes[-1]) // max(1, round(sizes[-1] / UNIT_BYTES))) if len(pieces) and sizes[-1] else 1
    number = (sizes - 1) // unit if len(pieces) else sizes
    for k in np.unique(number).tolist():
        own = [pieces[i] for i in np.flatnonzero(number == k).tolist()]
        row = np.array([x[0] for x in own])
        yield g << 20 | int(k), Shard(doc[row], copy[row], np.array([x[1] for x in own]), [x[2] for x in own])


def _ask_group(key: tuple, rows: pa.Table, side: pa.Table, buckets: int) -> pa.Table:
    out: list[tuple] = []
    for unit, shard in _shards(key[0].as_py(), rows, side):
        out += [(b, unit, pack_ids(shard.ids[i:j], shard.codes[i:j], b, buckets)) for b, i, j in shard.bucket_slices(buckets)]
    cols = list(zip(*out, strict=True)) or [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["bucket", "unit", "asked"])


def _shard_group(key: tuple, rows: pa.Table, side: pa.Table, buckets: int) -> pa.Table:
    told: dict[int, dict[int, bytes]] = {}
    answers = side.filter(side.column("flags").is_valid())
    for unit, bucket, flags in zip(*(answers.column(c).to_pylist() for c in ("unit", "bucket", "flags")), strict=True):
        told.setdefault(unit, {})[bucket] = flags
    none = np.zeros(0, np.int64)
    out = [_rows(none, none, none, none)]
    for unit, shard in _shards(key[0].as_py(), rows, side):
        flags, own = np.zeros(len(shard.ids), np.uint8), told.get(unit, {})
        for b, i, j in shard.bucket_slices(buckets):
            if b in own:
                flags[i:j] = np.frombuffer(own[b], np.uint8)
        out += _shard(shard, flags)
    return pa.Table.from_batches(out)


def _measured(keys: pa.Array | pa.ChunkedArray, cuts: Iterator[tuple[int, list[bytes], int]]) -> list[pa.Array]:
    """The result's columns from (length, what is left, number of spans) of each text."""
    n_bytes, n_removed, n_spans, digests = [], [], [], []
    for n, kept, spans in cuts:
        digest = hashlib.sha256()
        for x in kept:
            digest.update(x)
        n_bytes.append(n)
        n_removed.append(n - sum(map(len, kept)))
        n_spans.append(spans)
        digests.append(digest.hexdigest())
    return [keys, *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string())]


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _cut_group(rows: pa.Table, side: pa.Table) -> pa.Table:
    """What is left of each text of a group; side: first documents, and removed windows as spans."""
    doc, texts, digests, copy = _texts(rows)
    first = _is_first(doc, digests, side)
    spans = side.filter(side.column("n").is_valid())
    s_doc, s_copy, s_start, s_n = (spans.column(c).to_numpy() for c in _SPAN)
    order = np.lexsort((s_start, s_copy, s_doc))
    s_doc, s_copy, s_start, s_n = (x[order] for x in (s_doc, s_copy, s_start, s_n))

    def cuts() -> Iterator[tuple[int, list[bytes], int]]:
        for i, text in enumerate(texts):
            if not first[i] and len(text) >= WIDTH:
                yield len(text), [], 1
                continue
            lo, hi = np.searchsorted(s_doc, [doc[i], doc[i] + 1])
            lo, hi = lo + np.searchsorted(s_copy[lo:hi], [copy[i], copy[i] + 1])
            kept, at, end, count = [], 0, -1, 0
            for start, n in zip(s_start[lo:hi].tolist(), s_n[lo:hi].tolist(), strict=True) if first[i] else ():
                if start > end:
                    kept.append(text[at:start])
                    count += 1
                end = max(end, start + n + WIDTH - 1)
                at = max(at, end)
            kept.append(text[at:])
            yield len(text), kept, count

    return pa.table(_measured(pa.array(doc), cuts()), names=_NAMES)


def _uncut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        buf, offsets = text_bytes(b.column(1))
        data = buf.tobytes()
        whole = ((j - i, [data[i:j]], 0) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
        yield pa.RecordBatch.from_arrays(_measured(b.column(0), whole), names=_NAMES)


def _segments(placed: DataFrame, firsts: DataFrame, parts: int, hot_from: int) -> DataFrame:
    """Rows _PIECE of all shards; placed: (g, doc_id, text) dealt out by g; firsts: (g, doc, sha)."""
    buckets = min(2 * parts, 1 << (_ID - _LOW))
    texts = placed.groupBy("g")
    asked = texts.cogroup(firsts.groupBy("g")).applyInArrow(partial(_ask_group, buckets=buckets), _ASKED)
    told = asked.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(partial(_answer, buckets=buckets, hot_from=hot_from), _TOLD)
    told = told.withColumn("g", F.shiftright("unit", 20).cast("int"))
    both = firsts.unionByName(told, allowMissingColumns=True)
    return texts.cogroup(both.groupBy("g")).applyInArrow(partial(_shard_group, buckets=buckets), _PIECE)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot_from: int = HOT_FROM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row.

    A byte goes if a 50-byte string over it also starts in a document with a smaller id. Null texts
    are empty. Ids are integers; rows that repeat an id are documents of the same rank, which remove
    nothing of each other; a row without an id takes part in nothing and keeps its text. Other
    columns are not read. An empty table gives an empty table. Texts are shuffled once, by groups of
    ids; what else moves are anchors and segments. A task holds one group of texts, one shard of
    UNIT_BYTES of it with its arrays, one range of anchors, or the segments of one anchor, of which
    there are fewer than hot_from.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(2 * parts)).cast("int").alias("g")
    named = source.where("doc_id is not null").select(group("doc_id"), "doc_id", "text")

    # the first document of each text; partial aggregates make a text with many copies a few rows
    firsts = named.groupBy(F.unhex(F.sha2("text", 256)).alias("sha")).agg(F.min("doc_id").alias("doc")).select(group("doc"), "doc", "sha")

    # the same exchange of the texts serves the questions, the shards and the cutting
    placed = named.repartition(parts, "g")
    segments = _segments(placed, firsts, parts, hot_from)
    removed = segments.repartition(parts, "key").sortWithinPartitions("key", "doc").mapInArrow(_merge, "doc long, copy int, start int, n int")
    both = firsts.unionByName(removed.select(group("doc"), *_SPAN), allowMissingColumns=True)
    cut = placed.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(_cut_group, _RESULT)
    return cut.unionByName(source.where("doc_id is null").mapInArrow(_uncut, _RESULT))
