"""Runs of words that repeat with a period, found by minimizers at several scales.

A run is a stretch with smallest period q that is at least four periods (and six words) long and that
no neighbouring word extends. A scale looks for periods in [lo, 1.5 lo]: words are hashed in grams of
k = 1.5 lo words, and the minimum of each window of k grams is a minimizer. Inside a run of period
q <= k, grams that start at different places of the period differ, so each window's minimum is the
same gram of the period and lies q further on in the next period; the run has more than q windows, so
at least two such minimizers q apart are there. Neighbouring places of one minimizer are therefore
the seeds; they are confirmed and extended by comparing words. Periods below the first scale are
found by comparing the words with those 1, 2, ... places further on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U64, counts_by_row, mix, number_spans, text_blocks, words

GAP = r"[\x20\x09-\x0D]+"  # between words
SHORT = 8  # periods up to here are found by direct lags
LEAST, TIMES = 6, 4  # words, and periods, that a run has at least
_MOST, _ODD = U64(0xFFFFFFFFFFFFFFFF), U64(0xD6E8FEB86659FD93)


def _ahead(x: np.ndarray, n: int, pad: np.uint64) -> np.ndarray:
    """x[i + n] at i."""
    out = np.full(len(x), pad, x.dtype)
    if n < len(x):
        out[: len(x) - n] = x[n:]
    return out


def _slide(x: np.ndarray, width: int, pick: np.ufunc, pad: np.uint64) -> np.ndarray:
    """pick over x[i], ..., x[i + width - 1] at i."""
    n = 1
    while 2 * n <= width:
        x, n = pick(x, _ahead(x, n, pad)), 2 * n
    return pick(x, _ahead(x, width - n, pad)) if n < width else x


def _seeds(grams: np.ndarray, left: np.ndarray, rows: np.ndarray, k: int, lo: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): neighbouring places of one minimizer of a row, lo to k apart. left: words to the row's end."""
    value = np.where(left >= k, grams & ~U64(1), _MOST)  # a gram that a row's end cuts is no minimum
    least = _slide(value, k, np.minimum, _MOST)
    highest = _slide(np.concatenate([np.zeros(k - 1, U64), least]), k, np.maximum, U64(0))[: len(value)]
    at = np.flatnonzero((value == highest) & (value != _MOST))
    at = at[np.argsort(value[at], kind="stable")]
    far = at[1:] - at[:-1]
    pair = np.flatnonzero((value[at[1:]] == value[at[:-1]]) & (rows[at[1:]] == rows[at[:-1]]) & (far >= lo) & (far <= k))
    return at[pair], far[pair]


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many words a and b have in common from their start on; looks ahead in growing steps."""
    n, step, most = 0, 32, min(len(a), len(b))
    while n < most:
        same = a[n : n + step] == b[n : n + step]
        if not same.all():
            return n + int(np.argmin(same))
        n, step = min(n + step, most), step * 2
    return most


def _lag_runs(number: np.ndarray, rows: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of period q that are long enough."""
    same = np.zeros(len(number) + 2, np.int8)
    same[1 : len(number) - q + 1] = (number[q:] == number[:-q]) & (rows[q:] == rows[:-q])
    edge = np.flatnonzero(np.diff(same))
    starts, ends = edge[0::2], edge[1::2] + q
    long = ends - starts >= max(LEAST, TIMES * q)
    return starts[long], ends[long]


def find_runs(number: np.ndarray, rows: np.ndarray, n_rows: int, short: int = SHORT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, periods) of all runs, as places in `number`, sorted by start and period.

    number: words as numbers; rows: their documents, ascending.
    """
    found = [np.zeros((0, 3), np.int64)]

    def keep(starts, ends, period) -> None:
        found.append(np.column_stack([starts, ends, np.broadcast_to(period, len(starts))]).astype(np.int64))

    for q in range(1, min(short, len(number) - 1) + 1):
        keep(*_lag_runs(number, rows, q), q)

    counts = counts_by_row(rows, n_rows)
    firsts = np.cumsum(counts) - counts
    place, grams, m = np.arange(len(number)), mix(number.astype(U64) + U64(1)), 1  # grams: hashes of m words from each place on
    own_row, lo = rows, short + 1
    while TIMES * lo <= counts.max(initial=0):
        k = lo * 3 // 2
        live = counts[own_row] >= TIMES * lo
        if not live.all():
            place, grams, own_row = place[live], grams[live], own_row[live]
        while 2 * m <= k:
            grams, m = mix(grams * _ODD ^ _ahead(grams, m, U64(0))), 2 * m
        whole = mix(grams * _ODD + _ahead(grams, k - m, U64(0)) + U64(k)) if k > m else grams
        at, far = _seeds(whole, firsts[own_row] + counts[own_row] - place, own_row, k, lo)
        at = place[at]
        # seeds of one distance whose grams touch are one stretch
        order = np.lexsort((at, far))
        at, far = at[order], far[order]
        new = np.ones(len(at), bool)
        new[1:] = (far[1:] != far[:-1]) | (at[1:] - at[:-1] > k) | (rows[at[1:]] != rows[at[:-1]])
        head = np.flatnonzero(new)
        for a, q, z in zip(at[head].tolist(), far[head].tolist(), at[np.append(head[1:], len(at)) - 1].tolist() if len(at) else [], strict=True):
            first, last = int(firsts[rows[a]]), int(firsts[rows[a]] + counts[rows[a]])
            if not np.array_equal(number[a : z + k], number[a + q : z + k + q]):  # two grams share a hash: look at the whole row
                s, e = _lag_runs(number[first:last], rows[first:last], q)
                keep(s + first, e + first, q)
                continue
            start = a - _reach(number[first:a][::-1], number[first + q : a + q][::-1])
            end = z + k + q + _reach(number[z + k : last - q], number[z + k + q : last])
            if end - start >= max(LEAST, TIMES * q):
                keep([start], [end], q)
        lo = k + 1
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # the same stretch with several periods: all are multiples of the least
    one = np.ones(len(runs), bool)
    one[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[one]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def _joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int) -> pa.Array:
    """The given words of each row, joined by one space."""
    size = ends - starts
    wide = size.copy()
    wide[:-1] += rows[1:] == rows[:-1]
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    stop = np.cumsum(wide)
    out = np.zeros(int(stop[-1]) if len(stop) else 0, np.uint8)
    gap = np.zeros(len(out), bool)
    gap[stop[wide > size] - 1] = True
    out[gap] = 0x20
    out[~gap] = buf[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    offsets = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.bincount(rows, wide, minlength=n_rows).astype(np.int64), out=offsets[1:])
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(offsets), pa.py_buffer(out))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapse_block(buf: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(number of words, runs, text without repeated periods) of each row of a block of texts."""
    n_rows = len(offsets) - 1
    starts, ends, rows = words(buf, offsets)
    number, _ = number_spans(buf, starts, ends)
    counts = counts_by_row(rows, n_rows)
    firsts = np.cumsum(counts) - counts
    a, z, q = find_runs(number, rows, n_rows)
    over = np.zeros(len(number) + 1, np.int64)
    np.add.at(over, a + q, 1)
    np.add.at(over, z, -1)
    stays = np.cumsum(over[:-1]) == 0
    own = rows[a]
    runs = pa.StructArray.from_arrays([pa.array(a - firsts[own]), pa.array(z - a), pa.array(q)], fields=list(RUN))
    at = np.zeros(n_rows + 1, np.int32)
    np.cumsum(np.bincount(own, minlength=n_rows), out=at[1:])
    return pa.array(counts), pa.ListArray.from_arrays(pa.array(at), runs), _joined(buf, starts[stays], ends[stays], rows[stays], n_rows).cast(pa.string())


def collapse_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed) of each row.

    runs: all runs, by start, then period, in words from 0. collapsed: the words that no run holds after
    its own first period, joined by one space. Null and empty texts have no words, no runs and an empty
    text. Ids may repeat or be null; other columns are not read. One pass without a shuffle; a task holds
    an Arrow batch, works through blocks of 2 MB (or one text, some 60 bytes a word) and returns them one
    by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offsets in text_blocks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *collapse_block(buf, offsets)], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: the first. Null without runs."""
    better = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    return F.aggregate(F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, 0), better)


def with_planted_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): for test data, every tenth text by a checksum of its id gets a run to its end.

    With h the CRC-32 of the decimal id and g = h div 10, n words from a = g mod n on repeat the first
    1 + (n - a) div (3 + g mod 8) of them, if h mod 10 is 0. Rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), h.alias("h"))
    w = F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", GAP), ""))
    rows = rows.select("doc_id", "text", w.alias("w"), F.expr("h div 10").alias("g"))
    rows = rows.select("doc_id", "text", "w", "g", F.size("w").cast("long").alias("n")).select("*", F.expr("if(n > 0, g % n, 0)").alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    return rows.select("doc_id", F.expr("if(n > 0, array_join(transform(sequence(0L, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' '), text)").alias("text"))
