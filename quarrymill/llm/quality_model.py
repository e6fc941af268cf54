"""A factorisation machine over hashed words, structure statistics and metadata of a text.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)); the bracket
gives all pairwise interactions in time linear in the features of the text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, span_hash, text_blocks, words
from .common import first_rows, fresh

BUCKETS, FACTORS = 1 << 14, 8
STATS = ("log_words", "word_length", "longest_word", "letters", "upper", "digits", "signs", "marks", "stops", "line_breaks", "wide", "distinct", "top_word", "loud_words", "signed_words")
_CLASS = np.zeros((6, 256), bool)
for _i, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>{}[]\\^~=+_/@", "!?", ".,;:")):
    _CLASS[_i, [ord(c) for c in _chars]] = True


def features(buf: np.ndarray, offsets: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the hashed words, each row's of length 1, and the dense columns."""
    n = len(offsets) - 1
    starts, ends, rows = words(buf, offsets)
    h = span_hash(buf, starts, ends)
    key, counts = np.unique(rows * np.int64(BUCKETS) + (h & U64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    row, bucket = key // BUCKETS, key % BUCKETS
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(row, value**2, n))
    value /= np.maximum(norm[row], 1e-12)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    n_words = np.bincount(rows, minlength=n)
    per = np.maximum(n_words, 1)
    length = ends - starts
    longest, top = np.zeros(n), np.zeros(n)
    np.maximum.at(longest, rows, length)
    np.maximum.at(top, row, counts)
    lower, upper, digits, signs, marks, stops = (share(c[buf]) for c in _CLASS)
    count = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    low_in, sign_in, up_in = (count(_CLASS[i][buf]) for i in (0, 3, 1))
    loud = (low_in[ends] == low_in[starts]) & (up_in[ends] - up_in[starts] > 1)
    signed = sign_in[ends] > sign_in[starts]
    dense = np.stack(
        [np.log1p(n_words), np.bincount(rows, length, n) / per, np.log1p(longest), lower + upper, upper, digits, signs, marks, stops, share(buf == 0x0A), share(buf >= 0x80), np.bincount(row, minlength=n) / per, top / per, np.bincount(rows, loud, n) / per, np.bincount(rows, signed, n) / per], axis=1
    )
    return row, bucket, value, np.concatenate([dense, np.log1p(np.maximum(np.nan_to_num(meta), 0))], axis=1)


class FactorisationMachine:
    """w0, w and v over BUCKETS hashed words followed by the dense columns."""

    def __init__(self, n_dense: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = BUCKETS + n_dense
        self.w0, self.w, self.v = 0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32)
        self.centre, self.scale = np.zeros(n_dense), np.ones(n_dense)

    def dense(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -4, 4).astype(np.float32)

    def raw(self, row: np.ndarray, index: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(score before the sigmoid, sum of v x by row and factor) of sparse rows."""
        linear = np.bincount(row, self.w[index] * value, n)
        vx = self.v[index] * value[:, None]
        total = np.stack([np.bincount(row, vx[:, f], n) for f in range(FACTORS)], axis=1)
        squares = np.bincount(row, (vx**2).sum(axis=1), n)
        return self.w0 + linear + 0.5 * ((total**2).sum(axis=1) - squares), total

    @staticmethod
    def joined(row, bucket, value, dense) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, d = dense.shape
        return (
            np.concatenate([row, np.repeat(np.arange(n), d)]),
            np.concatenate([bucket, np.tile(np.arange(BUCKETS, BUCKETS + d), n)]),
            np.concatenate([value, dense.ravel()]),
        )

    def fit(self, row, bucket, value, dense, labels, epochs: int = 12, batch: int = 256, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
        """Adam on the logistic loss over shuffled batches."""
        self.centre, self.scale = dense.mean(axis=0), dense.std(axis=0) + 1e-6
        order = np.argsort(row, kind="stable")
        row, bucket, value = row[order], bucket[order], value[order]
        at = np.searchsorted(row, np.arange(len(labels) + 1))
        x = self.dense(dense)
        share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        self.w0 = float(np.log(share / (1 - share)))
        rng, t = np.random.default_rng(seed), 0
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.w, self.v)]
        for _ in range(epochs):
            shuffled = rng.permutation(len(labels))
            for lo in range(0, len(shuffled), batch):
                own = shuffled[lo : lo + batch]
                sizes = at[own + 1] - at[own]
                flat = np.repeat(at[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                r, i, v = self.joined(np.repeat(np.arange(len(own)), sizes), bucket[flat], value[flat], x[own])
                z, total = self.raw(r, i, v, len(own))
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]) / len(own)
                t += 1
                self.w0 -= rate * float(err.sum())
                used, back = np.unique(i, return_inverse=True)
                ev = err[r] * v
                grad_w = np.bincount(back, ev, len(used)) + decay * self.w[used]
                part = total[r] - self.v[i] * v[:, None]
                grad_v = np.stack([np.bincount(back, ev * part[:, f], len(used)) for f in range(FACTORS)], axis=1) + decay * self.v[used]
                for p, g, (m, s) in ((self.w, grad_w, moments[0]), (self.v, grad_v, moments[1])):
                    m[used] = 0.9 * m[used] + 0.1 * g
                    s[used] = 0.99 * s[used] + 0.01 * g * g
                    p[used] -= rate * (m[used] / (1 - 0.9**t)) / (np.sqrt(s[used] / (1 - 0.99**t)) + 1e-6)
        return self

    def score(self, row, bucket, value, dense) -> np.ndarray:
        z, _ = self.raw(*self.joined(row, bucket, value, self.dense(dense)), len(dense))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _meta(batch: pa.RecordBatch, first: int, count: int) -> np.ndarray:
    if not count:
        return np.zeros((batch.num_rows, 0))
    return np.stack([batch.column(first + i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(count)], axis=1)


def train(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality", meta_cols: Sequence[str] = (), max_rows: int = 8192, epochs: int = 12) -> FactorisationMachine:
    """Fit on at most max_rows labelled ids, taken by a hash of the id.

    The bound makes the labels small enough for a broadcast and the sample for one task. Features are
    made where the texts are read; only those move. Null labels are left out; labels that repeat an
    id count as their mean; of documents that repeat an id one is taken. Without labels of both kinds
    the machine knows the share of label 1 only, or 0.5 without any label.
    """
    key, y = fresh(docs, "_id"), fresh(docs, "_y")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias(key)).agg(F.avg(F.col(label_col).cast("double")).alias(y))
    order = fresh(docs, "_h")
    known = first_rows(known.withColumn(order, F.xxhash64(key)), max_rows, order, [key]).drop(order)
    n_meta = len(meta_cols)
    rows = docs.join(F.broadcast(known), F.col(id_col) == F.col(key)).select(F.col(text_col).cast("string"), y, *(F.col(c).cast("double") for c in meta_cols), F.col(key).cast("string"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = _meta(b, 2, n_meta)
            for lo, hi, buf, offsets in text_blocks(b.column(0)):
                row, bucket, value, dense = features(buf, offsets, meta[lo:hi])
                at = np.searchsorted(row, np.arange(hi - lo + 1)).tolist()
                cut = lambda x: [x[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]  # noqa: E731, B023
                cols = [b.column(2 + n_meta).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), *(pa.array(x, pa.binary()) for x in (cut(bucket.astype("<u2")), cut(value.astype("<f4")), [d.astype("<f8").tobytes() for d in dense]))]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "y", "bucket", "value", "dense"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches))
        y = held.column("y").to_numpy() >= 0.5
        parts = [held.column(c).to_pylist() for c in ("bucket", "value", "dense")]
        machine = FactorisationMachine(len(STATS) + n_meta)
        if 0 < y.sum() < len(y):
            bucket, value, dense = (np.frombuffer(b"".join(p), t) for p, t in zip(parts, ("<u2", "<f4", "<f8"), strict=True))
            row = np.repeat(np.arange(len(y)), [len(p) // 2 for p in parts[0]])
            machine.fit(row, bucket.astype(np.int64), value.astype(np.float64), dense.reshape(len(y), -1), y, epochs)
        elif len(y):
            machine.w0 = 4.0 if y[0] else -4.0
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], names=["model"])

    read_rows = rows.mapInArrow(read, "id string, y double, bucket binary, value binary, dense binary")
    one = read_rows.groupBy("id").agg(F.min(F.struct("y", "bucket", "value", "dense")).alias("x")).select(F.xxhash64("id").alias("o"), "id", "x.*")
    ordered = one.repartition(1).sortWithinPartitions("o", "id").drop("o")  # max_rows rows: one task, in an order that reruns repeat
    made = ordered.mapInArrow(fit, "model binary").collect()
    return pickle.loads(made[0][0]) if made else FactorisationMachine(len(STATS) + n_meta)


def score_quality(docs: DataFrame, machine: FactorisationMachine, *, id_col: str = "doc_id", text_col: str = "text", meta_cols: Sequence[str] = ()) -> DataFrame:
    """(doc_id, score) of each row; null texts count as empty, null metadata as 0.

    One pass without a shuffle over whole texts; the machine, of fixed size, is broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(machine)
    n_meta = len(meta_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = _meta(b, 2, n_meta)
            scores = [held.value.score(*features(buf, offsets, meta[lo:hi])) for lo, hi, buf, offsets in text_blocks(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"), *(F.col(c).cast("double") for c in meta_cols))
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id: str = "doc_id"):
    """Is the row outside the training folds? (crc32 of the id as text, modulo 5, is 0)"""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
