"""Near duplicates by bottom-k sketches from one hash function.

A document is the set of the hashes of its word shingles; its sketch is the k least of them. Texts
with equal sets are one class from the start. Retained values that follow each other in a sketch
make the keys of inverted lists, as many as the asked similarity needs for two such sets to share one
but for odds of LOST, 1e-7 (for certain, if their union has up to 60 shingles). A list links its members with its
least one; lists whose members are still in several components after that compare all members of
different components. The sketch of the union (the k least values of both) estimates the similarity
of a pair; what is six standard errors below the threshold goes (odds of about 1e-8 for a pair at
it), and the exact similarity of the full sets decides on the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components as components
from ..operators.graph import few_tasks
from ..session import use_checkpoints
from .arrays import LOWER, mix, shingles, span_hash, text_blocks, words

K, WIDTH = 128, 5
LOST = 1e-7  # odds that two sets of the asked similarity share no list
GROUP = 1000  # documents that one copy of a leader's set is compared with
PAIRS = 1 << 14  # pairs of a list that are compared at a time
LIST_BLOCK = 2048  # members of a list that one task compares with as many others
TASK_TEXTS = 2000  # texts or sketches that a task may well hold
MARGIN = 6.0  # standard errors below the threshold at which an estimate rules a pair out
NONE = np.uint32(0xFFFFFFFF)


def sets_of(buf: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row of a block, in order: (hashes, where each row's begin)."""
    low = LOWER[buf]
    starts, ends, rows = words(low, offsets)
    h, own = shingles(span_hash(low, starts, ends), rows, len(offsets) - 1, width)
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    h, own = h[new], own[new]
    return h, np.searchsorted(own, np.arange(len(offsets)))


def lists_for(least: float) -> int:
    """Number of lists for which LOST holds at a similarity.

    The least values of a union are shared with odds of `least` each; x**n is about the share of
    runs of n of them without two shared neighbours.
    """
    x = (1 - least + math.sqrt((1 - least) ** 2 + 4 * least * (1 - least))) / 2
    return min(K - 1, max(1, math.ceil(math.log(LOST) / math.log(x)))) if x > 0 else 1


def _sketches(h: np.ndarray, at: np.ndarray, lists: int) -> dict[str, np.ndarray]:
    n = len(at) - 1
    sizes = np.diff(at)
    wide = at[:-1, None] + np.arange(K)
    has = np.arange(K) < sizes[:, None]
    own = np.where(has, h[np.where(has, wide, 0)] if len(h) else np.uint64(0), np.uint64(0))
    low = np.where(has, (own >> np.uint64(32)).astype(np.uint32), NONE)
    pair = mix(own[:, :lists] + mix(own[:, 1 : lists + 1]))
    sums = np.zeros((2, len(h) + 1), np.uint64)
    for i, x in enumerate((mix(h), mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))):
        np.cumsum(x, out=sums[i, 1:])
    a, b = sums[:, at[1:]] - sums[:, at[:-1]]
    return {"sizes": sizes, "low": low, "keys": pair, "n_keys": np.clip(sizes - 1, 0, lists), "a": a.view(np.int64), "b": b.view(np.int64), "n": n}


def _sketch_batch(batch: pa.RecordBatch, width: int, lists: int) -> pa.RecordBatch:
    parts = [_sketches(*sets_of(buf, offsets, width), lists) for *_, buf, offsets in text_blocks(batch.column(1))]
    cat = lambda c, e: np.concatenate([p[c] for p in parts]) if parts else e
    low = cat("low", np.zeros((0, K), np.uint32))
    n_keys, keys = cat("n_keys", np.zeros(0, np.int64)), cat("keys", np.zeros((0, lists), np.uint64))
    flat = keys[np.arange(lists) < n_keys[:, None]].view(np.int64)
    sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * K), len(low), [None, pa.py_buffer(np.ascontiguousarray(low))]).cast(pa.binary())
    held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_keys)]), pa.int32()), pa.array(flat, pa.int64()))
    cols = [batch.column(0), pa.array(cat("sizes", n_keys), pa.int64()), pa.array(cat("a", n_keys), pa.int64()), pa.array(cat("b", n_keys), pa.int64()), sketch, held]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_shingles", "set_a", "set_b", "sketch", "keys"])


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), K)


def _padded(col: pa.Array) -> np.ndarray:
    """The lists of each row as a matrix, short ones filled up with 0."""
    n = col.value_lengths().to_numpy()
    out = np.zeros((len(col), max(1, n.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = col.flatten().to_numpy()
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, values it rests on) of sketches a and b, row by row, from the sketch of the union."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != NONE
    twice = np.zeros(both.shape, bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~twice, axis=1)
    size = np.minimum(rank[:, -1], K)
    shared = (twice & (rank <= K)).sum(axis=1)
    return shared / np.maximum(size, 1), size


def may_link(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: float) -> np.ndarray:
    """Could the pairs have the asked similarity? Set sizes rule out for certain, estimates by MARGIN."""
    out = np.minimum(size_a, size_b) >= least * np.maximum(size_a, size_b) - 1e-9
    at = np.flatnonzero(out)
    share, n = estimate(a[at], b[at])
    # the sketch is drawn without replacement from the union, whose size the threshold gives
    union = np.maximum((size_a[at] + size_b[at]) / (1 + least), 2)
    left = np.clip((union - n) / (union - 1), 0, 1)
    error = np.sqrt(least * (1 - least) / np.maximum(n, 1) * left)
    out[at] = share >= least - MARGIN * error - 1 / np.maximum(n, 1)
    return out


def _cross_pairs(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc, component, n, sketch, side, reach, list, lists) sorted by key to pairs that may link.

    reach bounds what a set can have in common with any other, and so the similarity of each pair.
    A pair of several lists comes out of the first of them only.
    """

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key = t.column(0).to_numpy()
        doc, comp, n, side, reach = (t.column(i).to_numpy() for i in (1, 2, 3, 5, 6))
        low = _matrix(t.column(4).combine_chunks())
        own, lists = t.column(7).to_numpy(), _padded(t.column(8).combine_chunks())
        ends = np.searchsorted(key, key, side="right")
        later = ends - np.arange(len(key)) - 1
        lo = 0
        total = np.concatenate([[0], np.cumsum(later)])
        while lo < len(key):  # some PAIRS pairs at a time
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, side="right")) - 1)
            i = np.repeat(np.arange(lo, min(hi, len(key))), later[lo:hi])
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later[lo:hi]) - later[lo:hi], later[lo:hi])
            ok = (comp[i] != comp[j]) & ((side[i] != side[j]) | (side[i] < 0))
            i, j = i[ok], j[ok]
            most = np.minimum(reach[i], reach[j])
            ok = most >= least * (n[i] + n[j] - most) - 1e-9
            i, j = i[ok], j[ok]
            common = (lists[i][:, :, None] == lists[j][:, None, :]).any(axis=2)
            first = np.where(common & (lists[i] != 0), lists[i], np.iinfo(np.int64).max).min(axis=1)
            ok = first == own[i]
            i, j = i[ok], j[ok]
            ok = may_link(low[i], low[j], n[i], n[j], least)
            i, j = i[ok], j[ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[i], doc[j])), pa.array(np.maximum(doc[i], doc[j]))], names=["a", "b"])
            lo = hi

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b])
        key = t.column(0).to_numpy()
        whole = int(np.searchsorted(key, key[-1]))
        yield from pairs(t.slice(0, whole))
        held = t.slice(whole).combine_chunks().to_batches()
    if held:
        yield from pairs(pa.Table.from_batches(held))


def _set_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(doc, text) to a row (shingle, doc) for each member of the sets."""
    for b in batches:
        docs = b.column(0).to_numpy()
        for lo, hi, buf, offsets in text_blocks(b.column(1)):
            h, at = sets_of(buf, offsets, width)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.repeat(docs[lo:hi], np.diff(at)))], names=["shingle", "doc"])


def _verify(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Rows (leader, part, doc, set) sorted, a leader's own set first; out come its linked documents."""
    leader, own = None, np.zeros(0, np.uint64)
    for b in batches:
        a, part, doc = (b.column(i).to_pylist() for i in range(3))
        linked = []
        for i, s in enumerate(b.column(3)):
            x = np.frombuffer(s.as_buffer(), np.uint64)
            if (a[i], part[i]) != leader:
                leader, own = (a[i], part[i]), x
                continue
            both = len(np.intersect1d(own, x, assume_unique=True))
            if share[1] * both >= share[0] * (len(own) + len(x) - both):
                linked.append((a[i], doc[i]))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in linked], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _links(pairs: DataFrame, texts: DataFrame, width: int, share: tuple[int, int], parts: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets have the asked similarity.

    A leader's set goes to one group for every GROUP of its pairs, the other sets to their groups.
    """
    n = pairs.count()
    pairs = few_tasks(pairs, n)
    groups = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / GROUP).cast("int").alias("parts"))
    sent = pairs.join(groups, "a").select(F.col("b").alias("doc"), F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
    own = groups.select(F.col("a").alias("doc"), F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offsets in text_blocks(b.column(3)):
                h, at = sets_of(buf, offsets, width)
                data = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((8 * at).astype(np.int32)), pa.py_buffer(h)])
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(lo, hi - lo) for i in range(3)), data], names=["leader", "part", "doc", "set"])

    rows = few_tasks(sent.unionByName(own).join(texts, "doc"), 2 * n, TASK_TEXTS)
    rows = rows.select("leader", "part", "doc", "text").mapInArrow(to_sets, "leader long, part int, doc long, set binary")
    dealt = few_tasks(rows.repartition(parts, "leader", "part"), 2 * n, TASK_TEXTS).sortWithinPartitions("leader", "part", F.col("doc") != F.col("leader"), "doc")
    return dealt.mapInArrow(lambda it: _verify(it, share), "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row.

    Documents link where share[1] * intersection >= share[0] * union of their sets of `width`-word
    shingles, A-Z lower-cased; fewer words are one shingle. component_id is the least doc_id that
    links reach, kept says that it is the row's own. Rows without words are linked with nothing. Ids
    are integers; rows without an id keep their place, with a null component, and are kept. Rows that
    repeat an id are one node, whose links are those of the least of their texts by code point. Other columns are not read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    use_checkpoints(spark)
    least = share[0] / share[1]
    n_lists = lists_for(least)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _sketch_batch(b, width, n_lists)

    sketched = source.mapInArrow(sketch, "doc_id long, n_shingles long, set_a long, set_b long, sketch binary, keys array<long>").checkpoint()
    sets = ["n_shingles", "set_a", "set_b"]
    # equal sets are one class, under the least id
    classes = sketched.where("n_shingles > 0 and doc_id is not null").groupBy(*sets).agg(F.min(F.struct("doc_id", "sketch", "keys")).alias("m"))
    classes = classes.select(*sets, F.col("m.doc_id").alias("rep"), "m.sketch", "m.keys").checkpoint()
    n = classes.count()
    classes, most = few_tasks(classes, n, TASK_TEXTS), n * n_lists  # rows of lists at most
    listed = classes.select(F.col("rep").alias("doc"), F.explode("keys").alias("key"))
    shared = listed.groupBy("key").agg(F.min("doc").alias("leader"), F.max("doc").alias("last"), F.count("*").alias("members")).where("leader < last")
    lists = few_tasks(listed.join(shared.select("key", "leader", "members"), "key"), most).checkpoint()

    one = classes.groupBy(F.col("rep").alias("doc")).agg(F.min(F.struct("n_shingles", "sketch", "keys")).alias("s")).select("doc", F.col("s.n_shingles").alias("n"), F.col("s.sketch").alias("sketch"), F.col("s.keys").alias("lists"))
    texts = source.join(few_tasks(lists.select(F.col("doc").alias("doc_id")).distinct(), n), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("doc")).agg(F.min("text").alias("text"))
    texts = few_tasks(texts, n, TASK_TEXTS).checkpoint()

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_a, n_b = b.column(2).to_numpy(), b.column(3).to_numpy()
            ok = may_link(_matrix(b.column(4)), _matrix(b.column(5)), n_a, n_b, least)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    stars = few_tasks(lists.where("doc != leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct(), most)
    stars = stars.join(one.select("doc", "n", "sketch").toDF("a", "n_a", "sketch_a"), "a").join(one.select("doc", "n", "sketch").toDF("b", "n_b", "sketch_b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(filtered, "a long, b long").checkpoint()
    links = _links(stars, texts, width, share, parts).checkpoint()
    found = components(links)

    # lists whose members are still in several components: all of their pairs that may link, by what
    # sets can share at most, then by the sketch of the union
    placed = lists.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    open_lists = placed.join(split, "key").checkpoint()
    # shingles of no other document in these lists: what is left bounds any intersection
    members = texts.join(open_lists.select("doc").distinct(), "doc", "left_semi").select("doc", "text")
    alone = members.mapInArrow(lambda it: _set_rows(it, width), "shingle long, doc long").groupBy("shingle").agg(F.min("doc").alias("doc"), F.max("doc").alias("other")).where("doc = other")
    alone = alone.groupBy("doc").agg(F.count("*").alias("alone"))
    able = one.join(alone, "doc", "left").withColumn("reach", F.col("n") - F.coalesce("alone", F.lit(0))).where(F.col("reach") >= least * F.col("n")).drop("alone")
    blocks = F.ceil(F.col("members") / LIST_BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("doc"), blocks).cast("int")
    rest = open_lists.join(able, "doc").select("*", mine.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    side = F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine"))
    rest = rest.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "doc", "component", "n", "sketch", side.alias("side"), "reach", F.col("key").alias("list"), "lists")
    # a block meets itself among its rows with side -1; rows of two blocks meet only those of the other
    again = rest.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lambda it: _cross_pairs(it, least), "a long, b long").distinct()
    again = again.join(stars, ["a", "b"], "left_anti").checkpoint()
    more = _links(again, texts, width, share, parts).checkpoint()
    if not more.isEmpty():  # a component is a star of its nodes; only new links join them
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    # the class of each row's set, then its component
    named = sketched.select("doc_id", *sets).join(classes.select(*sets, "rep"), sets, "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
