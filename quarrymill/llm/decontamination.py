"""Benchmark passages in documents, by a prefix-filtered set join (DataFrame functions only).

An item is a set of windows of ten consecutive words, an item with fewer words is one window. A
window is the set of its shingles (runs of four words, or the whole of a shorter window). Shingles are
ordered by how often the documents hold them. As a window must be contained whole, its necessary
prefix in that order is one shingle, the rarest: only places of documents that hold it are candidates,
and a window with a shingle that no document holds is out. The shingle's offset in the window and both
lengths bound where the window can lie, and there its words are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import use_checkpoints

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # between words; splitting there is ten times as fast as matching words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW, SHINGLE = 10, 4
#: Bytes of item windows up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Words of a text in which A-Z, and no other letters, are lower-cased; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), GAP), "")


def _shingle(w: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *(F.get(w, at + j) for j in range(width)))


def item_windows(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, words): the distinct windows of each item; items without words have none."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    span = F.least(F.size("w"), F.lit(window))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - span)).alias("at")
    return w.select("item", "w", span.alias("span"), at).select("item", F.slice("w", F.col("at") + 1, F.col("span")).alias("words")).distinct()


def _places(docs: DataFrame, widths: list[int]) -> DataFrame:
    """docs (key, w) with a row for each shingle: its place `at` and hash `h`; all in the stage that reads the texts."""
    rows = docs.where(F.size("w") >= min(widths)).select("*", F.explode(F.sequence(F.lit(0), F.size("w") - min(widths))).alias("at"))
    if len(widths) == 1:
        return rows.withColumn("h", _shingle(F.col("w"), F.col("at"), widths[0]))
    fitting = (F.when(F.col("at") + k <= F.size("w"), _shingle(F.col("w"), F.col("at"), k)) for k in widths)
    return rows.withColumn("h", F.explode(F.array(*fitting))).where("h is not null")


def window_hits(docs: DataFrame, windows: DataFrame, *, shingle: int = SHINGLE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs (key, w), windows (id, words) to (key, id, start, stop): each place where a window lies.

    The texts are read twice: to count the shingles that windows have, and to look for the rarest of
    each window. While the windows are within `broadcast_bytes`, no place is shuffled; beyond, narrow
    rows of places meet the prefixes by hash, which adaptive execution splits where one is hot, and the
    texts with candidates are shuffled once to be compared.
    """
    size = windows.agg(F.sum(F.octet_length(F.array_join("words", " ")) + 24 * F.size("words") + 200)).first()[0] or 0
    small = (lambda df: F.broadcast(df)) if size <= broadcast_bytes else (lambda df: df)
    width = F.least(F.size("words"), F.lit(shingle))
    widths = sorted(r[0] for r in windows.select(width).distinct().collect()) or [shingle]  # `shingle` values at most
    tokens = windows.select("id", "words", width.alias("width"), F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("offset"))
    h = F.coalesce(*(F.when(F.col("width") == k, _shingle(F.col("words"), F.col("offset"), k)) for k in widths))
    tokens = tokens.select("id", F.size("words").alias("n"), "offset", h.alias("h"))

    places = _places(docs, widths)
    held = places.select("h").join(small(tokens.select("h").distinct()), "h").groupBy("h").count()
    rarest = tokens.join(held, "h", "left").groupBy("id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "h", "offset", "n")).alias("p"))
    prefix = rarest.where("p.count > 0").select("id", "p.h", "p.offset", "p.n")

    start, stop = F.col("at") - F.col("offset"), F.col("at") - F.col("offset") + F.col("n")
    if size <= broadcast_bytes:
        met = places.join(small(prefix.join(windows, "id")), "h")
        there = (start >= 0) & (stop <= F.size("w")) & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("words"))
        return met.where(there).select("key", "id", start.alias("start"), stop.alias("stop"))
    narrow = places.select("key", F.size("w").alias("size"), "at", "h").join(prefix, "h").where((start >= 0) & (stop <= F.col("size")))
    asked = narrow.select("key", "id", start.alias("start"), stop.alias("stop")).join(windows, "id").groupBy("key").agg(F.collect_set(F.struct("id", "start", "stop", "words")).alias("asked"))
    texts = docs.select("key", "w").dropDuplicates(["key"]).join(asked, "key")
    found = F.filter("asked", lambda a: F.slice(F.col("w"), a["start"] + 1, a["stop"] - a["start"]) == a["words"])
    return texts.select("key", F.explode(found).alias("f")).select("key", "f.id", "f.start", "f.stop")


def benchmark_overlap(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items) of each row of docs.

    n_hit: words inside any place of a window; items: ids of the items with such windows, as strings,
    sorted. Null and empty texts have no words. Rows keep their number, ids may repeat or be null, and
    other columns are not read. Rows of items that share an id are one item; a null id is an item that
    is named by the empty string. No items, or items without words, hit nothing.
    """
    use_checkpoints(docs.sparkSession)
    own = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h")).alias("key"), F.col(text_col).cast("string").alias("text"))
    holds = item_windows(items, id_col=item_col, text_col=item_text_col, window=window)
    holds = holds.groupBy("words").agg(F.collect_set(F.coalesce("item", F.lit(""))).alias("items")).withColumn("id", F.monotonically_increasing_id()).checkpoint()
    hits = window_hits(own.select("key", words(F.col("text")).alias("w")), holds.select("id", "words"), shingle=shingle, broadcast_bytes=broadcast_bytes).checkpoint()

    spans = F.sort_array(F.collect_set(F.struct("start", "stop")))
    union = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["to"], s["stop"]).alias("to"), (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["to"], s["start"]))).alias("n")),
    )["n"]
    covered = hits.groupBy("key").agg(spans.alias("spans")).select("key", union.cast("long").alias("n_hit"))
    named = hits.select("key", "id").distinct().join(holds.select("id", F.explode("items").alias("item")), "id").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = covered.join(named, "key").select(F.col("key").alias("hit_key"), "n_hit", "items")
    counted = own.select("key", F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), GAP), "")).cast("long").alias("n_words"))
    return counted.join(found, F.col("key").eqNullSafe(F.col("hit_key")), "left").select(
        F.col("key.id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
