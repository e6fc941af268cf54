"""Order MinHash fingerprints (DataFrame functions only).

A text's k-mers are runs of k words; each character of scripts without spaces, and of runs too long
for a word, counts as a word, so an edit there moves no border further on. The j-th copy of a k-mer
in the text is an element of its own. One hash deals all elements over the buckets of a signature;
each bucket keeps its `take` least elements, puts them back into text order and hashes that tuple.
Texts share a bucket's value only where they share the least k-mers and their order, so the share
of equal buckets follows edit distance rather than set overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranged_neighbours

BUCKETS, TAKE, K = 32, 2, 3
WIDE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uAC00-\uD7FF\uF900-\uFAFF\uFE30-\uFE4F\uFF00-\uFFEF"  # written without spaces
PIECE = rf"[^\x20\x09-\x0D{WIDE}]{{1,24}}+(?![^\x20\x09-\x0D{WIDE}])|[^\x20\x09-\x0D]"
_BITS = 31  # for positions, as many as an array has; the hash has the other 33


def _elements(text: Column, k: int) -> Column:
    """array<bigint>: a hash of the occurrence-numbered k-mer above, its position below, sorted."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))
    low = F.lit((1 << _BITS) - 1)

    def packed(h: Column, at: Column) -> Column:
        return h.bitwiseAND(F.lit(~((1 << _BITS) - 1))).bitwiseOR(at.cast("long").bitwiseAND(low))

    def with_words(w: Column) -> Column:
        grams = F.when(
            F.size(w) > k,
            F.transform(F.slice(w, F.lit(1), F.size(w) - (k - 1)), lambda x, i: packed(F.xxhash64(x, *(F.get(w, i + j) for j in range(1, k))), i)),
        ).otherwise(F.when(F.size(w) > 0, F.array(packed(F.xxhash64(F.array_join(w, " ")), F.lit(0)))).otherwise(F.array().cast("array<bigint>")))
        return _let(F.sort_array(grams), numbered)

    def same(s: Column, i: Column) -> Column:
        """Is the k-mer of element i that of the element before it?"""
        return F.shiftright(F.get(s, i), _BITS) == F.shiftright(F.get(s, i - 1), _BITS)

    def numbered(s: Column) -> Column:
        repeats = F.when(F.size(s) > 1, F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda i: same(s, i))).otherwise(F.array().cast("array<int>"))
        return _let(repeats, lambda d: F.when(F.size(d) == 0, s).otherwise(renumbered(s, d)))

    def renumbered(s: Column, d: Column) -> Column:
        """d: where s repeats the element before; runs of consecutive d are the copies of one k-mer."""
        first = F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, _BITS) != F.shiftright(F.get(s, i - 1), _BITS)))
        heads = F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda j: (j == 0) | (F.get(d, j) != F.get(d, j - 1) + 1))
        again = F.flatten(
            _let(
                heads,
                lambda h: F.transform(
                    h,
                    lambda at, r: F.transform(
                        F.slice(d, at + 1, F.coalesce(F.get(h, r + 1), F.size(d)) - at),
                        lambda i, o: packed(F.xxhash64(F.shiftright(F.get(s, i), _BITS), o + 1), F.get(s, i)),
                    ),
                ),
            )
        )
        return F.sort_array(F.concat(first, again))

    return _let(words, with_words)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def signature(text: Column, *, buckets: int = BUCKETS, take: int = TAKE, k: int = K) -> Column:
    """array<int> of `buckets` values: 0 where a bucket has no element. `buckets` is a power of two."""
    bits = buckets.bit_length() - 1

    def chosen(s: Column) -> Column:
        bucket = lambda x: F.shiftrightunsigned(x, 64 - bits).cast("int")
        # signed order keeps buckets together; an element is among the least unless `take` before it share its bucket
        least = F.filter(s, lambda x, i: (i < take) | (bucket(F.get(s, i - take)) != bucket(x)))
        low = F.lit((1 << _BITS) - 1)

        def value(own: Column) -> Column:
            ordered = F.sort_array(F.transform(own, lambda x: F.struct(x.bitwiseAND(low).alias("at"), F.shiftright(x, _BITS).alias("h"))))
            return F.when(F.size(own) == 0, F.lit(0)).otherwise(F.hash(F.xxhash64(ordered["h"])).bitwiseOR(F.lit(1)))

        return _let(least, lambda m: F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: value(F.filter(m, lambda x: bucket(x) == b))))

    return _let(_elements(text, k), chosen)


def likeness(a: Column, b: Column) -> Column:
    """Share of the buckets used by either signature in which both agree; 1 for two empty texts."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), F.lit(None)).otherwise(x == y))
    used = F.filter(pairs, lambda p: p.isNotNull())
    return F.when(F.size(used) == 0, F.lit(1.0)).otherwise(F.size(F.filter(used, lambda p: p)) / F.size(used))


def as_hex(sig: Column) -> Column:
    """The signature as text, 8 hex digits a bucket."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def order_minhash(docs: DataFrame, *, text_col: str = "text", buckets: int = BUCKETS, take: int = TAKE, k: int = K) -> DataFrame:
    """docs with the columns signature array<int> and fingerprint string.

    Null and empty texts, and texts of white space, have the signature of zeros. Texts of at most
    k words are one element. Works row by row: no shuffle, and texts may be of any length.
    """
    out = docs.withColumn("signature", signature(F.col(text_col), buckets=buckets, take=take, k=k))
    return out.withColumn("fingerprint", as_hex(F.col("signature")))


def compare_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how near both and the next document are.

    The edited text ends with the start of the next document, in descending order of id, instead
    of its own last third. Rows that repeat an id are documents that follow each other, by a hash of
    their texts; rows that repeat both stand at one place and each keep their row. Null ids come
    last. A table of one document is its own next document. Texts are shuffled once; besides them
    only the starts that edits take from the next document move.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.struct("id", F.xxhash64("text").alias("h")).alias("key")
    narrow = own.select(key, F.length("text").alias("n")).groupBy("key").agg(F.max("n").alias("n"))
    ring = ranged_neighbours(narrow, "key", ["n"], parts).select("key", "prev_key", F.floor(F.col("prev_n") / 3).cast("int").alias("take"))
    # the start of each text goes to the document before it; texts stay where the first join put them
    placed = own.select(key, "text").join(ring, "key")
    starts = placed.select(F.col("prev_key").alias("to"), F.expr("substring(text, 1, take)").alias("start")).groupBy("to").agg(F.max("start").alias("start"))
    merged = placed.join(starts, F.col("key") == F.col("to")).select("key", "text", "start", "prev_key")
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), F.col("start"))
    marked = merged.select(
        "key", "prev_key", n.cast("long").alias("n_chars"),
        F.sha2(F.encode(edited, "UTF-8"), 256).alias("edited_sha256"),
        F.expr("transform(array(text, concat(substring(text, 1, length(text) - cast(floor(length(text) / 3) as int)), start)), x -> x)").alias("texts"),
    )
    signed = marked.select("key", "prev_key", "n_chars", "edited_sha256", F.transform("texts", lambda t: signature(t)).alias("s"))
    own_row = F.struct("key", F.struct("n_chars", "edited_sha256", "s").alias("own"), F.lit(None).cast("array<int>").alias("next"))
    to_prev = F.struct(F.col("prev_key").alias("key"), F.lit(None).cast("struct<n_chars:bigint,edited_sha256:string,s:array<array<int>>>").alias("own"), F.col("s")[0].alias("next"))
    met = signed.select(F.explode(F.array(own_row, to_prev)).alias("r")).select("r.*")
    met = met.groupBy("key").agg(F.max("own").alias("own"), F.max("next").alias("next"), F.count("own").alias("rows"))
    met = met.select("key", "own", "next", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    sig, edit = F.col("own.s")[0], F.col("own.s")[1]
    return met.select(
        F.col("key.id").alias("doc_id"), F.col("own.n_chars").alias("n_chars"), F.col("own.edited_sha256").alias("edited_sha256"),
        as_hex(sig).alias("fingerprint"), as_hex(edit).alias("edited_fingerprint"),
        likeness(sig, edit).alias("near_edited"), likeness(sig, F.col("next")).alias("near_next"),
    )
