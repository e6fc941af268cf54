"""Language of web pages by Bayesian fusion of evidence.

log P(language | page) = log prior(host) + log P(text | language) + log P(declared | language) + const.

Text likelihoods are naive Bayes over hashed words and character trigrams, counted over all labelled
documents. A first decision from the text alone is then counted over all pages, by declared markup
language, by address suffix and by host. Priors are smoothed down the hierarchy: a suffix towards all
pages, a host towards its suffix; all counts are grouped aggregates. A page's own first decision is
taken out of all counts that it meets, so its text is not evidence twice.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import use_checkpoints
from .arrays import LOWER, SPACE, U64, mix, span_hash, text_blocks, words

BUCKETS = 1 << 15
KAPPA = 5.0  # pseudo-pages that a parent's prior counts as
TEMPER = 0.25  # of the text's log likelihood, whose features are not independent
#: Elements whose content no reader sees as text of the page.
HIDDEN = ("script", "style", "nav")
_OPENS = re.compile(r"(?i)<(?:!--|(script|style|nav)\b)?")


def visible_text(page: str | None) -> str:
    """What a reader sees of a page: no scripts, styles, comments, navigation or tags.

    One pass: each '<' begins a comment, a hidden element or a tag, which its closing part ends; where
    none follows, '<' is text (of hidden elements, a tag). That a closing part is missing is found once for the page and
    remembered, so broken markup takes no longer than other text.
    """
    if not page:
        return ""
    low, out, at, missing = page.lower() if page.isascii() else _ascii_lower(page), [], 0, set()

    def after(close: str, start: int) -> int:
        """Where the next `close` ends, or -1."""
        while close not in missing:
            found = low.find(close, start)
            end = found + len(close)
            if found >= 0 and close[:2] != "</":
                return end
            bracket = low.find(">", end) if found >= 0 else -1
            if bracket >= 0 and not low[end:bracket].strip():
                return bracket + 1
            start = end
            if bracket < 0:
                missing.add(close)
        return -1

    while (m := _OPENS.search(page, at)) is not None:
        out.append(page[at : m.start()])
        kind = m[1].lower() if m[1] else "--" if m[0] == "<!--" else ""
        end = after("-->" if kind == "--" else f"</{kind}", m.end()) if kind else -1
        if end < 0:
            end = after(">", m.start() + 1)
        if end < 0:
            out.append(page[m.start() :])
            at = len(page)
            break
        out.append(" ")
        at = end
    out.append(page[at:])
    return entities.unescape("".join(out))


def _ascii_lower(text: str) -> str:
    """A-Z in lower case, character by character, so that places stay."""
    return text.translate(_LOWER)


_LOWER = {i: i + 32 for i in range(65, 91)}


def _features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and of every trigram of bytes within words."""
    low = LOWER[buf]
    starts, ends, rows = words(low, offsets)
    at = np.arange(max(0, len(low) - 2))
    blank = SPACE[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    inside = ~(blank[:-2] | blank[1:-1] | blank[2:] | edge[1 : len(low) - 1] | edge[2 : len(low)]) if len(at) else np.zeros(0, bool)
    at = at[inside]
    row = np.concatenate([rows, np.searchsorted(offsets, at, side="right") - 1])
    trigram = low[at].astype(U64) | low[at + 1].astype(U64) << U64(8) | low[at + 2].astype(U64) << U64(16)
    h = np.concatenate([span_hash(low, starts, ends), mix(trigram + U64(1 << 24))])
    return row, (h & U64(BUCKETS - 1)).astype(np.int64)


class TextModel:
    """log P(bucket | language), add-one smoothed."""

    def __init__(self, languages: Sequence[str], counts: np.ndarray):
        self.languages = list(languages)
        self.logs = (np.log(counts + 0.5) - np.log(counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])).astype(np.float32)

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, bucket = _features(buf, offsets)
        return np.stack([np.bincount(row, m[bucket], len(offsets) - 1) for m in self.logs], axis=1)


def train_text(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_languages: int = 500) -> TextModel:
    """Counts over all documents with a language; what reaches the driver is languages x BUCKETS numbers.

    Batches add up their own counts before the shuffle. More than max_languages languages are an
    error: the model, which every task holds, would grow with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(1).to_pylist()
            own = sorted(set(names))
            held = np.zeros((len(own), BUCKETS), np.int64)
            code = np.array([own.index(n) for n in names], np.int64)
            for lo, _, buf, offsets in text_blocks(b.column(0)):
                row, bucket = _features(buf, offsets)
                held += np.bincount(code[lo + row] * BUCKETS + bucket, minlength=held.size).reshape(held.shape)
            i, j = np.nonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([own[k] for k in i], pa.string()), pa.array(j.astype(np.int32)), pa.array(held[i, j])], names=["lang", "bucket", "n"])

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    langs = sorted(r[0] for r in rows.select(F.col(lang_col)).distinct().limit(max_languages + 1).collect())
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    counts = np.zeros((len(langs), BUCKETS))
    summed = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    for r in summed.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():
        counts[langs.index(r["lang"])][np.array(r["b"])] = r["n"]
    return TextModel(langs, counts)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def declared_language(page: Column) -> Column:
    """The language of the first html element, without its region, '' where it has none; data-lang and xml:lang are other attributes."""
    element = F.regexp_extract(F.coalesce(page, F.lit("")), r"(?i)<html\b([^>]*+)", 1)
    return F.lower(F.regexp_extract(element, r"(?i)\slang\s*=\s*[\"']?([a-zA-Z]+)", 1))


def identify_languages(pages: DataFrame, model: TextModel, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", kappa: float = KAPPA, temper: float = TEMPER) -> DataFrame:
    """(page_id, host, suffix, declared, text_lang, lang, confidence) of each row.

    Pages without text or address, and null columns, lean on what evidence there is; without any, on
    the share of each language. Rows keep their number, repeated ids included. An empty model gives
    null languages. Other columns are not read. What is read of the pages is checkpointed; hosts
    meet it in a join of narrow rows, which adaptive execution may split where a host has most pages.
    """
    langs = model.languages
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([visible_text(x) for x in b.column(4).to_pylist()], pa.string())
            scores = [held.value.score(buf, offsets) for *_, buf, offsets in text_blocks(texts)] if langs else []
            s = np.concatenate([np.zeros((0, len(langs))), *scores]) * temper
            s -= s.max(axis=1, keepdims=True) if s.size else 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (b.num_rows + 1) * len(langs), len(langs)) if langs else np.zeros(b.num_rows + 1), pa.int32()), pa.array(s.ravel(), pa.float64()))
            best = [langs[i] for i in s.argmax(axis=1)] if langs else [None] * b.num_rows
            told = np.abs(s).sum(axis=1) > 0 if langs else np.zeros(b.num_rows, bool)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array([x if t else None for x, t in zip(best, told, strict=True)], pa.string()), lists], names=["page_id", "host", "suffix", "declared", "text_lang", "logs"])

    kind = pages.schema[id_col].dataType.simpleString()
    host = host_of(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"), declared_language(F.col(html_col)).alias("declared"), F.col(html_col).cast("string"))
    read = rows.mapInArrow(run, f"page_id {kind}, host string, suffix string, declared string, text_lang string, logs array<double>")
    if not langs:
        return read.select("page_id", "host", "suffix", "declared", "text_lang", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"))
    use_checkpoints(pages.sparkSession)
    read = read.checkpoint()
    told, names = read.where("text_lang is not null"), F.array(*map(F.lit, langs))

    def counts(name: str, *keys: str) -> DataFrame:
        """Pages of each language by key, as array<long> in the model's order."""
        by = told.groupBy(*keys, "text_lang").agg(F.count("*").alias("n"))
        by = by.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("text_lang", "n"))).alias("m"))
        return by.select(*keys, F.transform(names, lambda x: F.coalesce(F.try_element_at("m", x), F.lit(0).cast("long"))).alias(name))

    def others(n: str) -> Column:
        """The counts without the page's own first decision."""
        held = F.coalesce(n, F.array_repeat(F.lit(0).cast("long"), len(langs)))
        return F.zip_with(held, names, lambda x, lang: x - F.coalesce(lang == F.col("text_lang"), F.lit(False)).cast("long")).alias(n)

    def smoothed(n: str, prior: str, name: str) -> Column:
        total = F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.zip_with(n, prior, lambda x, p: (x + p * kappa) / (total + kappa)).alias(name)

    met = read.join(counts("by_host", "host"), "host", "left").join(counts("by_suffix", "suffix"), "suffix", "left").join(counts("by_declared", "declared"), "declared", "left")
    met = met.crossJoin(F.broadcast(counts("of_all")))  # one row
    met = met.select("page_id", "host", "suffix", "declared", "text_lang", "logs", *map(others, ("by_host", "by_suffix", "by_declared", "of_all")))
    met = met.withColumn("flat", F.array_repeat(F.lit(1.0 / len(langs)), len(langs)))
    for n, prior, name in (("of_all", "flat", "p_all"), ("by_suffix", "p_all", "p_suffix"), ("by_host", "p_suffix", "p_host")):
        met = met.withColumn(name, smoothed(n, prior, name))
    seen = F.exists("by_declared", lambda x: x > 0)
    declared_logs = F.zip_with("by_declared", "of_all", lambda x, t: F.when(seen, F.log((x + 0.5) / (t + 1.0))).otherwise(0.0))
    logs = F.zip_with(F.zip_with("logs", "p_host", lambda a, p: a + F.log(p)), declared_logs, lambda a, d: a + d)
    fused = met.withColumn("l", logs).withColumn("top", F.array_max("l"))
    best = F.element_at(names, F.array_position("l", F.col("top")).cast("int"))
    mass = F.aggregate("l", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    return fused.select("page_id", "host", "suffix", "declared", "text_lang", best.alias("lang"), (1 / mass).alias("confidence"))
