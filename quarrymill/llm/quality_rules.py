"""Rules on repetition in texts, by a suffix array over the words of each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import suffixes
from .arrays import counts_by_row, number_pairs, number_spans, rows_of, text_blocks, words

MIN_REPEAT = 8
MAX_COVERED = 0.45
MAX_LONGEST = 0.25
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat", "n_maximal"]


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def maximal_repeats(symbols: np.ndarray, rows: np.ndarray, n_rows: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the occurrences of maximal repeats of at least `least` symbols within a row.

    symbols: numbers of the words, rows: their documents. Places of the suffix array that share
    `least` symbols are its longest-common-prefix intervals of that depth; the longest repeat at a
    suffix is the larger of its common prefixes with its two neighbours. An occurrence counts unless
    the one that starts a symbol earlier reaches as far, so what is left cannot be extended.
    """
    ends = np.searchsorted(rows, rows, side="right")
    sa, _, kept = suffixes.refine(number_pairs(rows, symbols), ends, keep=True)
    length, ranks = next(((d, r) for d, r in reversed(kept) if d <= least), kept[0])
    near = np.flatnonzero(ranks[sa[1:]] == ranks[sa[:-1]]) if len(sa) > 1 else np.zeros(0, np.int64)
    a, b = sa[near], sa[near + 1]
    common = suffixes.common_by_ranks(kept, a, b, ends)
    longest = np.zeros(len(symbols) + 1, np.int64)
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    longest = longest[:-1]
    wide = longest >= least
    inner = np.zeros(len(symbols), bool)
    inner[1:] = (rows[1:] == rows[:-1]) & (longest[:-1] > longest[1:])
    at = np.flatnonzero(wide & ~inner)
    return at, longest[at]


def measure(buf: np.ndarray, offsets: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """The counts of every row of a block."""
    n_rows = len(offsets) - 1
    starts, ends, rows = words(buf, offsets)
    inside = np.zeros(len(buf) + 1, np.int64)
    inside[starts] += 1
    np.add.at(inside, ends, -1)
    out = {"n_words": counts_by_row(rows, n_rows)}
    out["word_chars"] = _per_row((np.cumsum(inside[:-1]) > 0) & ((buf & 0xC0) != 0x80), offsets)
    out["n_symbols"] = _per_row(SYMBOLS[buf], offsets)
    word, _ = number_spans(buf, starts, ends)

    # lines with a word that equal an earlier one
    breaks = np.flatnonzero(buf == 0x0A)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(buf)]
    line_rows = rows_of(offsets, line_starts)
    line_ends = np.minimum(np.append(breaks, len(buf))[np.searchsorted(breaks, line_starts)], offsets[line_rows + 1])
    wordy = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_rows = line_starts[wordy], line_ends[wordy], line_rows[wordy]
    _, firsts = np.unique(number_pairs(number_spans(buf, line_starts, line_ends)[0], line_rows), return_index=True)
    out["n_dup_lines"] = counts_by_row(line_rows, n_rows) - counts_by_row(line_rows[firsts], n_rows)

    # words in windows of three that are found again
    n = len(word)
    repeated = np.zeros(n, bool)
    if n > 2:
        key = number_pairs(number_pairs(number_pairs(word[:-2], rows[:-2]), word[1:-1]), word[2:])
        at = np.flatnonzero(rows[:-2] == rows[2:])
        order = np.argsort(key[at], kind="stable")
        s = key[at][order]
        same = np.zeros(len(s) + 1, bool)
        same[1:-1] = s[1:] == s[:-1]
        again = at[order[same[1:] | same[:-1]]]
        for j in range(3):
            repeated[again + j] = True
    out["n_repeat_words"] = counts_by_row(rows[repeated], n_rows)

    at, length = maximal_repeats(word, rows, n_rows, least) if n else (np.zeros(0, np.int64),) * 2
    out["n_covered"] = counts_by_row(rows[_covered(at, length, n)], n_rows)
    out["longest_repeat"] = np.zeros(n_rows, np.int64)
    np.maximum.at(out["longest_repeat"], rows[at], length)
    out["n_maximal"] = counts_by_row(rows[at], n_rows)
    return out


class Rules:
    """The limits that a document must keep to."""

    def __init__(self, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST, min_words: int = 50):
        self.min_repeat, self.max_covered, self.max_longest, self.min_words = min_repeat, max_covered, max_longest, min_words

    def apply(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """COLUMNS, base_failed and kept of each text."""
        parts = [measure(buf, offsets, self.min_repeat) for *_, buf, offsets in text_blocks(texts)]
        out = {c: np.concatenate([np.zeros(0, np.int64), *(p[c] for p in parts)]) for c in COLUMNS}
        n = out["n_words"]
        out["base_failed"] = (n < self.min_words) | (100 * out["n_repeat_words"] > 50 * n)
        out["kept"] = ~out["base_failed"] & (out["n_covered"] <= self.max_covered * n) & (out["longest_repeat"] <= self.max_longest * n)
        return out


def repetition_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
    longest_repeat, n_maximal, base_failed, kept) of each row; limits: those of Rules.

    n_covered: words in repeats of at least min_repeat words; longest_repeat: words of the longest.
    kept: base_failed is false, at most the share max_covered of the words is covered, and the
    longest repeat is at most the share max_longest. Null and empty texts have no words and fail.
    Rows keep their number, repeated ids included; other columns are not read. One pass without a
    shuffle; a task holds one Arrow batch and works through blocks of it.
    """
    rules = Rules(**limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = rules.apply(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in found.values())], names=["doc_id", *found])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS) + ", base_failed boolean, kept boolean")


def kept_rows(docs: DataFrame, *, text_col: str = "text", **limits) -> DataFrame:
    """The rows of docs that repetition_rules keeps, with all their columns, whatever their ids; no shuffle."""
    rules = Rules(**limits)

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        return pa.array(rules.apply(texts)["kept"])

    return docs.where(kept(F.col(text_col).cast("string")))  # only texts go to Python, only verdicts come back
