"""Secrets in texts: wide candidate search, then a random forest that removes false positives.

Candidates are words that could hold a credential (digits or mixed case in a long run, a value after
a credential's name), their parts between quotes, ';', ',' and '=', every known format in them, and
blocks of private keys. The forest sees their length, character transitions, how much of them common
words cover, the document's path and the neighbouring words. It is trained from labelled findings.

Where no table of them is given, findings that settle themselves serve: known formats and random
values after a credential's name are secrets; addresses, numbers, placeholders, and values after the
name of a digest or an id are none; the rest is left to the forest. How a finding came up is no
feature, and findings are scored by a forest that was fitted on the documents of the other half.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import LOWER, number_spans, text_blocks, words
from .common import first_rows, fresh

TREES, DEPTH, MAX_FINDINGS = 30, 8, 6000
THRESHOLD = 0.5
MIN_LENGTH = 8  # of a candidate that no credential's name announces
BITS, PROBES = 1 << 27, 4  # of the filter of common words: 16 MB, whatever the corpus holds
HEADS, STEP = 1 << 17, 32  # masks of the lengths that words have which begin alike: 1 MB

#: Names after which a value is a credential.
NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth", "credential", "private_key")
_NAME = r"(?:" + "|".join(NAMES) + r")\\*[\"'`]?"
#: A value after a name; a chain of names (token=secret=...) counts from its last.
_ASSIGNED = re.compile(rf"(?i){_NAME}\s*[:=]+>?\s*\\*[\"'`]?(?!{_NAME}[:=])([^\s\"',;]+)")
_MARK = re.compile(rf"(?i){_NAME}\s*[:=]")
_LETTERS = re.compile(r"[a-z\x80-\U0010FFFF]+")  # what words that are counted consist of
_PART = re.compile(r"[^;,=]+")
_CORE = re.compile(r"[^\s\"'`.,;:!?()\[\]<>#*$%&|](?:[^\s\"'`]*[^\s\"'`.,;:!?()\[\]<>#*$%&|])?")
_NAMED = re.compile(r"(?i)(?:" + "|".join(NAMES) + r")$")
#: Public formats of credentials.
FORMATS = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{12,16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abpr]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{16,}|eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]*")
#: What a text holds, besides words that look random, if it has candidates: names and beginnings of formats.
_HINTS = "(?i)" + "|".join((*NAMES, "PRIVATE KEY-----", "PRIVATE KEY BLOCK-----", "AKIA", "ASIA", "gh[pousr]_", "xox[abpr]-", "AIza", "sk_live_", "eyJ"))
#: The first and last lines of a private key in armour, and a line of such a key.
_BEGIN = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_LINES = re.compile(r"(?:\s+[A-Za-z0-9+/=]{16,})*+")
#: Names before a value that is a digest, an id or a version.
OTHER_NAMES = ("commit", "sha", "sha1", "sha256", "sha512", "md5", "checksum", "digest", "hash", "etag", "revision", "uuid", "guid", "id", "build", "version", "fingerprint", "isbn", "doi")
_OTHER = re.compile(r"(?i)(?:^|[^a-z0-9])(?:" + "|".join(OTHER_NAMES) + r")$")
_LETTER = re.compile(r"[A-Za-z]")
_OWN_NAME = re.compile(r"([A-Za-z][\w.-]*)[:=]+\S")
_UNSPOKEN = re.compile(r"(?i)[bcdfghjklmnpqrstvwxz]{6}")  # letters of no language
#: Formats of what is no credential: addresses, numbers, dates, versions, placeholders.
PLAIN = re.compile(r"[^@\s]+@[^@\s]+\.\w+|\(?\+?[\d().:/-]+\)?|https?://\S+|v?\d+(?:\.\d+)+\w*|[a-z]+\d{1,4}|x+|\*+|<[^>]*>|\$?\{[^}]*\}|[A-Za-z]+(?:[-'/][A-Za-z]+)*", re.IGNORECASE)
FEATURES = ("length", "digits", "upper", "lower", "other", "kinds", "transitions", "distinct", "entropy", "hex", "rarity", "covered", "named", "other_name", "quoted", "path_depth", "path_test", "before_known", "after_known", "before_length")


def candidates(text: str) -> Iterator[tuple[int, str, str, str, str]]:
    """(start, value, word before, word after, kind) of each candidate; start counts characters.

    Spans of one word may overlap: a format is searched for within longer values as well. The word
    before is the name that a value is given to, where it has one.
    """
    low = text.lower()
    names = any(x in low for x in NAMES)
    named = [m.span(1) for m in _ASSIGNED.finditer(text)] if names else []
    marks = [m.end() for m in _MARK.finditer(text)] if names else []
    at = mark = near = 0
    before: tuple[str, str] = ("", "")
    follow = re.finditer(r"[^\x20\x09-\x0D]+", text)
    next(follow, None)
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        first, after = at, next(follow, None)
        while at < len(named) and named[at][0] < m.end():
            at += 1
        word, near = m.group(), near - 1
        while mark < len(marks) and marks[mark] <= m.end():
            mark, near = mark + 1, 2
        if _possible(word) or near >= 0 or at > first:
            last = before[0] if before[1] in ("=", ":", ":=", "=>") else before[1]
            for (a, b), kind in sorted(_spans(word, [(a - m.start(), b - m.start()) for a, b in named[first:at]]).items()):
                yield m.start() + a, word[a:b], _given_name(word, a) or last, after.group() if after else "", kind
        before = (before[1], word)
    if "PRIVATE KEY" in text:
        for a, b in key_blocks(text):
            yield a, text[a:b], "", "", "block"


def key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans of private keys in armour: from each first line to its last line, whatever stands between.

    A first line without a last line before the next first line takes the lines of key that follow it.
    """
    begins = list(_BEGIN.finditer(text))
    ends, k = [m.end() for m in _END.finditer(text)], 0
    for m, following in zip(begins, [*(x.start() for x in begins[1:]), len(text)], strict=True):
        while k < len(ends) and ends[k] <= m.end():
            k += 1
        yield m.start(), ends[k] if k < len(ends) and ends[k] <= following else _LINES.match(text, m.end()).end()


def _given_name(word: str, at: int) -> str:
    """The name that the value at `at` of a word is given to by ':' or '=', or ''."""

    def back(i: int, chars: str) -> int:
        while i and word[i - 1] in chars:
            i -= 1
        return i

    i = back(at, "\\\"'`")
    if i and word[i - 1] == ">" and i > 1 and word[i - 2] in ":=":
        i -= 1
    sign = back(i, ":=")
    end = j = back(sign, "\\\"'`")
    while j and (word[j - 1].isalnum() or word[j - 1] in "_.-"):
        j -= 1
    name = _LETTER.search(word, j, end) if sign < i else None
    return word[name.start() : end] if name else ""


def _spans(word: str, named: list[tuple[int, int]]) -> dict[tuple[int, int], str]:
    """Spans of the candidates in a word, with their kind; named: spans of values after a name, in order.

    These are the named values, known formats, what quotes part, and what ';', ',' and '=' part within that.
    """
    out: dict[tuple[int, int], str] = {}

    def add(span: tuple[int, int], kind: str) -> None:
        if span[1] - span[0] >= MIN_LENGTH or kind == "assigned":
            out.setdefault(span, kind)

    for a, b in named:
        for core in _CORE.finditer(word, a, b):
            add(core.span(), "assigned")
    for m in FORMATS.finditer(word):
        add(m.span(), "word")
    at = 0
    for run in _CORE.finditer(word):
        lo, end = run.span()
        while at < len(named) and named[at][1] <= lo:
            at += 1
        k = at
        while k < len(named) and named[k][0] < end:
            k += 1
        if k == at:
            add((lo, end), "word")
        for a, b in [*named[at:k], (end, end)]:
            for part in _PART.finditer(word, lo, max(lo, a)):
                core = _CORE.search(word, *part.span())
                if core and core.group().lower() not in NAMES:
                    add(core.span(), "word")
            lo = b
    return out


def _possible(word: str) -> bool:
    """Does a word look like a credential by itself? The two words after a name's ':' or '=' need not."""
    return len(word) >= MIN_LENGTH and (any(c.isdigit() for c in word) or "=" in word or sum(a.islower() and b.isupper() for a, b in zip(word, word[1:], strict=False)) >= 2 or FORMATS.search(word) is not None)


def settled(value: str, kind: str, before: str = "") -> int | None:
    """1 for a known format or a random value after a credential's name, 0 for a plain format or a
    value after the name of a digest or an id (in front of it or in it); None where that leaves it open, as for letters that could
    be read, or short values, after a name.
    """
    if kind == "block" or FORMATS.fullmatch(value):
        return 1
    if kind == "assigned" and value.isalpha():
        return 1 if _UNSPOKEN.search(value) else None
    own = _OWN_NAME.match(value)
    if PLAIN.fullmatch(value) or _OTHER.search(own[1] if own else _bare(before)):
        return 0
    if kind != "assigned":
        return None
    kinds = sum(any(f(c) for c in value) for f in (str.isdigit, str.isupper, str.islower))
    return 1 if kinds > 1 and len(set(value)) >= 8 else None


def _bare(word: str) -> str:
    return word.rstrip(":=>\"'`\\")


def pair_counts(counts: list[tuple[str, int]]) -> np.ndarray:
    """Transitions between the characters of words and the blanks around them; all beyond ASCII are one."""
    pairs = np.zeros((128, 128))
    for w, n in counts:
        for a, b in zip(" " + w, w + " ", strict=True):
            pairs[min(ord(a), 127), min(ord(b), 127)] += n
    return pairs


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode())


def _head(key: str) -> int:
    return BITS // 64 + _hash(key) % HEADS


def word_bits(word: str) -> Iterator[tuple[int, int]]:
    """(slot, bit) of all that a CommonWords of 64-bit slots holds of a word: its places in the filter, and its
    length in the mask of its first three characters. Each STEP characters of it have a mask of their own.
    """
    h = _hash(word)
    for k in range(PROBES):
        place = (h + k * (h >> 32 | 1)) % BITS
        yield place >> 6, place & 63
    key, done = word[:3], 0
    while len(word) - done >= STEP:
        yield _head(key), STEP
        done += STEP
        key = word[:done]
    yield _head(key), len(word) - done


class CommonWords:
    """A Bloom filter of words, and what lengths they have by how they begin. Its size is fixed.

    All words that it was made of are found. Another is found with odds of about
    (1 - exp(-PROBES * words / BITS)) ** PROBES: 1e-6 for a million words, 0.004 for ten million.
    """

    def __init__(self, slots: np.ndarray, bits: np.ndarray):
        """Numbers of slots, and what their 64 bits are."""
        self.held = np.zeros(BITS // 64 + HEADS, np.uint64)
        self.held[slots] = bits

    @classmethod
    def of(cls, words: Iterable[str]) -> CommonWords:
        masks = _masks(words)
        return cls(np.fromiter(masks, np.int64, len(masks)), np.fromiter(masks.values(), np.uint64, len(masks)))

    @cached_property
    def _slots(self) -> memoryview:
        return memoryview(self.held)

    def __getstate__(self) -> dict:
        return {"held": self.held}

    def __contains__(self, word: str) -> bool:
        h, slots = _hash(word), self._slots
        step = h >> 32 | 1
        for _ in range(PROBES):
            place = h % BITS
            if not slots[place >> 6] >> (place & 63) & 1:
                return False
            h += step
        return True

    def longest(self, text: str, at: int) -> int:
        """Length of the longest word, of three characters or more, that begins there; 0 for none."""
        sizes, key, done, room = [], text[at : at + 3], 0, len(text) - at
        while len(key) >= 3:
            mask = self._slots[_head(key)]
            sizes += [done + k for k in range(min(STEP, room - done + 1)) if mask >> k & 1] if mask else []
            done += STEP
            if not mask >> STEP & 1 or done > room:
                break
            key = text[at : at + done]
        return next((k for k in reversed(sizes) if k >= 3 and text[at : at + k] in self), 0)


def _masks(words: Iterable[str]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for w in words:
        for slot, bit in word_bits(w):
            masks[slot] = masks.get(slot, 0) | 1 << bit
    return masks


class Language:
    """Character transitions of ordinary text, and its common words."""

    def __init__(self, counts: list[tuple[str, int]], pairs: np.ndarray | None = None, common: CommonWords | None = None):
        """counts: common words; pairs: counts of transitions; common: the words. Both are made from counts where not given."""
        self.common = CommonWords.of(w for w, _ in counts) if common is None else common
        pairs = np.ones((128, 128)) + (pair_counts(counts) if pairs is None else pairs)
        self.logs = np.log(pairs / pairs.sum(axis=1, keepdims=True))

    def known(self, pieces: list[str]) -> np.ndarray:
        """Which of the pieces are common words?"""
        return np.array([p in self.common for p in pieces], bool)

    def rarity(self, value: str) -> float:
        """Mean negative log probability of a transition."""
        v = value.lower()
        return -float(np.mean([self.logs[min(ord(a), 127), min(ord(b), 127)] for a, b in zip(" " + v, v + " ", strict=True)]))

    def covered(self, value: str) -> float:
        """Share of the characters in common words of three letters or more, longest first."""
        v, n = value.lower(), 0
        for run in _LETTERS.finditer(v):
            text, i = run.group(), 0
            while i < len(text):
                size = self.common.longest(text, i)
                n, i = n + size, i + max(1, size)
        return n / max(1, len(v))

    def features(self, value: str, before: str, after: str, path: str) -> list[float]:
        n = len(value)
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
        share = [kinds.count(k) / n for k in "dulo"]
        p = np.unique(list(value), return_counts=True)[1] / n
        clean = lambda w: w.lower().strip("\"'.,;:!?()")
        return [
            float(min(n, 200)), *share, float(len(set(kinds))), sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n, len(p) / n,
            float(-(p * np.log2(p)).sum()), float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))), self.rarity(value), self.covered(value),
            float(bool(_NAMED.search(_bare(before)))), float(bool(_OTHER.search(_bare(before)))), float(before[-1:] in "\"'=:" and before != ""), float(path.count("/")), float("test" in path.lower() or "example" in path.lower()),
            *map(float, self.known([clean(before), clean(after)])), float(min(len(before), 40)),
        ]


class Forest:
    """Bagged trees on random feature subsets, split by Gini impurity."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, seed: int = 11):
        self.n_trees, self.depth, self.rng, self.trees = trees, depth, np.random.default_rng(seed), []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        for _ in range(self.n_trees):
            own = self.rng.integers(0, len(y), len(y))
            self.trees.append(self._grow(x[own], y[own], self.depth))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        share = float(y.mean())
        if depth == 0 or len(y) < 8 or share in (0.0, 1.0):
            return share
        best = (2 * share * (1 - share) - 1e-9, None, None)
        for f in self.rng.choice(x.shape[1], int(np.ceil(np.sqrt(x.shape[1]))), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(cut):
                continue
            left, right = ones[cut - 1] / cut, (ones[-1] - ones[cut - 1]) / (len(y) - cut)
            gini = (cut * 2 * left * (1 - left) + (len(y) - cut) * 2 * right * (1 - right)) / len(y)
            i = int(np.argmin(gini))
            if gini[i] < best[0]:
                best = (gini[i], int(f), (v[cut[i] - 1] + v[cut[i]]) / 2)
        if best[1] is None:
            return share
        low = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[low], y[low], depth - 1), self._grow(x[~low], y[~low], depth - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))

        def walk(node, at: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, float):
                out[at] += node
                return
            f, cut, low, high = node
            goes = x[at, f] <= cut
            walk(low, at[goes])
            walk(high, at[~goes])

        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return out / max(1, len(self.trees))


FOUND = ["doc_id", "path", "start", "value", "before", "after", "kind"]


def _found(b: pa.RecordBatch) -> pa.RecordBatch:
    """(doc_id, text, path) to one row a candidate."""
    keys, paths, out = b.column(0).to_pylist(), b.column(2).to_pylist(), []
    for lo, _, buf, offsets in text_blocks(b.column(1)):
        for i in _rows_with_candidates(buf, offsets):
            text = buf[offsets[i] : offsets[i + 1]].tobytes().decode()
            out += [(keys[lo + i], paths[lo + i] or "", *c) for c in candidates(text)]
    cols = list(zip(*out, strict=True)) or [()] * 7
    kinds = [b.schema.field(0).type, pa.string(), pa.int64(), *[pa.string()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=FOUND)


def _labelled(b: pa.RecordBatch) -> pa.RecordBatch:
    """Those rows of FOUND that settle themselves, with their label."""
    labels = pa.array([settled(v, k, w) for v, w, k in zip(*(b.column(i).to_pylist() for i in (3, 4, 6)), strict=True)], pa.int32())
    return pa.RecordBatch.from_arrays([*b.columns, labels], names=[*b.schema.names, "label"]).filter(labels.is_valid())


def _search(docs: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], more: str, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield make(b)

    kind = docs.schema[id_col].dataType.simpleString()
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"), path.alias("path"))
    return rows.mapInArrow(run, f"doc_id {kind}, path string, start long, value string, before string, after string, kind string{more}")


def find_candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row a candidate: doc_id, path, start, value, before, after, kind. Whole texts; null has none."""
    return _search(docs, _found, "", id_col, text_col, path_col)


def settled_candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """labelled_findings of find_candidates in one pass.

    Two passes in a stage hold two Python workers a core, which stay with the executor.
    """
    return _search(docs, lambda b: _labelled(_found(b)), ", label int", id_col, text_col, path_col)


def _rows_with_candidates(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a word that _possible may accept, or with a credential's name."""
    starts, ends, rows = words(buf, offsets)
    upper = (buf >= 65) & (buf <= 90) | (buf >= 0xC3)
    marks = (buf >= 48) & (buf <= 57) | (buf == 0x3D)
    sums = np.concatenate([[0], np.cumsum(marks)])
    rises = np.zeros(len(buf) + 1, np.int64)
    if len(buf):
        rises[2:] = np.cumsum(upper[1:] & ~upper[:-1])
    ok = (ends - starts >= MIN_LENGTH) & ((sums[ends] > sums[starts]) | (rises[ends] - rises[np.minimum(starts + 1, len(buf))] >= 2))
    held = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(buf)))
    hinted = pc.match_substring_regex(held, _HINTS).to_numpy(zero_copy_only=False)
    return np.union1d(rows[ok], np.flatnonzero(hinted))


def word_counts(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(word, n) of all words of three letters or more, of any script, over all texts.

    Batches count before anything is shuffled, so a frequent word is a row a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[bytes, int] = {}
            for *_, buf, offsets in text_blocks(b.column(0)):
                low = LOWER[buf]
                starts, ends, _ = words(low, offsets)
                odd = np.concatenate([[0], np.cumsum(~(((low >= 97) & (low <= 122)) | (low >= 128)))])
                letters = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
                ok = (odd[ends] == odd[starts]) & (letters[ends] - letters[starts] >= 3)
                starts, ends = starts[ok], ends[ok]
                number, at = number_spans(low, starts, ends)
                n = np.bincount(number, minlength=len(at))
                for s, e, c in zip(starts[at].tolist(), ends[at].tolist(), n.tolist(), strict=True):
                    w = low[s:e].tobytes()
                    held[w] = held.get(w, 0) + c
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_from(total: int) -> int:
    """How often a word must occur to be common, in a corpus of so many words.

    It grows with the root of the corpus: words that occur by chance stay out, while those of any
    source or language come in as it grows, however small its share.
    """
    return max(3, math.isqrt(total) // 500)


def common_words(counts: DataFrame, least: int) -> CommonWords:
    """Of the rows (word, n), the words with n of `least` or more.

    Tasks make bits of their words and aggregates join these by slot, so the driver receives as
    many numbers as a CommonWords has slots at most, whatever the number of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = _masks(b.column(0).to_pylist())
            bits = np.fromiter(masks.values(), np.uint64, len(masks)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(masks), pa.int32()), pa.array(bits)], names=["slot", "bits"])

    held = counts.where(F.col("n") >= least).select("word").mapInArrow(run, "slot int, bits long")
    slots = held.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    return CommonWords(slots["slot"].to_numpy(), slots["bits"].to_numpy().view(np.uint64))


def train_language(docs: DataFrame, *, text_col: str = "text") -> Language:
    """Transitions over all words of all texts, and every word that is common by common_from.

    The driver receives 128 x 128 sums and the slots of CommonWords, which do not grow with the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros((128, 128))
        for b in batches:
            pairs += pair_counts(list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)))
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(pairs.ravel()[at].astype(np.int64))], names=["pair", "n"])

    counts = word_counts(docs, text_col=text_col).persist()
    pairs = np.zeros(128 * 128)
    for pair, n in counts.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n")).collect():
        pairs[pair] = n
    pairs = pairs.reshape(128, 128)
    common = common_words(counts, common_from(int(pairs[ord(" ")].sum())))  # a word has one transition from the blank
    counts.unpersist()
    return Language([], pairs, common)


def labelled_findings(found: DataFrame) -> DataFrame:
    """Findings whose format or context settles whether they are secrets, with the column label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _labelled(b)

    fields = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in FOUND)
    return found.select(*FOUND).mapInArrow(run, f"{fields}, label int")


def half_of(value) -> Column:
    """0 or 1: the half of the documents that an id is in."""
    return F.pmod(F.xxhash64(F.lit("half"), value), F.lit(2)).cast("int")


def train_forest(findings: DataFrame, language: Language, *, max_findings: int = MAX_FINDINGS) -> Forest:
    """From rows (path, value, before, after, label), at most max_findings / 2 of each label, by hash.

    That bound makes the sample small enough for one task, which makes the features and fits.
    """
    cols = ["path", "value", "before", "after"]
    named = findings.select(*(F.coalesce(c, F.lit("")).alias(c) for c in cols), "label").distinct().withColumn("h", F.xxhash64(*cols))
    few = [first_rows(named.where(F.col("label") == x), max_findings // 2, "h", cols) for x in (0, 1)]
    held = findings.sparkSession.sparkContext.broadcast(language)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        if t.num_rows:
            path, value, before, after, y = (c.to_pylist() for c in t.columns)
            x = np.array([held.value.features(*r) for r in zip(value, before, after, path, strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Forest().fit(x, np.array(y, float)))], pa.binary())], names=["forest"])

    one = few[0].unionByName(few[1]).repartition(1).sortWithinPartitions("label", "h", *cols).select(*cols, "label")
    made = one.mapInArrow(fit, "forest binary").collect()
    return pickle.loads(made[0][0]) if made else Forest()


def score_findings(found: DataFrame, forests: Sequence[Forest], language: Language) -> DataFrame:
    """found with the column score, the share of votes for a secret; 0 from a forest without trees.

    Of several forests a document's half_of says which one scores its findings.
    """
    held = found.sparkSession.sparkContext.broadcast((forests, language))
    names = ["doc_id", "path", "start", "value", "before", "after", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            models, lang = held.value
            path, value, before, after = (b.column(i).to_pylist() for i in (1, 3, 4, 5))
            x = np.array([lang.features(*r) for r in zip(value, before, after, path, strict=True)]).reshape(b.num_rows, len(FEATURES))
            turn = b.column(7).to_numpy() % len(models)
            score = np.zeros(b.num_rows)
            for k, model in enumerate(models):
                score[turn == k] = model.score(x[turn == k])
            yield pa.RecordBatch.from_arrays([*b.columns[:7], pa.array(score)], names=[*names, "score"])

    fields = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in names)
    return found.select(*names, half_of(F.col("doc_id")).alias("half")).mapInArrow(run, f"{fields}, score double")


def train_scanner(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, findings: DataFrame | None = None) -> tuple[Sequence[Forest], Language]:
    """Forests and the language that they look at, from findings or else from those of docs that settle themselves.

    Words are counted over all texts, without a bound; a training sample is bounded by MAX_FINDINGS.
    """
    language = train_language(docs, text_col=text_col)
    if findings is not None:
        return [train_forest(findings, language)], language
    known = settled_candidates(docs, id_col=id_col, text_col=text_col, path_col=path_col).withColumn("half", half_of(F.col("doc_id"))).persist()
    forests = [train_forest(known.where(F.col("half") != k), language) for k in (0, 1)]
    if not all(f.trees for f in forests):  # too few findings for two halves
        forests = [train_forest(known, language)]
    known.unpersist()
    return forests, language


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row a finding: doc_id, path, start, value, before, after, kind, score, is_secret.

    start counts characters from 0. findings: labelled rows (path, value, before, after, label) to
    train from; without them those that settle themselves, each half of the documents scored by the
    forest of the other. Null and empty texts have no findings; rows that repeat an id, or have none,
    give their own.
    """
    forests, language = train_scanner(docs, id_col=id_col, text_col=text_col, path_col=path_col, findings=findings)
    found = find_candidates(docs, id_col=id_col, text_col=text_col, path_col=path_col)
    return score_findings(found, forests, language).withColumn("is_secret", F.col("score") >= threshold)


def redact_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, findings: DataFrame | None = None, threshold: float = THRESHOLD, mark: str = "[secret]") -> DataFrame:
    """docs with every secret that scan_secrets finds replaced by mark; all rows, columns and ids stay.

    A row is searched, scored and cleaned where it is read, so repeated and null ids do no harm and
    nothing is shuffled. Spans that overlap are one.
    """
    scanner = docs.sparkSession.sparkContext.broadcast(train_scanner(docs, id_col=id_col, text_col=text_col, path_col=path_col, findings=findings))
    def clean(text: str, path: str, turn: int) -> str:
        forests, language = scanner.value
        found = list(candidates(text))
        if not found:
            return text
        x = np.array([language.features(value, before, after, path) for _, value, before, after, _ in found])
        secret = forests[turn % len(forests)].score(x) >= threshold
        parts, end = [], 0
        for a, b in sorted((c[0], c[0] + len(c[1])) for c, ok in zip(found, secret.tolist(), strict=True) if ok):
            if a >= end:
                parts += [text[end:a], mark]
            end = max(end, b)
        return "".join([*parts, text[end:]])

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array, paths: pa.Array, turns: pa.Array) -> pa.Array:
        out: list[str | None] = [None] * len(texts)
        for lo, _, buf, offsets in text_blocks(texts):
            for i in _rows_with_candidates(buf, offsets).tolist():
                text = buf[offsets[i] : offsets[i + 1]].tobytes().decode()
                new = clean(text, paths[lo + i].as_py() or "", turns[lo + i].as_py())
                if new != text:
                    out[lo + i] = new
        return pa.array(out, pa.string())

    given = F.col(path_col).cast("string") if path_col else F.lit("")
    text = F.col(text_col).cast("string")
    return docs.withColumn(text_col, F.coalesce(cleaned(text, given, half_of(F.col(id_col))), text))  # only changed texts come back


def redact(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """docs with every secret of found replaced by mark in its text; all rows and columns stay.

    found may come from anywhere; its spans belong to ids, so ids are unique here (see redact_documents).
    Spans that overlap are one. They are collected by document, so their number is bounded by its text.
    """
    key, held = fresh(docs, "_id"), fresh(docs, "_spans")
    own = found.where("is_secret").select("doc_id", "start", (F.col("start") + F.length("value")).alias("end")).distinct()
    ordered = Window.partitionBy("doc_id").orderBy("start", "end")
    own = own.withColumn("reach", F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    own = own.withColumn("span", F.sum(F.when(F.col("start") < F.col("reach"), 0).otherwise(1)).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    own = own.groupBy("doc_id", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = own.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("n"))))).toDF(key, held)
    joined = docs.join(spans, F.col(id_col) == F.col(key), "left")
    at, own = F.col(text_col), F.col(held)

    def end(i: Column) -> Column:
        """Where the span before the i-th ends; those that overlap were joined."""
        before = F.get(own, i - 1)
        return F.when(i == 0, F.lit(0).cast("long")).otherwise(before["start"] + before["n"])

    pieces = F.transform(own, lambda s, i: F.concat(F.substring(at, (end(i) + 1).cast("int"), (s["start"] - end(i)).cast("int")), F.lit(mark)))
    clean = F.concat(F.array_join(pieces, ""), F.substring(at, (end(F.size(own)) + 1).cast("int"), F.length(at)))
    return joined.withColumn(text_col, F.when(own.isNotNull(), clean).otherwise(at)).select(*docs.columns)
