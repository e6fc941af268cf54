"""Packing token sequences into windows by the sum-of-squares rule.

Each task packs its own partition online. Whole windows are cut from the front of a document; its
rest goes to the fill level for which the sum of squared counts of partially filled windows, held
in an array by level, becomes least. Windows that are still open at the end of a partition (or when
there are too many of them) are joined and cut into full windows and powers of two, which need no
padding.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Memo, number_spans, rows_of, text_blocks

WINDOW = 1024
MOST_OPEN = 4096
MOST_WORDS = 600_000
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

OTHER, LETTER, NUMBER, BLANK = range(4)
#: The white space of Unicode (property White_Space), as first and last code points.
WHITE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
#: Endings that the tokenizer's pattern takes with the apostrophe before them.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _classes() -> np.ndarray:
    """Class of each code point."""
    kinds = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for a, b in WHITE:
        kinds[a : b + 1] = BLANK
    return kinds


def word_starts(cp: np.ndarray, edge: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the tokenizer's pattern begins a new match; cp: code points, edge: is it a text's first?

    A match is a run of letters, of numbers or of other signs, with the one space before it; white
    space before a run leaves its last character to a match of its own; an apostrophe that begins a
    run of other signs takes the ending after it.
    """
    k = kinds[cp]
    new = edge.copy()
    new[1:] |= k[1:] != k[:-1]
    after = np.flatnonzero(new & (k != BLANK) & ~edge)
    after = after[k[after - 1] == BLANK]
    new[after - 1] = True
    new[after[cp[after - 1] == 0x20]] = False
    mark = np.flatnonzero((cp == ord("'")) & new)
    for ending in ENDINGS:
        n, at = len(ending), mark
        for j, c in enumerate(ending, 1):
            at = at[at + j < len(cp)]
            at = at[(cp[at + j] == ord(c)) & ~edge[at + j]]
        new[at + 1] = False
        at = at[at + 1 + n < len(cp)]
        new[at[(k[at + 1 + n] == LETTER) & ~edge[at + 1 + n]] + 1 + n] = True
    return new


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand for
    themselves, the others for the characters from 256 on."""
    plain = [b for a, z in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(a, z + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _merges_are_ids(model: str, tokenizer) -> bool:
    """Does merging by the least id of a joined pair give what the listed merges give?

    It does where every token of several characters has one listed merge, ids follow the list, and
    each token by itself is merged to itself. Then two neighbours that join to a token t are what
    the merges before t's make of t's text, for no earlier merge crossed its borders; by itself
    that text is then the pair of t's one merge, so the neighbours are that pair.
    """
    with open(model, encoding="utf-8") as f:
        held = json.load(f)["model"]
    if held.get("type") != "BPE" or any(held.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return False
    vocab, merges = held["vocab"], [m.split(" ") if isinstance(m, str) else m for m in held["merges"]]
    made = [a + b for a, b in merges]
    ids = [vocab.get(t, -1) for t in made]
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    if min(ids, default=0) < 0 or any(x >= y for x, y in zip(ids, ids[1:], strict=False)) or {t for t in vocab if len(t) > 1} - added != set(made):
        return False
    return all([x.id for x in tokenizer.model.tokenize(t)] == [i] for t, i in zip(made, ids, strict=True))


def _fast_merges(model: str, tokenizer) -> Callable[[list[str]], list[list[int]]] | None:
    """The same merges in a faster library, where that is there and the vocabulary proves them the same."""
    try:
        import tiktoken
    except ImportError:
        return None
    byte_of = _byte_of()
    special = {x.content for x in tokenizer.get_added_tokens_decoder().values()}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if t not in special and all(c in byte_of for c in t)}
    if any(bytes([b]) not in ranks for b in range(256)) or not _merges_are_ids(model, tokenizer):
        return None
    merged = tiktoken.Encoding("merges", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return lambda pieces: [merged.encode_ordinary(p) for p in pieces]


class Encoder:
    """Token ids of whole texts; one for each Python worker and vocabulary file."""

    def __init__(self, model: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model)
        added = self.tokenizer.get_added_tokens_decoder()
        if added_tokens and any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take blanks or stand for whole words only are not supported")
        self.added = {t.content.encode(): i for i, t in added.items() if t.content and added_tokens}
        self.pattern = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.tokenizer.encode_special_tokens = True  # those that count are cut out before, by block()
        self.kinds = _classes()
        self.fast = _fast_merges(model, self.tokenizer)
        self._clear()

    def _clear(self) -> None:
        self.cache = Memo(1 << 62)
        self.store, self.used = np.zeros(1 << 20, np.int32), 0

    def _fill(self, pieces: list[str]) -> list[int]:
        """Encode words that were not seen before; returns place and length of their ids."""
        out = []
        for ids in self._encode(pieces):
            n = len(ids)
            if self.used + n > len(self.store):
                self.store = np.concatenate([self.store, np.zeros(max(n, len(self.store)), np.int32)])
            self.store[self.used : self.used + n] = ids
            out.append(self.used << 32 | n)
            self.used += n
        return out

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        if self.fast:
            return self.fast(pieces)
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def block(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, tokens of each row). With added_tokens, these are cut out first and have their own ids."""
        spans = self._added_spans(buf.tobytes(), offsets)
        if not spans:
            return self._words(buf, offsets)
        starts, ends, own = (np.array(x, np.int64) for x in zip(*spans, strict=True))
        bounds = np.unique(np.concatenate([offsets, starts, ends]))
        special = np.isin(bounds[:-1], starts)
        size = np.diff(bounds)
        ids, counts = self._words(buf[np.repeat(~special, size)], np.concatenate([[0], np.cumsum(np.where(special, 0, size))]))
        ids = np.insert(ids, np.cumsum(counts)[special], own.astype(np.int32))
        return ids, np.bincount(rows_of(offsets, bounds[:-1]), counts + special, len(offsets) - 1).astype(np.int64)

    def _added_spans(self, data: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the added tokens, leftmost and longest first, none across the border of a row."""
        out, m = [], self.pattern and self.pattern.search(data)
        while m:
            a, b = m.span()
            first, last = rows_of(offsets, np.array([a, b - 1]))
            if first == last:
                out.append((a, b, self.added[m.group()]))
            m = self.pattern.search(data, b if first == last else a + 1)
        return out

    def _words(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same without regard to added tokens, by words."""
        n_rows = len(offsets) - 1
        if len(buf) == 0:
            return np.zeros(0, np.int32), np.zeros(n_rows, np.int64)
        if len(self.cache.keys) > MOST_WORDS:
            self._clear()
        data = buf.tobytes()
        cp = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((buf & 0xC0) != 0x80)  # the byte where each character starts
        edge = np.zeros(len(cp) + 1, bool)
        edge[np.searchsorted(at, offsets)] = True
        starts = at[word_starts(cp, edge[:-1], self.kinds)]
        ends = np.append(starts[1:], len(buf))
        back, first = number_spans(buf, starts, ends)

        def fill(miss: np.ndarray) -> list[int]:
            return self._fill([data[a:b].decode() for a, b in zip(starts[first[miss]].tolist(), ends[first[miss]].tolist(), strict=True)])

        place = self.cache.get(buf, starts[first], ends[first], fill)[back]
        lengths = place & 0xFFFFFFFF
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.store[np.repeat((place >> 32) - total[:-1], lengths) + np.arange(total[-1])]
        return ids, np.bincount(rows_of(offsets, starts), lengths, n_rows).astype(np.int64)


class SumOfSquares:
    """Online packing of one partition; pieces come out when their window is closed."""

    def __init__(self, window: int = WINDOW, first_sequence: int = 0, most_open: int = MOST_OPEN):
        self.window, self.sequence, self.most_open = window, first_sequence, most_open
        self.counts = np.zeros(window + 1, np.int64)  # open windows by fill level
        self.open: list[list[list[tuple]]] = [[] for _ in range(window + 1)]
        self.n_open = 0
        self.pieces: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        """A document's ids, its closing id included."""
        n = len(ids)
        for start in range(0, n - self.window + 1, self.window):
            self._close([(doc, start, ids[start : start + self.window], n)])
        rest = n % self.window
        if rest:
            self._place((doc, n - rest, ids[n - rest :], n), rest)
        if self.n_open > self.most_open:
            self.finish()

    def level_for(self, size: int) -> int:
        """The level (0: a new window) that makes the sum of squares least; of equal ones, the fullest."""
        c = self.counts[: self.window - size + 1]
        change = 2 * self.counts[size : self.window + 1] - 2 * c + 2
        change[-1] -= 2 * self.counts[self.window] + 1  # a window that is filled counts no more
        change[0] += 2 * c[0] - 1
        usable = c > 0
        usable[0] = True
        levels = np.flatnonzero(usable)
        return int(levels[::-1][np.argmin(change[levels][::-1])])

    def _place(self, piece: tuple, size: int) -> None:
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
        else:
            self.open[level + size].append(pieces)
            self.counts[level + size] += 1
            self.n_open += 1

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.pieces.append((doc, start, len(ids), crc32(np.ascontiguousarray(ids, "<u4").tobytes()), n, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> None:
        """Close all open windows: join what they hold, cut it into full windows and powers of two."""
        held = [p for level in range(self.window, 0, -1) for pieces in self.open[level] for p in pieces]
        left = sum(len(p[2]) for p in held)
        sizes = [self.window] * (left // self.window) + [1 << b for b in reversed(range(self.window.bit_length())) if (left % self.window) >> b & 1]
        held.reverse()
        for size in sizes:
            own: list[tuple] = []
            while size:
                doc, start, ids, n = held.pop()
                own.append((doc, start, ids[:size], n))
                if len(ids) > size:
                    held.append((doc, start + size, ids[size:], n))
                size -= len(own[-1][2])
            self._close(own)
        self.counts[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.n_open = 0

    def take(self) -> list[tuple]:
        out, self.pieces = self.pieces, []
        return out


_encoders: dict[tuple[str, bool], Encoder] = {}


def pack_documents(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 0, added_tokens: bool = False, most_open: int = MOST_OPEN) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and end_id; null texts are empty. Rows are documents, so repeated
    rows and ids are packed each on their own. Partitions are packed as they are read, without a
    shuffle; a sequence never spans two of them, and a partition that is read again gives the same
    pieces. An empty table gives no pieces. Other columns are not read. added_tokens: strings of the
    vocabulary's added tokens, such as <|endoftext|>, have their own ids, as the library gives by
    default; without it they are text like any other. most_open bounds a task's memory: beyond so
    many open windows all of them are joined and cut, as at the end of a partition; every id is
    packed either way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(window, TaskContext.get().partitionId() << 40, most_open)
        encoder = _encoders.get((model, added_tokens)) or _encoders.setdefault((model, added_tokens), Encoder(model, added_tokens))

        def batch(kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*packer.take(), strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [kind] + [pa.int64()] * 6, strict=True)], names=["doc_id", *(x.split()[0] for x in PIECES.split(", "))])

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            keys = b.column(0).to_pylist()
            for lo, _, buf, offsets in text_blocks(b.column(1)):
                ids, counts = encoder.block(buf, offsets)
                ends = np.cumsum(counts)
                for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
                    packer.add(keys[lo + i], np.append(ids[end - n : end], np.int32(end_id)))
            yield batch(kind)
        if kind is not None:
            packer.finish()
            yield batch(kind)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"doc_id {kind}, {PIECES}")
