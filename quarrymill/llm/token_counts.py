"""Token counts by a deterministic transducer compiled from a BPE vocabulary with byte fallback.

For such a vocabulary a split of a text into pieces is the tokenizer's own exactly when each pair
of neighbours is (merging the pair's text gives the pair back). So every prefix has one last piece,
and reading a character moves a finite state: the starts from which a longer piece may still come,
each with the last piece before it and its count relative to now. A transition carries the number
of tokens it adds to the count. States are compiled when a text first reaches them.

No piece goes from another character to a space, so the state returns to the start before each run
of spaces. A text is cut into chunks; each is a state map, from the state it is entered in to the
state it is left in and the tokens between. Maps are held for the entry states that occur: a chunk
starts with a guess, the state that its own last characters before it lead to, and reads on from
another state only until that meets a state which it has passed at the same place. Neighbouring maps
compose in the tree of a parallel prefix scan, whose root gives the count. Texts, marks and maps take
memory in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Memo, counts_by_row, number_spans, rows_of, text_blocks

CHUNK_BYTES = 1 << 16
MOST_STATES, MOST_PAIRS, MOST_SEGMENTS = 200_000, 500_000, 1_000_000
STRIDE = 256  # characters between the states that a chunk remembers
WARM = 128  # characters before a chunk from which its entry state is guessed
START = (("", None, 0),)
SPACE_MARK = "▁"


class Transducer:
    """Compiled lazily from pieces (text -> score; merges take the highest score, then the leftmost)."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.prefixes = {x: x for x in {p[:i] for p in scores for i in range(len(p))}}
        self.pairs: dict[tuple, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states, self.ids = [START], {START: 0}
        self.entries: dict[tuple, tuple] = {}  # one object for equal entries of all states
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def merge(self, text: str) -> list[str]:
        """The tokenizer's own rule, for the short texts of pairs."""
        parts = list(text)
        while len(parts) > 1:
            best, _, at = max((self.scores.get(parts[i] + parts[i + 1], -np.inf), -i, i) for i in range(len(parts) - 1))
            if best == -np.inf:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: str | None, piece: str) -> bool:
        key = (before, piece)
        if key not in self.pairs:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merge((before or "") + piece) == [x for x in key if x is not None]
        return self.pairs[key]

    def compile_move(self, state: int, c: str) -> tuple[int, int]:
        live, last = [], None
        for text, before, count in self.states[state]:
            grown = text + c
            if (grown in self.scores or len(grown) == 1) and self.fits(before, grown):
                last = (grown, count + (1 if grown in self.scores else len(grown.encode())))
            if grown in self.prefixes:
                live.append((self.prefixes[grown], before, count))
        piece, now = last
        to = tuple(self.entries.setdefault(e, e) for e in ((text, before, count - now) for text, before, count in [*live, ("", piece if piece in self.scores else None, now)]))
        if piece not in self.scores and not live:
            to = START
        move = self.moves[state][c] = (self.place(to), now)
        return move

    def place(self, state: tuple) -> int:
        """The number of a state."""
        if state not in self.ids:
            self.ids[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.ids[state]

    def run(self, text: str, state: int = 0) -> tuple[int, int]:
        """(state, tokens added) after reading text."""
        count, moves = 0, self.moves
        for c in text:
            move = moves[state].get(c) or self.compile_move(state, c)
            state = move[0]
            count += move[1]
        return state, count

    def read(self, text: str, state: tuple) -> tuple[tuple, int]:
        """(state, tokens added) after reading text from a state, which stays good when numbers are cleared."""
        if len(self.states) > MOST_STATES:
            self.clear()
        to, count = self.run(text, self.place(state))
        return self.states[to], count

    def count(self, text: str) -> int:
        """Tokens of a whole text, in slices, between which states may be cleared."""
        state, count = START, 0
        for lo in range(0, len(text), CHUNK_BYTES):
            state, n = self.read(text[lo : lo + CHUNK_BYTES], state)
            count += n
        return count


class ChunkMap:
    """From an entry state to (exit state, tokens), for the entry states asked for so far."""

    def __init__(self):
        self.known: dict[tuple, tuple[tuple, int]] = {}

    def enter(self, state: tuple) -> tuple[tuple, int]:
        if state not in self.known:
            self.known[state] = self._read(state)
        return self.known[state]


class RunMap(ChunkMap):
    """The map of a chunk without a return to the start state.

    The first reading leaves its state at every STRIDE characters; another ends where it meets one.
    """

    def __init__(self, machine: Transducer, text: str):
        super().__init__()
        self.machine, self.text, self.marks = machine, text, []

    def _read(self, state: tuple) -> tuple[tuple, int]:
        first, count = not self.marks, 0
        for i, lo in enumerate(range(0, len(self.text), STRIDE)):
            state, n = self.machine.read(self.text[lo : lo + STRIDE], state)
            count += n
            if first:
                self.marks.append((state, count))
            elif self.marks[i][0] == state:
                return self.marks[-1][0], count + self.marks[-1][1] - self.marks[i][1]
        return state, count


class ReturningMap(ChunkMap):
    """The map of a chunk that returns to the start: only the head before depends on the entry state."""

    def __init__(self, machine: Transducer, head: str, inner: int, tail: str):
        super().__init__()
        self.machine, self.head = machine, head
        self.exit, n = machine.read(tail, START)
        self.rest = inner + n

    def _read(self, state: tuple) -> tuple[tuple, int]:
        return self.exit, self.machine.read(self.head, state)[1] + self.rest


class JoinedMap(ChunkMap):
    """Two neighbouring maps, one after the other."""

    def __init__(self, left: ChunkMap, right: ChunkMap):
        super().__init__()
        self.left, self.right = left, right

    def _read(self, state: tuple) -> tuple[tuple, int]:
        middle, n = self.left.enter(state)
        out, m = self.right.enter(middle)
        return out, n + m


def compose(maps: Sequence[ChunkMap]) -> ChunkMap:
    """All maps as one: the tree of a prefix scan, in which the joins of a level are independent."""
    maps = list(maps)
    while len(maps) > 1:
        maps = [JoinedMap(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


class Counter:
    """Tokens of whole texts; one for each Python worker and vocabulary."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        skip = (sp.is_control, sp.is_unknown, sp.is_byte, sp.is_unused)
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not any(f(i) for f in skip)}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in scores):
            raise ValueError("a piece of this vocabulary goes across a word border")
        if sp.encode("a  b") != sp.encode(SPACE_MARK * 0 + "a" + SPACE_MARK * 2 + "b"):
            raise ValueError("this vocabulary folds white space")
        self.machine = Transducer(scores)
        self.cache = Memo(MOST_SEGMENTS)

    def counted(self, segment: str) -> int:
        return self.machine.count(segment.replace(" ", SPACE_MARK))

    def block(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token counts of the rows of a block; each row's text begins with the added space."""
        n = len(buf)
        lengths = np.diff(offsets)
        long = np.flatnonzero(lengths > CHUNK_BYTES)
        cuts = [np.arange(offsets[i] + CHUNK_BYTES, offsets[i + 1], CHUNK_BYTES) for i in long]
        edges = np.unique(np.concatenate([offsets, *[self._to_borders(buf, c) for c in cuts]])) if cuts else offsets
        space = buf == 0x20
        first = np.zeros(n, bool)
        first[1:] = space[1:] & ~space[:-1]
        first[edges[edges < n]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        rows = rows_of(offsets, starts)
        split = np.isin(rows, long)
        plain = np.flatnonzero(~split)
        out = self._plain(buf, starts[plain], ends[plain], rows[plain], len(lengths))
        for i in long:
            out[i] = self._composed(buf, edges[(edges >= offsets[i]) & (edges <= offsets[i + 1])])
        return out

    @staticmethod
    def _to_borders(buf: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Cuts moved forward to the first byte of a character."""
        cuts = cuts.copy()
        for _ in range(3):
            inside = (cuts < len(buf)) & ((buf[np.minimum(cuts, len(buf) - 1)] & 0xC0) == 0x80)
            cuts += inside
        return cuts[cuts < len(buf)]

    def _plain(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """Texts of one chunk: every segment is entered in the start state."""
        back, at = number_spans(buf, starts, ends)
        data = buf.tobytes()

        def fill(miss: np.ndarray) -> list[int]:
            lo, hi = starts[at[miss]], ends[at[miss]]
            return [self.counted(data[a:b].decode()) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]

        counts = self.cache.get(buf, starts[at], ends[at], fill)
        return counts_by_row(rows, n_rows, counts[back])

    def chunk_map(self, buf: np.ndarray, lo: int, hi: int, warm: str = "") -> ChunkMap:
        """The map of a chunk; warm: what stands before it."""
        space = buf[lo:hi] == 0x20
        back = np.flatnonzero(space[1:] & ~space[:-1]) + lo + 1  # returns to the start state
        marked = lambda a, b: buf[a:b].tobytes().decode().replace(" ", SPACE_MARK)
        if len(back) == 0:
            out: ChunkMap = RunMap(self.machine, marked(lo, hi))
        else:
            inner = int(self._plain(buf[back[0] : back[-1]], back[:-1] - back[0], back[1:] - back[0], np.zeros(len(back) - 1, np.int64), 1)[0]) if len(back) > 1 else 0
            out = ReturningMap(self.machine, marked(lo, back[0]), inner, marked(back[-1], hi))
        out.enter(self.machine.read(warm.replace(" ", SPACE_MARK), START)[0])
        return out

    def _composed(self, buf: np.ndarray, edges: np.ndarray) -> int:
        """A long text: the map of each chunk, then their composition."""
        maps = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            warm = buf[max(int(edges[0]), lo - 4 * WARM) : lo].tobytes().decode(errors="ignore")
            maps.append(self.chunk_map(buf, lo, hi, warm[-WARM:]))
        return compose(maps).enter(START)[1]


_counters: dict[str, Counter] = {}


def count_column(col: pa.Array, model: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of each text; null and empty texts have none."""
    counter = _counters.get(model) or _counters.setdefault(model, Counter(model))
    n_bytes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    spaced = pc.replace_substring(pc.fill_null(col, ""), SPACE_MARK, " ")
    spaced = pc.binary_join_element_wise(pa.scalar(""), spaced, pa.scalar(" "))
    counts = np.zeros(len(col), np.int64)
    for lo, hi, buf, offsets in text_blocks(spaced):
        counts[lo:hi] = counter.block(buf, offsets)
    return n_bytes, np.where(n_bytes > 0, counts, 0)


def count_tokens(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, as the vocabulary's own library counts.

    model is the path of a BPE model with byte fallback, readable on every executor. Null texts
    count as empty; white space counts. Rows keep their number, repeated ids included; other columns
    are not read. One pass without a shuffle; a task holds one Arrow batch and caches of fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_bytes, counts = count_column(b.column(1), model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes), pa.array(counts), pa.array(counts > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
