from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus import frame, texts, words

from quarrymill.llm import near_duplicates, packing, quality_rules, suffixes, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_token_counts_are_the_librarys(spark):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    values = [*texts(), "  lead", "<s> </s> <unk> ▁▁x", " " * 70_000 + "b" * 70_000 + " c" * 5_000, "日本語テキスト" * 12_000]
    got = {r.doc_id: r for r in token_counts.count_tokens(frame(spark, values), model).collect()}
    for i, t in enumerate(values):
        assert (got[i].n_bytes, got[i].n_tokens) == (len((t or "").encode()), len(sp.encode(t or ""))), repr(t)[:60]
        assert got[i].over_limit == (got[i].n_tokens > 4096)


def test_chunk_maps_compose_in_any_grouping():
    counter = token_counts.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    for text in (" the quick brown  foxes\njumped over" * 3, "thequickbrownfoxesjumpedover日本語テ" * 9):
        data = np.frombuffer(text.encode(), np.uint8)
        for size in (1, 3, 7, 40):
            cuts = np.append(np.unique(counter._to_borders(data, np.arange(0, len(data), size))), len(data)).tolist()
            for warm in ("", "x", text[:20]):  # a wrong guess of the entry state costs time only
                maps = [counter.chunk_map(data, a, b, warm) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                assert token_counts.compose(maps).enter(token_counts.START)[1] == counter.counted(text)
                left = maps[0]
                for m in maps[1:]:
                    left = token_counts.JoinedMap(left, m)
                assert left.enter(token_counts.START) == token_counts.compose(maps).enter(token_counts.START)


def test_memory_of_a_long_run_is_linear(monkeypatch):
    import tracemalloc

    import sentencepiece

    monkeypatch.setattr(token_counts, "MOST_STATES", 2_000)  # states are cleared on the way
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 4096)
    model = public_tokenizers.path("piece_bpe_32k.model")
    rng, sp = np.random.default_rng(4), sentencepiece.SentencePieceProcessor(model_file=model)
    peak = []
    for n in (40_000, 160_000):
        text = "".join(rng.choice(list("abcdefghijklmnopqrst中文é"), n))
        counter = token_counts.Counter(model)
        data = np.frombuffer(f" {text}".encode(), np.uint8)
        tracemalloc.start()
        assert counter.block(data, np.array([0, len(data)])).tolist() == [len(sp.encode(text))]
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peak[1] < 5 * peak[0]


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def test_strings_on_which_polynomial_hashes_meet(spark):
    """Thue-Morse words and their complements have equal polynomial hashes modulo 2**64 for any root."""
    import sentencepiece
    from tokenizers import Tokenizer

    values = [thue_morse(n, *ab) for n in (1024, 2048) for ab in ("aq", "qa", "中x", "x中")]
    sp = sentencepiece.SentencePieceProcessor(model_file=(model := public_tokenizers.path("piece_bpe_32k.model")))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, values).coalesce(1), model).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(values)}

    bpe = public_tokenizers.path("byte_bpe_50k.json")
    tok, data = Tokenizer.from_file(bpe), [v.encode() for v in values]
    ids, counts = packing.Encoder(bpe).block(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    want = [tok.encode(v, add_special_tokens=False).ids for v in values]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]

    a, b = values[:2]
    lines = [f"{a}\n{b}\n{a} {b}", f"{a} {b} {a} {b} {b} {a}", f"{a}\n{a}"]
    for r in quality_rules.repetition_rules(frame(spark, lines)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_covered, r.longest_repeat) == brute_rules(lines[r.doc_id], quality_rules.MIN_REPEAT)

    near = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(frame(spark, values)).collect()}
    assert near == {i: i for i in range(len(values))}


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    from quarrymill.llm import arrays

    monkeypatch.setattr(arrays, "span_hash", lambda buf, starts, ends: np.zeros(len(starts), np.uint64))
    data = b"one two one three two" + b"x" * 70 + b"y" * 70 + b"x" * 70
    buf, starts, ends = np.frombuffer(data, np.uint8), np.array([0, 4, 8, 12, 18, 21, 91, 161]), np.array([3, 7, 11, 17, 21, 91, 161, 231])
    number, first = arrays.number_spans(buf, starts, ends)
    words_ = [data[a:b] for a, b in zip(starts, ends, strict=True)]
    assert all((number[i] == number[j]) == (words_[i] == words_[j]) for i in range(8) for j in range(8)) and len(first) == 5
    memo = arrays.Memo(100)
    for _ in range(2):
        at = np.array([0, 1, 3])
        assert memo.get(buf, starts[at], ends[at], lambda miss: [len(words_[at[i]]) * 10 + words_[at[i]][1] for i in miss]).tolist() == [30 + ord("n"), 30 + ord("w"), 50 + ord("h")]


def test_packing_is_a_partition_of_every_documents_ids(spark):
    from tokenizers import Tokenizer

    model = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(model)
    tok.encode_special_tokens = True
    values = texts() + ["it's we'll 'softly  \n x", "<|endoftext|> a"]
    pieces = packing.pack_documents(frame(spark, values), model).collect()
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(values)}
    from zlib import crc32

    by_doc, by_seq = {}, {}
    for p in pieces:
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert len(own) == p.length and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == crc32(np.array(own, "<u4").tobytes())
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, want in ids.items():
        at = 0
        for start, length in sorted(by_doc[i]):
            assert start == at
            at += length
        assert at == len(want)
    padding = 0
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_sum_of_squares_takes_the_least_level():
    rng = np.random.default_rng(5)
    packer = packing.SumOfSquares(64)
    for doc in range(400):
        size = int(rng.integers(1, 64))

        def cost(level, size=size):
            c = packer.counts[:64].copy()
            c[level] -= level > 0
            if level + size < 64:
                c[level + size] += 1
            return int((c**2).sum())

        usable = [0, *[h for h in range(1, 65 - size) if packer.counts[h]]]
        assert cost(packer.level_for(size)) == min(map(cost, usable))
        packer.add(doc, np.arange(size, dtype=np.int32))


def brute_rules(t, least):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    g, n = Counter(zip(w, w[1:], w[2:], strict=False)), len(w)
    repeated = {i + j for i in range(n - 2) if g[w[i], w[i + 1], w[i + 2]] > 1 for j in range(3)}
    covered, longest = set(), 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and w[i + k] == w[j + k]:
                k += 1
            if k >= least:
                covered |= {*range(i, i + k), *range(j, j + k)}
                longest = max(longest, k)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(repeated), len(covered), longest


def test_rules_against_brute_force(spark):
    values = [t for t in texts() if len(t or "") < 3000]
    out = {r.doc_id: r for r in quality_rules.repetition_rules(frame(spark, values)).collect()}
    for i, t in enumerate(values):
        r, want = out[i], brute_rules(t, quality_rules.MIN_REPEAT)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_covered, r.longest_repeat) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and want[5] <= quality_rules.MAX_COVERED * want[0] and want[6] <= quality_rules.MAX_LONGEST * want[0])


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(30):
        parts = [rng.integers(1, 4, rng.integers(1, 40)).astype(np.uint64) for _ in range(4)]
        symbols, ends = np.concatenate(parts), np.repeat(np.cumsum([len(p) for p in parts]), [len(p) for p in parts])
        sa, ranks, _ = suffixes.refine(symbols, ends)
        suffix = [(*symbols[i : ends[i]].tolist(), ends[i] / 1e6) for i in range(len(symbols))]
        assert sa.tolist() == sorted(range(len(symbols)), key=suffix.__getitem__)
        lcp = suffixes.kasai(symbols, sa, ranks, ends, 1000, lane=7)
        for p in range(1, len(sa)):
            a, b = suffix[sa[p]][:-1], suffix[sa[p - 1]][:-1]
            assert lcp[p] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_text_bytes_reads_slices():
    from quarrymill.llm.arrays import text_bytes

    col = pa.array(["ab", None, "é", "zz"]).slice(1, 3)
    buf, at = text_bytes(col)
    assert buf.tobytes().decode() == "ézz" and at.tolist() == [0, 0, 2, 4]
