"""Repeated, null and string ids; signatures against a version by loops."""

import hashlib
import re
import struct

import pytest
import xxhash
from corpus import frame, texts

from quarrymill.llm import fingerprints, mixing, near_duplicates, packing, quality_rules, secrets

MASK = (1 << 64) - 1


def h64(*parts) -> int:
    """Spark's xxhash64 of strings and longs."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p.encode() if isinstance(p, str) else struct.pack("<q", p), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def h32(x: int) -> int:
    """Spark's murmur3 hash of a long."""
    rot = lambda a, r: ((a << r) | (a >> (32 - r))) & 0xFFFFFFFF
    h = 42
    for part in (x & 0xFFFFFFFF, (x >> 32) & 0xFFFFFFFF):
        k = rot(part * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    for m, r in ((0x85EBCA6B, 16), (0xC2B2AE35, 13)):
        h = (h ^ (h >> r)) * m & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def brute_signature(text: str, buckets=fingerprints.BUCKETS, take=fingerprints.TAKE, k=fingerprints.K) -> list[int]:
    wide = re.compile(f"[{fingerprints.WIDE}]")
    words = []
    for run in re.findall(r"[^\x20\x09-\x0D]+", text):
        for piece in re.split(f"([{fingerprints.WIDE}])", run):
            if len(piece) > 24 and not wide.match(piece):
                words += [*piece[:-24], piece[-24:]]  # characters up to the last whole piece
            elif piece:
                words.append(piece)
    grams = [h64(*words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) > k else ([h64(" ".join(words))] if words else [])
    low, bits = fingerprints._BITS, buckets.bit_length() - 1
    cut = lambda h: h >> low << low
    seen, elements = {}, []
    for at, g in enumerate(map(cut, grams)):
        turn = seen[g] = seen.get(g, -1) + 1
        elements.append((g, at, turn))
    # the first copy keeps its hash, later ones hash it with their number
    packed = sorted((g if not t else cut(xx_copy(g >> low, t))) | at for g, at, t in elements)
    out = []
    for b in range(buckets):
        own = [x for x in packed if (x & MASK) >> (64 - bits) == b][:take]
        tuple_ = [x >> low for x in sorted(own, key=lambda x: x & ((1 << low) - 1))]
        out.append(h32(h64(*tuple_)) | 1 if own else 0)
    return out


def xx_copy(h: int, turn: int) -> int:
    """xxhash64 of a long and an int."""
    seed = xxhash.xxh64(struct.pack("<q", h), seed=42).intdigest()
    out = xxhash.xxh64(struct.pack("<i", turn), seed=seed).intdigest()
    return out - (1 << 64) if out >> 63 else out


def test_signatures_against_a_version_by_loops(spark):
    values = [t or "" for t in texts()] + ["日本語テキスト" * 30, "mixed 日本 words and " + "q" * 60 + " end", "same " * 50, "x" * 25, "é" * 24]
    out = fingerprints.order_minhash(spark.createDataFrame(list(enumerate(values)), "i int, text string")).collect()
    for r in out:
        assert r.signature == brute_signature(values[r.i]), values[r.i][:60]


def test_an_edit_in_a_text_without_spaces_is_local(spark):
    import random

    rng = random.Random(3)
    han = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(3000))
    latin = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))
    rows = [(f"{a}{t}",) for t in (han, latin) for a in ("", "字", "q")]
    sig = [r.signature for r in fingerprints.order_minhash(spark.createDataFrame(rows, "text string")).collect()]
    for k in (0, 3):
        for j in (1, 2):
            assert sum(a == b for a, b in zip(sig[k], sig[k + j], strict=True)) >= 28


@pytest.mark.parametrize("kind", ["long", "string"])
def test_edits_keep_every_row(spark, kind):
    make = (lambda i: i) if kind == "long" else (lambda i: None if i is None else f"k{i}")
    rows = [(make(i), t) for i, t in [(1, "a b c d"), (1, "e f g h"), (2, "one two three four five"), (2, "one two three four five"), (None, "no id here"), (3, None)]]
    out = fingerprints.compare_edits(spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in out) == sorted((str(i), len(t or "")) for i, t in rows)
    by = {(r.doc_id, r.n_chars): r for r in out}
    last = by[make(2), 23]  # of the rows with id 1 the one of the larger hash is next
    nexts = {hashlib.sha256(("one two three four five"[:-7] + t[:7]).encode()).hexdigest() for t in ("a b c d", "e f g h")}
    assert last.edited_sha256 in nexts and 0 <= last.near_next <= 1


@pytest.mark.parametrize("kind", ["long", "string"])
def test_mixing_keeps_every_row_and_the_type_of_ids(spark, kind):
    make = (lambda i: i) if kind == "long" else (lambda i: None if i is None else f"k{i}")
    rows = [(make(i), "w " * n, s) for i, n, s in [(1, 5, "a"), (1, 5, "a"), (1, 7, "a"), (None, 3, "b"), (None, 3, "b"), (2, 0, None), *((k, k % 9 + 1, "ab"[k % 2]) for k in range(10, 80))]]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, source string")
    out = mixing.mix_sources(docs, block=8).collect()
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted((str(i), len(t.split())) for i, t, _ in rows)
    assert dict(mixing.mix_sources(docs).dtypes)["doc_id"] == {"long": "bigint"}.get(kind, kind)
    again = mixing.mix_sources(docs.repartition(5), block=8).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    for s in ("a", "b"):
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 9 and all(r.taken <= 3 * r.size for r in own)


def test_repeated_and_null_ids_in_the_other_operators(spark):
    values = [f"{t} AKIA{'ABCD' * 4} token = \"{i:040x}\"" for i, t in enumerate(t for t in texts()[:20] if t)]
    ids = [None if i % 5 == 0 else i % 3 for i in range(len(values))]
    docs = frame(spark, values, ids)
    count = lambda df: sorted(str(r.doc_id) for r in df.collect())
    want = sorted(map(str, ids))
    assert count(quality_rules.repetition_rules(docs)) == want
    assert count(near_duplicates.near_duplicates(docs)) == want
    pieces = packing.pack_documents(docs, __import__("public_tokenizers").path("byte_bpe_50k.json")).where("start = 0")
    assert count(pieces) == want
    assert count(secrets.find_candidates(docs).where("kind = 'assigned'")) == want


def test_lists_hold_the_stated_odds():
    for least in (0.8, 0.85):
        n = near_duplicates.lists_for(least)
        p = [1.0, 1.0]
        for _ in range(n):  # runs without two shared neighbours
            p.append((1 - least) * p[-1] + least * (1 - least) * p[-2])
        assert p[n + 1] < 5e-7 and n < 30
