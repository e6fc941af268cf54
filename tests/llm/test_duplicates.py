import hashlib

import numpy as np
import pytest
from corpus import frame, texts, words

from quarrymill.llm import fingerprints, near_duplicates, suffix_dedup
from quarrymill.operators.graph import connected_components as components


def shingle_set(t):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(values, ids, a, b):
    sets = {i: shingle_set(t) for i, t in zip(ids, values, strict=True)}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and b * len(sets[i] & sets[j]) >= a * len(sets[i] | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("share", [(85, 100), (80, 100)])
def test_near_duplicates_against_brute_force(spark, share):
    rng = np.random.default_rng(0)
    values = texts()
    base = " ".join(f"w{i}" for i in range(120)).split()
    for _ in range(40):  # a cluster whose members differ by different amounts
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            w[at] = f"z{rng.integers(0, 9)}"
        values.append(" ".join(w))
    ids = [int(x) for x in rng.permutation(len(values)) * 7]
    out = near_duplicates.near_duplicates(frame(spark, values, ids), share=share).collect()
    want = brute_components(values, ids, *share)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    values = ["a b c d e f", "a b c d e f", None, "other words are here now"]
    out = near_duplicates.near_duplicates(frame(spark, values, [4, None, None, 4])).collect()
    assert len(out) == 4
    assert {(r.doc_id, r.component_id, r.kept) for r in out} == {(4, 4, True), (None, None, True)}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, j) for j in range(101, 130)] + [(200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {j: 100 for j in range(100, 130)}


def brute_removal(values, ids, width=50):
    data = {i: (t or "").encode() for i, t in zip(ids, values, strict=True)}
    first = {}
    for i in sorted(data):
        for k in range(len(data[i]) - width + 1):
            first.setdefault(data[i][k : k + width], i)
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def test_removal_against_brute_force(spark):
    values = texts() + ["é" * 60, "é" * 60 + "x", "ab" * 100, "ba" * 90, "z" * 49, "z" * 50]
    rng = np.random.default_rng(2)
    ids = [int(x) for x in rng.permutation(len(values))]
    out = suffix_dedup.remove_repeats(frame(spark, values, ids)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute_removal(values, ids)


def test_sorted_runs_merge_by_search():
    rng = np.random.default_rng(3)
    runs, want = [], {}
    for k in range(5):
        keys = np.unique(rng.integers(0, 50, 20)).astype(np.uint64)
        docs = rng.integers(0, 9, len(keys))
        runs.append((keys, docs, np.full(len(keys), k)))
        for a, b in zip(keys.tolist(), docs.tolist(), strict=True):
            want[a] = min(want.get(a, 99), b)
    key, doc, _ = suffix_dedup.merge_sorted(runs)
    assert dict(zip(key.tolist(), doc.tolist(), strict=True)) == want and (np.diff(key.astype(np.int64)) > 0).all()


def test_edits_and_fingerprints(spark):
    values = texts()
    out = {r.doc_id: r for r in fingerprints.compare_edits(frame(spark, values)).collect()}
    ids = sorted(out, reverse=True)
    assert ids == sorted(range(len(values)), reverse=True)
    for k, i in enumerate(ids):
        own, after = values[i] or "", values[ids[(k + 1) % len(ids)]] or ""
        cut = len(own) // 3
        edited = own[: len(own) - cut] + after[:cut]
        assert out[i].n_chars == len(own)
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
        if edited == own:
            assert out[i].near_edited == 1
    by_text = {}
    for i, t in enumerate(values):
        by_text.setdefault(t or "", set()).add(out[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_follow_order_and_edits(spark):
    base = [f"w{i}" for i in range(300)]
    one = base[:150] + ["new"] + base[151:]
    moved = base[150:] + base[:150]
    rows = spark.createDataFrame([(" ".join(x),) for x in (base, one, moved, list(reversed(base)))], "text string")
    sig = [r.signature for r in fingerprints.order_minhash(rows).collect()]
    like = [np.mean([a == b for a, b in zip(sig[0], s, strict=True)]) for s in sig]
    assert like[0] == 1 and like[1] > 0.8 and like[1] > like[2] > like[3]
