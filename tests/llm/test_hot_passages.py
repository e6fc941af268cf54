import random

import numpy as np
from test_duplicates import brute_removal

from quarrymill.llm import suffix_dedup


def letters(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


def rows_of(out):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())


def test_a_passage_of_most_texts_is_removed_from_all_but_one(spark, monkeypatch):
    rng = random.Random(2)
    passage = letters(rng, 300)
    values = [letters(rng, 150) + passage + letters(rng, 150) for _ in range(300)]
    values += [values[7][100:480], values[9][300:]]  # these repeat across the border
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(2)
    want = [(i, *x) for i, x in sorted(brute_removal(values, range(len(values))).items())]
    assert rows_of(suffix_dedup.remove_repeats(docs)) == want

    # the same with hot anchors, whose windows are rows of their own
    held, real = [], suffix_dedup._segments
    monkeypatch.setattr(suffix_dedup, "_segments", lambda *a: held.append(real(*a)) or held[0])
    assert rows_of(suffix_dedup.remove_repeats(docs, hot_from=64)) == want
    assert held[0].where("n = 0 and bytes is not null").count() > 300
    assert held[0].where("n > 0 and bytes is not null").groupBy("key").count().agg({"count": "max"}).first()[0] < 64


def test_hot_windows_with_one_hash_are_told_apart():
    key = np.array([1, 1, 1, 1, 2], np.uint64)
    window = np.zeros((5, 50), np.uint8)
    window[2:4] = 7
    state = {}
    assert suffix_dedup._gone_of_hot(key[:3], np.array([3, 4, 5]), window[:3], state).tolist() == [False, True, False]
    assert suffix_dedup._gone_of_hot(key[3:], np.array([6, 7]), window[3:], state).tolist() == [True, False]


def test_repeated_and_missing_ids_keep_their_rows(spark):
    rng = random.Random(4)
    a, b, c = (letters(rng, 200) for _ in range(3))
    rows = [(1, a), (1, b + a[:90]), (2, a + b), (2, a + b), (3, c + a[50:120]), (None, a), (0, c[100:]), (5, None), (3, "")]
    out = rows_of(suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("doc_id is not null"))
    seen, want = [(i, t or "") for i, t in rows if i is not None], []
    for i, t in seen:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if any(j < i and t[k : k + 50] in u for j, u in seen):
                gone[k : k + 50] = True
        want.append((i, len(t), int(gone.sum())))
    assert sorted(x[:3] for x in out) == sorted(want)
    nameless = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id is null").collect()
    assert [(r.n_bytes, r.n_removed) for r in nameless] == [(200, 0)]


def test_a_line_repeated_in_one_text_is_one_segment(spark, monkeypatch):
    rng = random.Random(8)
    line = letters(rng, 23)
    values = [letters(rng, 80) + line * 60 + letters(rng, 80), line * 40, letters(rng, 60) + line * 50, line * 3 + letters(rng, 90) + line * 3]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(4, "doc_id")
    want = [(i, *x) for i, x in sorted(brute_removal(values, range(len(values))).items())]
    held, real = [], suffix_dedup._segments
    monkeypatch.setattr(suffix_dedup, "_segments", lambda *a: held.append(real(*a)) or held[-1])
    for hot_from in (1, 1 << 16):
        assert rows_of(suffix_dedup.remove_repeats(docs, hot_from=hot_from)) == want
        meeting = held[-1].where("bytes is not null").groupBy("key", "bytes", "doc").count()
        assert meeting.agg({"count": "max"}).first()[0] == 1


def test_texts_beyond_a_shard_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "UNIT_BYTES", 1 << 22)
    rng = np.random.default_rng(6)
    big = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 5_000_000))
    values = [big[2_097_100:2_097_200], big, big[4_000_000:4_000_300] + "x" * 60]
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")).collect()}
    assert [(out[i].n_bytes, out[i].n_removed, out[i].n_spans) for i in range(3)] == [(100, 0, 0), (5_000_000, 100, 1), (360, 300, 1)]


def test_packed_ids_come_back():
    rng = np.random.default_rng(8)
    for buckets in (1, 3, 102):
        ids = np.sort(rng.integers(0, 1 << 48, 500).astype(np.uint64))
        codes = rng.integers(0, 1 << 32, 500).astype(np.uint32)
        own = suffix_dedup.bucket_of(ids, buckets)
        for b in np.unique(own).tolist():
            got = suffix_dedup.unpack_ids(suffix_dedup.pack_ids(ids[own == b], codes[own == b], b, buckets), b, buckets)
            assert np.array_equal(got[0], ids[own == b]) and np.array_equal(got[1], codes[own == b])
