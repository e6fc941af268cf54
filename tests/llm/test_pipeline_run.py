"""The whole pipeline on rows with repeated and null ids, null texts, copies and extra columns."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from corpus import frame, texts, words
from test_duplicates import brute_components
from test_rules_and_counts import brute_rules

from quarrymill.llm import quality_rules

public_tokenizers = pytest.importorskip("public_tokenizers")


def documents(spark):
    values = [t for t in texts() if len(t or "") < 4000]
    ids: list = list(range(len(values)))
    long = [i for i, t in enumerate(values) if len(words(t)) > 60]
    ids[long[-1]] = ids[long[-2]]  # two texts with one id
    ids[long[-3]] = None
    values += [values[long[5]], "Unique words about " + " ".join(f"subject{i} matter{i * 7}" for i in range(40)) + ' token = "' + "0a1b2c3d" * 5 + '"']
    ids += [ids[long[5]], None]  # a repeated row, a secret without an id
    return frame(spark, values, ids).selectExpr("doc_id", "text", "lang", "source", "cast(n_chars as long) n_chars", "key", "_id", "copies", "n_words")


def key(r):
    return str(r["doc_id"]), r["text"] or "", r["key"], r["_id"], r["copies"], r["n_words"]


def size(rows, s):
    return sum(len(words(r["text"])) for r in rows if r["source"] == s)


def passes(t):
    n, _, _, _, repeated, covered, longest = brute_rules(t, quality_rules.MIN_REPEAT)
    return n >= 50 and 100 * repeated <= 50 * n and covered <= quality_rules.MAX_COVERED * n and longest <= quality_rules.MAX_LONGEST * n


def targets(rows):
    """Words of each source, by the rule of the contract."""
    names = sorted({r["source"] for r in rows if r["source"] is not None}) + [None] * any(r["source"] is None for r in rows)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    out, free, left = {}, set(names), float(sum(size(rows, s) for s in names))
    while free:
        level = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] > 3 * size(rows, s)}
        out |= {s: 3 * size(rows, s) for s in over} if over else level
        left -= sum(out[s] for s in over)
        free = free - over if over else set()
    return out


def test_run_against_brute_force(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}

    def watched(name, stage):
        def run(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            seen[name] = ([r.asDict() for r in docs.collect()], out.columns)
            return out

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(seen[name][1] == docs.columns for name in list(seen)[:4])
    raw, ruled, single, clean, mixed = (seen[n][0] for n in ("quality_rules", "near_duplicates", "secrets", "mixing", "packing"))

    assert sorted(map(key, ruled)) == sorted(key(r) for r in raw if passes(r["text"]))
    assert any(r["doc_id"] is None for r in ruled)

    named: dict = {}
    for r in ruled:
        if r["doc_id"] is not None:
            named[r["doc_id"]] = min(r["text"], named.get(r["doc_id"], r["text"]))
    roots = brute_components(list(named.values()), list(named), 80, 100)
    assert sorted(map(key, single)) == sorted(key(r) for r in ruled if r["doc_id"] is None or roots[r["doc_id"]][1] == r["doc_id"])

    held = lambda r: "AKIA" in r["text"] or "0a1b2c3d" in r["text"]
    assert len(clean) == len(single) and not any(map(held, clean)) and all(r["n_chars"] == len(r["text"]) for r in clean)
    assert sorted(key(r) for r in clean if "[secret]" not in r["text"]) == sorted(key(r) for r in single if not held(r))
    assert sum("[secret]" in r["text"] for r in clean) == sum(map(held, single)) > 0

    rows, counts = list(map(key, clean)), {}
    for r in mixed:
        counts[key(r)] = counts.get(key(r), 0) + 1
    assert set(counts) <= set(rows) and all(n <= 3 * rows.count(k) for k, n in counts.items())
    largest = max(len(words(r["text"])) for r in clean)
    assert all(abs(size(mixed, s) - t) <= largest for s, t in targets(clean).items())

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [[*tok.encode(r["text"], add_special_tokens=False).ids, 0] for r in mixed]
    assert sorted((str(p.doc_id), p.doc_tokens) for p in pieces if p.start == 0) == sorted((str(r["doc_id"]), len(i)) for r, i in zip(mixed, ids, strict=True))
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    digests = {(str(r["doc_id"]), a, zlib.crc32(np.array(i[a:b], "<u4").tobytes())) for r, i in zip(mixed, ids, strict=True) for p in pieces if str(p.doc_id) == str(r["doc_id"]) for a, b in [(p.start, p.start + p.length)]}
    assert all((str(p.doc_id), p.start, p.ids_crc32) in digests for p in pieces)
