import numpy as np
from corpus import frame, texts, words

from quarrymill.llm import language_id, mixing, quality_model, secrets


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(1)
    values = [" ".join(["w"] * int(n)) for n in rng.integers(1, 40, 600)] + ["", None]
    docs = frame(spark, values)
    out = mixing.mix_sources(docs, block=16).collect()
    again = mixing.mix_sources(docs.repartition(7), block=16).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    size = {i: len(words(t)) for i, t in enumerate(values)}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    own = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(own.values()))
    while True:  # the excess is shared again until nothing is above
        level = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if level[s] > 3 * own[s]}
        if not over:
            target |= level
            break
        for s in over:
            target[s] = 3 * own[s]
            left -= target[s]
        free -= over
    for r in out:
        assert r.size == size[r.doc_id] and r.source_size == own[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken == r.copies * r.size <= 3 * r.size
    for s in names:
        assert abs(sum(r.taken for r in out if r.source == s) - target[s]) <= max(size.values())


def test_pivotal_rounding_keeps_expectations(spark):
    rows = [(i, "g", 10.0, 4.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g string, cap double, mass double")
    counts = np.zeros(40)
    for seed in range(8):
        full = {r.id: r.full for r in mixing.pivotal_round(df, "g", "cap", "mass", block=8, seed=seed).collect()}
        assert len(full) == 40 and sum(full.values()) == 16
        counts += [full[i] for i in range(40)]
    assert 0 < counts.mean() / 8 < 1 and counts.std() < 8 * 0.35


def test_factorisation_machine_identity_and_learning(spark):
    m = quality_model.FactorisationMachine(0)
    rng = np.random.default_rng(0)
    m.v = rng.normal(0, 1, m.v.shape)
    idx, val = np.array([3, 7, 9]), np.array([0.5, -1.0, 2.0])
    z, _ = m.raw(np.zeros(3, int), idx, val, 1)
    pairs = sum(m.v[idx[a]] @ m.v[idx[b]] * val[a] * val[b] for a in range(3) for b in range(a + 1, 3))
    assert np.isclose(z[0], pairs)

    values = [f"{'good clear text' if i % 2 else 'spam###$$ BUY NOW!!'} {i} " * 6 for i in range(200)] + [None, ""]
    docs = frame(spark, values)
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(3, None)], "doc_id long, quality int")
    machine = quality_model.train(docs, labels, meta_cols=["n_chars"])
    out = {r.doc_id: r.score for r in quality_model.score_quality(docs, machine, meta_cols=["n_chars"]).collect()}
    assert len(out) == len(values) and all(0 <= s <= 1 for s in out.values())
    assert np.mean([(out[i] >= 0.5) == bool(i % 2) for i in range(150, 200)]) > 0.95
    none = quality_model.train(docs, labels.limit(0))
    assert none.w0 == 0 and not none.w.any()
    scores = [r.score for r in quality_model.score_quality(docs, none).collect()]
    assert len(scores) == len(values) and all(abs(s - 0.5) < 0.05 for s in scores)


def test_quality_query_holds_rows_out(spark, tmp_path):
    import zlib

    from quarrymill.llm.queries import op1_factorisation_machine

    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    values = [f"{'good clear text' if i % 2 else 'spam###$$ BUY NOW!!'} {i} " * 6 for i in range(300)] + [None, ""]
    docs = frame(spark, [*values, values[7]], [*range(302), 7])  # a repeated row
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    label = lambda flip: [(i, (i % 2) ^ (flip and held(i))) for i in range(300) if i % 7]
    scores = []
    for name, flip in (("a", False), ("b", True)):
        spark.createDataFrame(label(flip), "doc_id long, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = op1_factorisation_machine(spark, f"{tmp_path}/{name}").collect()
        assert len(out) == 303 and all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out)
        scores.append(sorted((r.doc_id, r.score) for r in out))
        assert np.mean([(r.score >= 0.5) == bool(r.doc_id % 2) for r in out if r.held_out and r.doc_id < 300]) > 0.95
    assert scores[0] == scores[1]  # labels of held-out rows teach nothing


def test_first_rows_are_exact_whatever_the_partitions(spark):
    from pyspark.sql import functions as F

    from quarrymill.llm.common import first_rows

    df = spark.range(5000).select(F.xxhash64((F.col("id") / 3).cast("long")).alias("h"), "id")
    want = sorted((r.h, r.id) for r in df.collect())
    for n in (0, 1, 700, 9000):
        for parts in (1, 13):
            assert [(r.h, r.id) for r in first_rows(df.repartition(parts), n, "h", ["id"]).collect()] == want[:n]
    assert first_rows(df.limit(0), 5, "h").count() == 0


def test_secrets_are_found_and_redacted(spark):
    docs = frame(spark)
    found = secrets.scan_secrets(docs, path_col="source").collect()
    values = texts()
    planted = {i for i, t in enumerate(values) if t and "password=" in t}
    assert {r.doc_id for r in found if r.is_secret} == planted
    for r in found:
        assert values[r.doc_id][r.start : r.start + len(r.value)] == r.value
    clean = {r.doc_id: r.text for r in secrets.redact(docs, secrets.scan_secrets(docs, path_col="source")).collect()}
    for i, t in enumerate(values):
        if i in planted:
            want = t
            for r in sorted((r for r in found if r.is_secret and r.doc_id == i), key=lambda r: -r.start):
                want = want[: r.start] + "[secret]" + want[r.start + len(r.value) :]
            assert clean[i] == want and "AKIA" not in clean[i]
        else:
            assert clean[i] == t


def test_labelled_findings_train_the_forest(spark):
    language = secrets.Language([("token", 50), ("value", 40)])
    rows = [("p", f"{i:016x}deadbeef{i}", "key", "", "assigned", 1) for i in range(60)] + [("p", f"report-2024-{i}", "see", "", "word", 0) for i in range(60)]
    findings = spark.createDataFrame(rows, "path string, value string, before string, after string, kind string, label int")
    forest = secrets.train_forest(findings, language)
    x = np.array([language.features(v, b, a, p) for p, v, b, a, _, _ in rows])
    assert ((forest.score(x) >= 0.5) == np.array([r[5] for r in rows])).mean() > 0.97
    assert secrets.Forest().score(x).tolist() == [0.0] * len(rows)


def test_language_fusion_uses_all_evidence(spark):
    docs = spark.createDataFrame([("the house and the garden", "en"), ("das haus und der garten", "de"), (None, "en"), ("la casa", None)], "text string, lang string")
    model = language_id.train_text(docs)
    page = lambda lang, text: f"<html lang='{lang}'><script>das und der</script><body><p>{text}</p></body></html>"
    rows = [(i, "https://a.example.de/x", page("de", "das haus und der garten")) for i in range(20)] + [(100 + i, "http://b.example.com", page("en", "the garden and the house")) for i in range(20)]
    rows += [(200, "https://a.example.de/y", "<html></html>"), (201, None, None), (202, "http://b.example.com/z", page("de", "the garden and the house"))]
    out = {r.page_id: r for r in language_id.identify_languages(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert len(out) == len(rows)
    assert out[0].lang == "de" and out[100].lang == "en" and out[202].lang == "en"
    assert out[200].lang == "de" and out[200].text_lang is None  # the host decides
    assert out[201].lang in ("en", "de") and out[0].host == "a.example.de" and out[0].suffix == "de"
    empty = language_id.identify_languages(spark.createDataFrame(rows[:2], "page_id long, url string, html string"), language_id.TextModel([], np.zeros((0, language_id.BUCKETS))))
    assert [r.lang for r in empty.collect()] == [None, None]
