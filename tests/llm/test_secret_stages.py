from corpus import sentence

from quarrymill.llm import secrets


def test_findings_are_labelled_where_they_are_found(spark, monkeypatch):
    import random

    rng = random.Random(9)
    rows = [(i, f'{sentence(rng, 12)} password="{rng.getrandbits(72):018x}" sha256={rng.getrandbits(256):064x} id: {rng.getrandbits(60)}', "s") for i in range(30)]
    rows += [(None, "token = 4f5e6d7c8b9a0f1e2d", None), (31, None, "s"), (32, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plans, known = [], []

    def seen(findings, language, **more):
        plans.append(findings._jdf.queryExecution().executedPlan().toString())
        known.extend(findings.select("doc_id", "path", "start", "value", "before", "after", "kind", "label").collect())
        return secrets.Forest()

    monkeypatch.setattr(secrets, "train_forest", seen)
    secrets.train_scanner(docs, path_col="source")
    # two Python passes in one stage hold two workers a core
    assert plans and all(p.count("MapInArrow") == 1 for p in plans), plans[0]
    want = secrets.labelled_findings(secrets.find_candidates(docs, path_col="source")).collect()
    assert {r.label for r in want} == {0, 1} and set(known) == set(want)
    got = secrets.settled_candidates(docs, path_col="source").collect()
    assert sorted(got, key=str) == sorted(want, key=str)
