import math
from collections import Counter

import numpy as np
import pytest

from quarrymill.llm import language_id


def brute(rows, model, kappa=language_id.KAPPA, temper=language_id.TEMPER):
    """The fusion by loops over pages."""
    langs, read = model.languages, []
    for i, url, page in rows:
        text = language_id.visible_text(page).encode()
        s = model.score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0] * temper
        host = url.split("/")[2] if url else ""
        first = langs[int(s.argmax())] if np.abs(s - s.max()).sum() > 0 else None
        declared = page.split("lang='")[1][:2] if page and "lang='" in page else ""
        read.append((i, host, host.split(".")[-1], declared, first, s - s.max()))
    out = {}
    for i, host, suffix, declared, first, s in read:
        rest = [r for r in read if r[0] != i and r[4]]
        count = lambda k, v: Counter(r[4] for r in rest if k is None or r[k] == v)  # noqa: B023, E731
        prior = {x: 1 / len(langs) for x in langs}
        for c in (count(None, None), count(2, suffix), count(1, host)):
            prior = {x: (c[x] + kappa * prior[x]) / (sum(c.values()) + kappa) for x in langs}
        of, by = count(None, None), count(3, declared)
        score = [s[k] + math.log(prior[x]) + (math.log((by[x] + 0.5) / (of[x] + 1)) if by else 0) for k, x in enumerate(langs)]
        p = np.exp(np.array(score) - max(score))
        out[i] = (first, langs[int(np.argmax(score))], 1 / p.sum())
    return out


def pages(n=90):
    rng = np.random.default_rng(7)
    text = {"en": "the garden and the house of the old river", "de": "das haus und der garten an dem alten fluss", "fr": "la maison et le jardin de la vieille rue"}
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[rng.integers(3)]
        words = rng.choice(text[lang].split(), rng.integers(1, 9)).tolist()
        declared = lang if rng.random() < 0.7 else ("en", "xx")[rng.integers(2)]
        host = f"h{rng.integers(5)}.{ {'en': 'com', 'de': 'de', 'fr': 'fr'}[lang] if rng.random() < 0.8 else 'org'}"
        rows.append((i, f"https://{host}/{i}", f"<html lang='{declared}'><body><p>{' '.join(words)}</p></body></html>"))
    return [*rows, (n, "https://h9.example/x", None), (n + 1, None, "<html lang='de'><p>das haus</p></html>"), (n + 2, None, ""), (n + 3, "https://alone.test/", "<html lang='zz'><p>the garden</p></html>")]


def test_fusion_against_brute_force(spark):
    docs = spark.createDataFrame([("the house and the garden of a river", "en"), ("das haus und der garten", "de"), ("la maison et le jardin", "fr"), (None, "en"), ("x", None)], "text string, lang string")
    model = language_id.train_text(docs)
    rows = pages()
    out = {r.page_id: r for r in language_id.identify_languages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), model).collect()}
    want = brute(rows, model)
    assert len(out) == len(rows)
    for i, (first, lang, confidence) in want.items():
        assert (out[i].text_lang, out[i].lang) == (first, lang) and math.isclose(out[i].confidence, confidence, rel_tol=1e-6), i


def test_a_page_is_not_its_own_prior(spark):
    model = language_id.TextModel(["de", "en"], np.ones((2, language_id.BUCKETS)) + np.eye(2, language_id.BUCKETS))
    page = "<html lang='en'><p>{}</p></html>"
    one = [(1, "https://a.example/x", page.format("word"))]
    alone = language_id.identify_languages(spark.createDataFrame(one, "page_id long, url string, html string"), model).first()
    s = model.score(np.frombuffer(b" word ", np.uint8), np.array([0, 6]))[0] * language_id.TEMPER
    assert math.isclose(alone.confidence, 1 / np.exp(s - s.max()).sum(), rel_tol=1e-6)  # its text and nothing else


def test_rare_languages_are_kept_and_too_many_are_an_error(spark):
    docs = spark.createDataFrame([(f"word{i} text", f"l{i:03d}") for i in range(250)], "text string, lang string")
    assert len(language_id.train_text(docs).languages) == 250
    with pytest.raises(ValueError, match="more than 9"):
        language_id.train_text(docs, max_languages=9)


def test_held_out_accuracy(spark):
    """Languages of documents that the model has not seen, put into pages of one host with a wrong declaration."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null and lang is not null and length(text) > 100")
    model = language_id.train_text(docs.where("doc_id % 2 = 0"))
    made = docs.where("doc_id % 2 = 1").selectExpr("doc_id as page_id", "'https://one.example/' as url", "concat('<html><p>', text, '</p></html>') as html", "lang")
    out = language_id.identify_languages(made, model).join(made.select("page_id", "lang").withColumnRenamed("lang", "want"), "page_id").collect()
    assert len(out) > 30 and np.mean([r.lang == r.want for r in out]) > 0.97
