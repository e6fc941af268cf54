"""Replies held against summaries: every rule against a plain reading of the same JSON."""

import json
import re

import pytest

from quarrymill.operators import grounding
from quarrymill.plans import review

SF = "/root/testdata/sf0.001"
MONTH = "jan january feb february mar march apr april may jun june jul july aug august sep sept september oct october nov november dec december".split()


def figures(text):
    """Walks over the words of a text: what is a number by itself, unless its neighbours make it a date or a period."""
    months = "|".join(sorted(MONTH, key=len, reverse=True))
    for pattern in (r"\b\d{4}-\d\d?(-\d\d?)?\b", r"\b\d\d?[/.]\d\d?[/.]\d{2,4}\b", rf"\b\d\d?(st|nd|rd|th)?\s+(of\s+)?({months})\b\.?(,?\s+\d{{4}})?", rf"\b({months})\.?\s+\d\d?(st|nd|rd|th)?\b(,?\s+\d{{4}})?", r"\b(19|20)\d\d\b", r"\b\d+\s*(month|year|week|day)s?\b"):
        text = re.sub(pattern, " ", text, flags=re.I)
    out = []
    for m in re.finditer(r"(?<![\w.])([0-9]{1,3}(,[0-9]{3})+|[0-9]+(\.[0-9]+)?)(?!\w)(\s*(%|per\s?cent\b))?", text, re.I):
        out.append((float(m[1].replace(",", "")), bool(m[4]), m[0].strip()))
    return out


def known(value, key="", out=None):
    out = out if out is not None else (set(), set())
    if isinstance(value, dict):
        for k, v in value.items():
            known(v, k, out)
    elif isinstance(value, list):
        for v in value:
            known(v, key, out)
    elif isinstance(value, str):
        for v, percent, _ in figures(value):
            out[0].add(round(v, 1))
            if percent:
                out[1].add(round(v, 1))
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        out[0].add(round(float(value), 1))
        if key.endswith("_pct"):
            out[1].add(round(float(value), 1))
    return out


def problems(text, summary):
    try:
        items = json.loads(text)["items"]
        assert isinstance(items, list)
    except (ValueError, KeyError, TypeError, AssertionError):
        return [(0, "no_list_of_items", "")]
    if len(items) != 3:
        return [(0, "item_count", str(len(items)))]
    values, percents = known(summary)
    entries = [e for s in grounding.SECTIONS for e in summary.get(s, [])]
    areas = {"overall": "overall", **{e["name"].lower(): e["name"] for e in entries}}
    small = {e["name"].lower() for e in entries if e.get("small_sample")}
    out, ranks = [], []
    for i, item in enumerate(items, 1):
        if not isinstance(item, dict):
            out.append((i, "no_object", ""))
            continue
        if type(item.get("rank")) is not int:
            out.append((i, "no_whole_rank", ""))
        ranks.append(item.get("rank"))
        fine = {}
        for f, most in grounding.FIELDS.items():
            v = item.get(f)
            if not isinstance(v, str) or not v.split():
                out.append((i, f"no_{f}", ""))
                continue
            v = " ".join(v.split())
            if len(v) > most:
                out.append((i, f"long_{f}", str(len(v))))
                continue
            fine[f] = v
            if f in ("description", "rationale", "evidence"):
                bad = [w for x, p, w in figures(v) if not ((round(x, 1) in percents or (round(x, 1) == int(x) and any(int(q + 0.5) == x for q in percents))) if p else round(x, 1) in values)]
                if bad:
                    out.append((i, f"unsupported_figure_in_{f}", ", ".join(bad)))
            if f in ("title", "description", "rationale", "evidence"):
                words = [" ".join(x.lower().split()) for x in re.findall(r"\b(?:significant|significantly|statistically|meaningful|not\s+random|random\s+variation)\b", v, re.I)]
                if words:
                    out.append((i, f"banned_wording_in_{f}", ", ".join(dict.fromkeys(words))))
                names = [x for x in re.findall(r"\w+", v) if re.fullmatch(r"[a-z][a-z0-9]*(_[a-z0-9]+)+", x)]
                if names:
                    out.append((i, f"field_name_in_{f}", ", ".join(dict.fromkeys(names))))
        area = fine.get("related_area")
        if area is not None and area.lower() not in areas:
            out.append((i, "unknown_area", area))
        elif area is not None:
            area = areas[area.lower()]
        strength = fine.get("evidence_strength", "").lower()
        if strength and strength not in grounding.STRENGTHS:
            out.append((i, "unknown_strength", fine["evidence_strength"]))
        elif strength:
            verb = (re.findall(r"[^\W\d_]+", fine.get("title", "")) or [""])[0].lower()
            if strength == "early signal" and verb in grounding.STRONG_VERBS:
                out.append((i, "strong_verb_for_early_signal", verb))
            if strength != "early signal" and area and area.lower() in small:
                out.append((i, "strength_of_small_area", f"{area}, {summary.get('small_sample_threshold_reviews', 30)}"))
    if not out and sorted(ranks) != [1, 2, 3]:
        out.append((0, "ranks", ", ".join(map(str, sorted(ranks)))))
    return out


def item(rank=1, **changes):
    return {"rank": rank, "title": "Review sizes", "description": "12 of 40 say so.", "rationale": "It is 30%.", "related_area": "overall", "evidence": "12 reviews", "evidence_strength": "strong"} | changes


def frames(spark, replies, summaries):
    return spark.createDataFrame([(k, s, t if isinstance(t, str) or t is None else json.dumps(t)) for k, (s, t) in replies.items()], "reply string, summary string, json string"), spark.createDataFrame([(k, json.dumps(v)) for k, v in summaries.items()], "summary string, json string")


SUMMARIES = {
    "a": {"sentiment": {"reviews": 40, "negatives": 12, "share_pct": 30.4}, "service_by_aspect": [{"name": "Late Parcels", "small_sample": True, "deep": [[{"note": "up 3.25 per cent, 1,200 lines in 12 weeks"}]]}], "product_by_region": [{"name": "UK"}, {"name": "late parcels"}, {"name": "Overall"}], "flag": True},
    "b": {},
}


def test_every_rule_by_a_plain_reading(spark):
    three = lambda **c: {"items": [item(**c), item(2), item(3)]}
    replies = {
        "fine": ("a", three()), "nothing": ("a", None), "text": ("a", "x"), "list": ("a", [1]), "object": ("a", {"items": {"a": 1}}), "two": ("a", {"items": [item(), item(2)]}), "four": ("a", {"items": [item(), item(2), item(3), item(4)]}), "empty": ("a", {"items": []}),
        "odd": ("a", {"items": [item(), 5, None]}), "rank": ("a", three(rank=None)), "float": ("a", three(rank=1.5)), "true": ("a", three(rank=True)), "ranks": ("a", {"items": [item(1), item(1), item(3)]}), "missing": ("a", {"items": [{"rank": 1}, item(2), item(3)]}),
        "long": ("a", three(title="x" * 201, evidence="y" * 1001, related_area="z" * 101)), "just": ("a", three(title="x" * 200)), "number": ("a", three(description="13 of 40", rationale="12% or 30 per cent", evidence="on 3 May 2020, D12 and 1,200")), "deep": ("a", three(evidence="3.25% and 3.2 and 3%")),
        "words": ("a", three(title="Significant, NOT  random and significant")), "names": ("a", three(evidence="small_sample of few_mentions, not Small_sample")), "area": ("a", three(related_area="fit")), "case": ("a", three(related_area="uk")),
        "small": ("a", three(related_area="LATE parcels")), "small early": ("a", three(related_area="late  parcels", evidence_strength="Early Signal")), "verb": ("a", three(title="2 Fix: it", evidence_strength="early signal")), "strength": ("a", three(evidence_strength="weak")),
        "bare summary": ("b", three(description="5 say so")), "no summary": ("c", three()), "type": ("a", three(title=5, description=[1], evidence={"a": 1})), "unicode": ("a", three(description="é12 of ١٢, 12é and 40 1200")),
    }
    found, clean = grounding.check_replies(*frames(spark, replies, SUMMARIES))
    got: dict = {k: [] for k in replies}
    for r in found.collect():
        got[r["reply"]].append((r["item"], r["rule"], r["detail"]))
    for k, (s, t) in replies.items():
        want = problems(t if isinstance(t, str) else json.dumps(t), SUMMARIES.get(s, {}))
        assert sorted(got[k]) == sorted(want), k
    fine = {r["reply"] for r in clean.collect()}
    assert fine == {k for k in replies if not got[k]} and {"fine", "just", "case", "small early"} <= fine
    assert {r["related_area"] for r in clean.where("reply = 'case'").collect()} == {"UK", "Overall"}


def test_leaves_of_deep_documents(spark):
    doc = {"a": [1, [2, {"b": [3, "x"]}], None], "c": {}, "d": {"e": {"f": {"g": 4.5}}}, "h": []}
    docs = spark.createDataFrame([(1, json.dumps(doc)), (2, "7"), (3, None)], "id int, j string").selectExpr("id", "try_parse_json(j) as v")
    got = [(r["id"], r["key"], r["t"]) for r in grounding.document_leaves(docs).selectExpr("id", "key", "to_json(leaf) as t").collect()]
    assert sorted((i, k, t) for i, k, t in got if t is not None) == [(1, "a", "1"), (1, "a", "2"), (1, "a", "null"), (1, "b", '"x"'), (1, "b", "3"), (1, "g", "4.5"), (2, "", "7")]


def test_empty_tables(spark):
    found, clean = grounding.check_replies(*frames(spark, {}, {}))
    assert found.count() == 0 and clean.count() == 0


def test_query_finds_every_planted_rule(spark):
    texts = {r["summary"]: json.loads(r["json"]) for r in review.summary_documents(spark, SF).collect()}
    replies = review.planted_replies(spark, SF).collect()
    found, clean = grounding.check_replies(review.planted_replies(spark, SF), review.summary_documents(spark, SF))
    got: dict = {r["reply"]: [] for r in replies}
    for r in found.collect():
        got[r["reply"]].append((r["item"], r["rule"], r["detail"]))
    rules = set()
    for r in replies:
        want = problems(r["json"], texts[r["summary"]])
        assert sorted(got[r["reply"]]) == sorted(want), r["json"]
        rules |= {w[1] for w in want}
    assert {"no_list_of_items", "item_count", "no_object", "no_whole_rank", "ranks", "no_rationale", "no_evidence", "long_title", "long_description", "unsupported_figure_in_description", "unsupported_figure_in_evidence"} <= rules
    assert {"banned_wording_in_title", "banned_wording_in_rationale", "field_name_in_evidence", "unknown_area", "unknown_strength", "strong_verb_for_early_signal", "strength_of_small_area", "no_title"} <= rules
    assert clean.count() == 3 * sum(not v for v in got.values()) > 0


@pytest.mark.parametrize("name", ["grounded_replies", "accepted_items"])
def test_queries_have_rows(spark, name):
    assert getattr(review, name)(spark, SF).count() > 0
