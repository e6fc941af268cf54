"""The summary document against separate counts, and the plans of lateral lookups."""

import json
from collections import Counter
from datetime import timedelta

from quarrymill.operators import reviews as ops
from quarrymill.plans import stores
from quarrymill.plans.bindings import reviews

SF = "/root/testdata/sf0.001"


def entry(rows, small=30):
    n, m = len(rows), sum(r["sentiment"] == "negative" for r in rows)
    return {"reviews": n, "negatives": m, "negative_share_pct": round(100 * m / n + 1e-9, 1) if n else None, "small_sample": n < small}


def grouped(rows, key):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r)
    return out


def test_document_equals_separate_counts(spark):
    rows = [r.asDict() for r in reviews(spark, SF).collect()]
    got = {r["scope"]: json.loads(r["json"]) for r in ops.document(reviews(spark, SF)).collect()}
    assert set(got) == {"All", "shop", "market"}
    for scope, doc in got.items():
        own = [r for r in rows if scope in ("All", r["source"])]
        start, end = min(r["day"] for r in own), max(r["day"] for r in own)
        recent = end - timedelta(days=max(1, ((end - start).days + 1) // 3) - 1)
        assert doc["window"] == {"start": str(start), "end": str(end), "recent_start": str(recent), "reviews": len(own), "recent_reviews": sum(r["day"] >= recent for r in own)}

        def both(some):
            late = [r for r in some if r["day"] >= recent]
            early = [r for r in some if r["day"] < recent]
            return entry(some) | {"trend": {"recent": entry(late), "earlier": entry(early), "few_mentions": entry(some)["negatives"] < 5}}

        s = Counter(r["sentiment"] for r in own)
        assert doc["sentiment"] == {"reviews": len(own), "positive": s["positive"], "neutral": s["neutral"], "negatives": s["negative"], "negative_share_pct": entry(own)["negative_share_pct"]}
        assert doc["by_review_type_and_source"] == [{"kind": k, "source": v} | both(x) for (k, v), x in sorted(grouped(own, lambda r: (r["kind"], r["source"])).items())]
        for section, kind in (("product_by_sector_group", "product"), ("service_by_aspect", "service")):
            areas = [{"name": a} | both(x) for a, x in grouped([r for r in own if r["kind"] == kind], lambda r: r["area"]).items()]
            assert doc[section] == sorted(areas, key=lambda e: (-e["negatives"], -e["reviews"], e["name"]))
        assert doc["groups_by_source"] == [{"kind": k, "name": a, "source": v} | entry(x) for (k, a, v), x in sorted(grouped(own, lambda r: (r["kind"], r["area"], r["source"])).items())]
        assert doc["monthly_negative"] == [{"month": k} | entry(x) for k, x in sorted(grouped(own, lambda r: r["day"].strftime("%Y-%m")).items())]
        products = [{"name": p} | entry(x) for p, x in grouped([r for r in own if r["kind"] == "product" and r["product"]], lambda r: r["product"]).items()]
        worst = sorted([p for p in products if p["negatives"] >= 3], key=lambda e: (-e["negatives"], -e["reviews"], e["name"]))[:10]
        assert doc["products_most_negative"] == worst
        assert 0 < len(doc["top_negative_themes"]) <= 15 and doc["top_negative_themes"] == sorted(doc["top_negative_themes"], key=lambda t: -t["count"])


def test_document_of_no_reviews(spark):
    assert ops.document(reviews(spark, SF).where("false")).count() == 0


def test_lateral_lookups_are_joins_on_the_part(spark):
    plan = stores.last_line_of_parts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan and "Join" in plan
