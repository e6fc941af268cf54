from quarrymill.operators import plan, replenish
from quarrymill.plans.bindings import ANCHOR, inventory, weekly_forecast

SF = "/root/testdata/sf0.001"


def test_plan_explains_every_month(spark):
    from pyspark.sql import functions as F

    months = inventory(spark, SF)
    rows = plan.plan(months, weekly_forecast(spark, SF).withColumn("week_end", F.add_months("week_end", 2)), ANCHOR, 4).collect()
    keys = {r.key for r in months.where(F.col("month") <= ANCHOR).select("key").distinct().collect()}
    assert {r.key for r in rows} == keys and len(rows) == 4 * len(keys)
    for r in rows:
        assert min(r.units, r.p80, r.p90) >= 0  # cases are replayed apart, so a higher one may order earlier and less later
        assert ("HIGH_CASE_ORDER_ONLY" in r.detail) == (r.units <= 0 and max(r.p80, r.p90) > 0)
        codes = r.detail.split("|")
        assert codes[0] == r.reason and set(codes) <= set(replenish.REASONS) and len(set(codes)) == len(codes)
        if r.reason.startswith("NO_ORDER"):
            assert r.units == 0
        if r.reason in replenish.LOW:
            assert r.confidence == "LOW"


def test_plan_does_not_look_ahead(spark):
    from pyspark.sql import functions as F

    months, weekly = inventory(spark, SF), weekly_forecast(spark, SF).limit(0)
    tampered = months.withColumn("sales", F.when(F.col("month") > ANCHOR, 1e6).otherwise(F.col("sales")))
    a, b = (sorted((r.key, str(r.month), r.units) for r in plan.plan(m, weekly, ANCHOR, 2).collect()) for m in (months, tampered))
    assert a == b and a
