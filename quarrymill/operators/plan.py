"""The whole replenishment forecast: demand, stock replay, adjustments, reasons, decisions and summary.

Every item is one row of arrays over the months of the forecast until they are exploded at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import total
from ..session import use_checkpoints
from .adjustments import by_item
from .forecast import seasonal_factors, seasonal_forecast
from .grid import last_known
from .replenish import confidence, held_months, in_order, learn_habits, po_share, pooled_habits, replay, shares_by, uplift_ratios, weekly_to_monthly

SEASONAL_MONTHS = 24  # with fewer the seasonal shape is flat
CASES = ("mean", "p80", "p90")


def starting_position(past: DataFrame) -> DataFrame:
    """(key, stock0, po0, recent, sold, history): stock known in the last three months, open orders, sales."""
    back = F.row_number().over(Window.partitionBy("key").orderBy(F.col("month").desc()))
    held = past.select("*", last_known(F.col("stock")).alias("known"), back.alias("back"))
    return held.groupBy("key").agg(
        F.max(F.when(F.col("back") == 1, F.col("known"))).alias("stock0"), F.coalesce(F.max(F.when(F.col("back") == 1, F.col("open_po"))), F.lit(0.0)).alias("po0"),
        F.avg(F.when(F.col("back") <= 3, F.col("sales"))).alias("recent"), F.coalesce(F.sum("sales"), F.lit(0.0)).alias("sold"), F.count("sales").alias("history"),
        F.coalesce(F.sum(F.when(F.col("back") <= 12, F.col("sales"))), F.lit(0.0)).alias("last12"), F.min(F.when(F.col("sales").isNotNull(), F.col("month"))).alias("first_month"),
        F.max(F.when(F.col("back") == 1, F.col("known").isNotNull())).alias("has_stock"),
    )


def market_facts(past: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row: months of the market, whether open orders and market forecasts were ever seen, the ratios, the share."""
    order = Window.partitionBy("key").orderBy(F.col("month").desc())
    seen = past.select("month", "open_po", F.row_number().over(order).alias("back"))
    facts = seen.agg(F.countDistinct("month").alias("market_months"), F.coalesce(F.max((F.col("open_po") > 0) & (F.col("back") > 1)), F.lit(False)).alias("po_seen"))
    usual = monthly.agg(F.coalesce(F.max(F.col("mean") > 0), F.lit(False)).alias("ratios_seen"))
    return facts.crossJoin(usual).crossJoin(uplift_ratios(monthly)).crossJoin(po_share(past))  # each is one row


def own_demand(past: DataFrame, train_end: str, horizon: int, min_history: int, young_min: int, demand_shrink: float, start: DataFrame) -> DataFrame:
    """(key, young, own array): the seasonal forecast, or for young items with sales their recent mean."""
    sales = past.select("key", "month", F.col("sales").alias("units"))
    grown = seasonal_forecast(sales, train_end, horizon, min_history, demand_shrink)
    grown = grown.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("step", "predicted"))), lambda x: x["predicted"]).alias("own"))
    young = start.where((F.col("history") < min_history) & (F.col("history") >= young_min) & (F.col("sold") > 0))
    young = young.select("key", F.lit(True).alias("young"), F.array_repeat("recent", horizon).alias("own"))
    return grown.select("key", F.lit(False).alias("young"), "own").unionByName(young)


def _scenarios(weight: Column) -> Column:
    """array<struct<mean, p80, p90, market, override, multiplier>> of the months, adjusted."""

    def month(h: Column) -> Column:
        own, m = F.greatest(F.get("own", h), F.lit(0.0)), F.get("market", h)
        use = m.isNotNull() & (weight > 0)
        base = F.when(use, weight * m["mean"] + (1 - weight) * own).otherwise(own)
        p80 = F.greatest(F.when(use, base + weight * (m["p80"] - m["mean"])).otherwise(own * F.col("r80")), base)
        p90 = F.greatest(F.when(use, base + weight * (m["p90"] - m["mean"])).otherwise(own * F.col("r90")), p80)
        fixed, factor = F.get("overrides", h), F.coalesce(F.get("multipliers", h), F.lit(1.0))
        values = (F.coalesce(fixed * r, c) * factor for c, r in ((base, F.lit(1.0)), (p80, F.col("r80")), (p90, F.col("r90"))))
        return F.struct(*(v.cast("double").alias(n) for n, v in zip(CASES, values, strict=True)), use.alias("use"), fixed.isNotNull().alias("fixed"), (factor != 1).alias("scaled"))

    return F.transform(F.sequence(F.lit(0), F.size("own") - 1), month)


def _codes(*pairs: tuple[Column, str]) -> Column:
    """The codes whose condition holds, as an array."""
    return F.filter(F.array(*(F.when(F.coalesce(on, F.lit(False)), code) for on, code in pairs)), lambda c: c.isNotNull())


def _demand_codes(d: Column, weight: float, flat: Column) -> Column:
    default = ~F.col("ratios_seen")
    young, on = F.col("young"), F.lit(weight > 0)
    return _codes(
        (young & d["use"], "DEMAND_AMAZON_FORECAST"), (young & ~d["use"], "DEMAND_RECENT_AVERAGE"),
        (~young & d["use"], "DEMAND_AMAZON_BLEND"), (~young & ~d["use"] & on, "DEMAND_OWN_NO_AMAZON"), (~young & ~d["use"] & ~on, "DEMAND_OWN_AMAZON_OFF"),
        ((~d["use"] | d["fixed"]) & default, "AMAZON_RATIOS_DEFAULT"), (d["fixed"], "DEMAND_OVERRIDE"), (d["scaled"], "DEMAND_MULTIPLIER"), (flat & ~young, "SEASONALITY_FLAT"),
    )


def _month(h: Column, units: Column, high: Column, blind: Column) -> tuple[Column, Column]:
    """(the code that decides a month, others that hold) from the likely case's records."""
    now, source = F.get("r_mean", h), F.get("r_mean", F.when(h >= F.col("delay"), h - F.col("delay")).otherwise(-1))
    lands = F.coalesce(source["ordered"], F.lit(False))
    stopped = F.coalesce(h >= F.col("stop_from"), F.lit(False))
    pinned = F.coalesce(F.get("pinned", h), F.lit(0.0)) > 1e-9
    idle = F.when((F.col("delay") > 0) & now["ordered"], "NO_ORDER_DELAYED").when(source["blocked"], "NO_ORDER_DISCONTINUED").otherwise("NO_ORDER_STOCK_COVERS")
    busy = F.when(lands & source["floored"], "REORDER_MIN_ORDER_SIZE").when(lands, "REORDER_TRIGGERED").when(pinned, "PINNED_ORDER").otherwise("OPEN_PO_DELIVERY")
    quiet = stopped & (units <= 0)
    primary = F.when(blind, F.when(quiet, "NO_ORDER_DISCONTINUED").otherwise("SALES_ONLY_NO_STOCK")).when(units <= 0, idle).otherwise(busy)
    others = _codes(
        (~blind & (now["po_in"] > 1e-9), "OPEN_PO_DELIVERY"), (pinned, "PINNED_ORDER"), ((units <= 0) & (high > 0), "HIGH_CASE_ORDER_ONLY"),
        (blind & quiet, "SALES_ONLY_NO_STOCK"), (stopped, "DISCONTINUED"), (~blind & ~F.col("po_seen") & (now["po_in"] > 1e-9), "PO_SHARE_DEFAULT"),
    )
    return primary, others


def _item_codes(blind: Column) -> Column:
    """Codes that hold for all months of an item."""
    own_cover, default_cover, default_lot = F.col("own_cover"), F.col("default_cover"), F.col("default_lot")
    by_default = (F.col("cover_set").isNull() & default_cover & ((F.col("source") != "own") | ~own_cover)) | (F.col("lot_set").isNull() & default_lot & (F.col("source") != "own"))
    return _codes(
        *((~blind & (F.col("source") == s), f"HABIT_{s.upper()}") for s in ("own", "blended", "pooled")),
        (~blind & by_default, "HABIT_MARKET_DEFAULT"), (~blind & (F.col("cover_set").isNotNull() | F.col("lot_set").isNotNull()), "HABIT_OVERRIDE"),
        (F.col("notes") != "", "CLIENT_ADJUSTED"), (F.col("stock_set").isNotNull(), "STOCK_OVERRIDE"), (F.col("po_set").isNotNull(), "OPEN_PO_OVERRIDE"),
        (~blind & (F.col("delay") > 0), "ORDERS_DELAYED"), (blind & (F.col("delay") > 0), "DELAY_NOT_APPLIED_NO_STOCK"),
    )


def plan(
    months: DataFrame, weekly: DataFrame | None, train_end: str, horizon: int = 6, weight: float = 0.5, *, adjustments: DataFrame | None = None, min_history: int = 12,
    young_min: int = 3, demand_shrink: float = 0.5, percentile_shrink: float = 1.0, min_order_share: float = 0.25,
) -> DataFrame:
    """(key, month, units, p80, p90, order_chance, basis, adjustments, habit_source, young, reason, detail, confidence).

    months: a grid (key, month, sales, stock, received, open_po) up to train_end, of which sales before
    an item's first are null or absent; weekly: the market's forecast, or None; adjustments: rows of
    usable_adjustments. Own demand is the seasonal forecast, or for young items the mean of the last
    three months. Each scenario is replayed from the last known stock; without a reading in three
    months orders follow the demand. Items without a forecast have no rows; see decisions.
    """
    spark = months.sparkSession
    end = F.to_date(F.lit(train_end))
    first_month = spark.range(1).select(F.add_months(end, 1).cast("string")).first()[0]
    past = months.where(F.col("month") <= end)
    start = starting_position(past)
    if weekly is None:
        weekly = spark.createDataFrame([], "key long, version int, week_end date, mean double, p80 double, p90 double")
    monthly = weekly_to_monthly(weekly, percentile_shrink)
    market_by = monthly.where(F.col("month").between(F.add_months(end, 1), F.add_months(end, horizon))).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct(F.months_between("month", end).cast("int").alias("h"), F.struct(*CASES)))).alias("by_month")
    )
    at = F.sequence(F.lit(1), F.lit(horizon))
    rows = own_demand(past, train_end, horizon, min_history, young_min, demand_shrink, start).join(start, "key")
    rows = rows.join(learn_habits(past.select("key", "month", "sales", "stock", "received")), "key")
    rows = rows.join(market_by, "key", "left").withColumn("market", F.transform(at, lambda h: F.try_element_at("by_month", h)))
    rows = rows.crossJoin(F.broadcast(market_facts(past, monthly)))  # one row
    if adjustments is None:
        none = {"multipliers": "array<double>", "overrides": "array<double>", "pinned": "array<double>", "stock_set": "double", "po_set": "double", "cover_set": "double", "lot_set": "double", "stop_from": "int"}
        rows = rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in none.items()), F.lit(0).alias("delay"), F.lit("").alias("notes"))
    else:
        given = by_item(adjustments, first_month, horizon)
        for old, new in (("stock", "stock_set"), ("open_po", "po_set"), ("cover", "cover_set"), ("lot", "lot_set")):
            given = given.withColumnRenamed(old, new)
        rows = rows.withColumn("_id", F.col("key").cast("string")).join(given.withColumnRenamed("key", "_id"), "_id", "left").drop("_id")
        rows = rows.withColumn("delay", F.coalesce("delay", F.lit(0))).withColumn("notes", F.coalesce("notes", F.lit("")))

    rows = rows.withColumn("stock1", F.coalesce("stock_set", "stock0")).withColumn("po1", F.coalesce("po_set", "po0"))
    blind = F.col("stock1").isNull()
    share = F.when(~F.col("young"), weight).when(F.lit(weight > 0) & ~blind, 1.0).otherwise(0.0)
    rows = rows.withColumn("d", _scenarios(share))
    for c in CASES:
        made = replay(
            F.col("d")[c], F.coalesce("stock1", F.lit(0.0)), F.col("po1"), F.coalesce("cover_set", "cover"), F.coalesce("lot_set", "lot"), F.col("po_share"),
            pinned=F.col("pinned"), stop_from=F.col("stop_from"), min_order_share=min_order_share,
        )
        rows = rows.withColumn(f"r_{c}", made)

    def total(c: str, h: Column) -> Column:
        """Orders of a month: known ones and, `delay` months later than decided, new ones."""
        record, pin = F.get(f"r_{c}", h), F.coalesce(F.get("pinned", h), F.lit(0.0))
        late = F.get(f"r_{c}", F.when(h >= F.col("delay"), h - F.col("delay")).otherwise(-1))
        follows = F.when(F.coalesce(h >= F.col("stop_from"), F.lit(False)), 0.0).otherwise(F.greatest(F.get("d", h)[c], F.lit(0.0)))
        return F.when(blind, follows + pin).otherwise(record["known"] + F.coalesce(late["new"], F.lit(0.0)))

    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    totals = F.transform(steps, lambda h: F.struct(h.alias("h"), *(total(c, h).alias(c) for c in CASES)))
    flat = rows.withColumn("codes", _item_codes(blind)).withColumn("blind", blind).select("*", F.explode(totals).alias("t"))
    stored = {n: F.bround(F.greatest(F.col(f"t.{c}"), F.lit(0.0)), 2) for c, n in zip(CASES, ("units", "p80", "p90"), strict=True)}
    flat = flat.select("*", *(v.alias(n) for n, v in stored.items()))
    h, flat_season = F.col("t.h"), F.col("market_months") < SEASONAL_MONTHS
    primary, others = _month(h, F.col("units"), F.greatest("p80", "p90"), F.col("blind"))
    flat = flat.withColumn("decided", primary)
    rest = F.concat(others, _demand_codes(F.get("d", h), weight, flat_season), "codes", F.when(F.col("young"), F.array("decided")).otherwise(F.array().cast("array<string>")))
    flat = flat.withColumn("reason", F.when(F.col("young"), "YOUNG_PRODUCT_BACKUP").otherwise(F.col("decided"))).withColumn("rest", rest)
    flat = flat.withColumn("rest", F.array_remove("rest", F.col("reason")))
    chance = sum(F.when(F.col(f"t.{c}") > 1e-9, 1).otherwise(0) for c in CASES) / 3
    return flat.select(
        "key", F.add_months(end, h + 1).alias("month"), "units", "p80", "p90", F.when(~F.col("blind"), F.bround(chance, 2)).alias("order_chance"),
        F.when(F.col("blind"), "sales_only").otherwise("replay").alias("basis"), F.col("notes").alias("adjustments"), F.col("source").alias("habit_source"), "young", "reason",
        F.concat_ws("|", "reason", F.nullif(in_order(F.col("rest")), F.lit(""))).alias("detail"), confidence(F.concat("rest", F.array("reason"))).alias("confidence"),
    )


def decisions(planned: DataFrame, months: DataFrame, weekly: DataFrame | None, train_end: str, horizon: int = 6) -> DataFrame:
    """One row an item of sales, of the newest market forecast or of the inventory: what was decided and why."""
    end = F.to_date(F.lit(train_end))
    past = months.where(F.col("month") <= end)
    start = starting_position(past)
    rank = F.create_map(*[F.lit(x) for pair in (("LOW", 0), ("MEDIUM", 1), ("HIGH", 2)) for x in pair])
    per = planned.groupBy("key").agg(
        F.first("basis").alias("basis"), F.first("habit_source").alias("habit_source"), F.min_by("confidence", rank[F.col("confidence")]).alias("confidence"),
        F.bround(F.sum("units"), 2).alias("forecast_units"), F.max("young").alias("young"),
    )
    everyone = start.select("*", (F.col("history") > 0).alias("in_sales"))
    if weekly is not None:
        newest = weekly.where(F.col("version") == weekly.agg(F.max("version")).first()[0]).select("key").distinct()
        ahead = weekly_to_monthly(weekly).where(F.col("month").between(F.add_months(end, 1), F.add_months(end, horizon))).groupBy("key").agg(F.count("*").alias("amazon_months"))
        everyone = everyone.join(newest.withColumn("in_market", F.lit(True)), "key", "full").join(ahead, "key", "left")
    else:
        everyone = everyone.select("*", F.lit(False).alias("in_market"), F.lit(0).alias("amazon_months"))
    j = everyone.join(per, "key", "left")
    in_sales, forecast = F.coalesce("in_sales", F.lit(False)), F.col("basis").isNotNull()
    status = F.when(forecast, "FORECAST").when(in_sales & (F.col("sold") <= 0), "NO_SALES").when(in_sales, "SHORT_HISTORY").when(F.col("in_market"), "AMAZON_FORECAST_ONLY").otherwise("INVENTORY_ONLY")
    why = F.when(forecast & F.col("young"), "YOUNG_PRODUCT_BACKUP").when(F.col("basis") == "sales_only", "SALES_ONLY_NO_STOCK").when(forecast, "REPLAY").otherwise(status)
    zero = lambda c, t="long": F.coalesce(c, F.lit(0)).cast(t)
    return j.select(
        "key", status.alias("status"), why.alias("reason_code"), "confidence", "basis", "habit_source", zero("history").alias("months_of_history"),
        (zero("amazon_months") > 0).alias("has_amazon_forecast"), F.coalesce("has_stock", F.lit(False)).alias("has_stock_data"), zero("amazon_months").alias("amazon_months"),
        F.date_format("first_month", "yyyy-MM-dd").alias("first_sales_month"), F.bround(F.coalesce("last12", F.lit(0.0)), 2).alias("last12_units"), "forecast_units",
    )


def summary(planned: DataFrame, decided: DataFrame) -> DataFrame:
    """One row (document): the counts of a run as a JSON object with fixed fields."""
    fc = F.col("status") == "FORECAST"
    n = F.count_if
    counts = decided.agg(
        n(F.col("months_of_history") > 0).alias("asins_in_sales"), n(fc).alias("asins_forecast"), n(fc & (F.col("reason_code") != "YOUNG_PRODUCT_BACKUP")).alias("asins_forecast_standard"),
        n(F.col("reason_code") == "YOUNG_PRODUCT_BACKUP").alias("young_product_backups"), n(F.col("status") == "SHORT_HISTORY").alias("skipped_short_history"), n(F.col("status") == "NO_SALES").alias("skipped_no_sales"),
        n(fc & ~F.col("has_amazon_forecast")).alias("asins_without_amazon_forecast"), n(F.col("status") == "AMAZON_FORECAST_ONLY").alias("amazon_only_dropped"),
        n(F.col("status") == "INVENTORY_ONLY").alias("inventory_only_dropped"), n(fc & (F.col("basis") == "sales_only")).alias("sales_only_asins"),
        n(fc & (F.col("basis") == "replay") & (F.col("habit_source") == "pooled")).alias("default_habit_asins"),
    )
    units = planned.agg(F.bround(F.sum("units"), 2).alias("units_forecast_total"), F.countDistinct(F.when(F.col("adjustments") != "", F.col("key"))).alias("asins_with_adjustments"))

    def tally(c: str) -> DataFrame:
        by = planned.groupBy(c).agg(F.count("*").alias("n"))
        return by.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"{c}_rows"))

    one = counts.crossJoin(units).crossJoin(tally("reason")).crossJoin(tally("confidence"))  # each is one row
    return one.select(F.to_json(F.struct("*")).alias("document"))


def backtest(months: DataFrame, origins: Sequence[str], horizon: int = 6, min_history: int = 12, demand_shrink: float = 0.5, use_po_share: bool = True) -> DataFrame:
    """(train_end, key, step, target_month, predicted): the replay at past origins, from what was known then.

    Demand is the own seasonal forecast, for the market's has no history. The origin is a column: a
    key's months are collected once and cut at each origin, and habits, medians, shape and share are
    grouped by it, so the plan does not grow with the origins and months is read once.
    """
    use_checkpoints(months.sparkSession)
    held = held_months(months).checkpoint()
    end = F.col("train_end")
    at = held.select("key", "x", F.explode(F.array(*(F.lit(x).cast("date") for x in origins))).alias("train_end"))
    at = at.select("train_end", "key", F.filter("x", lambda r: r["month"] <= end).alias("x")).where(F.size("x") > 0)

    totals = held.select(F.explode("x").alias("r")).where("r.sales is not null").groupBy(F.col("r.month").alias("month")).agg(F.sum("r.sales").alias("units"))  # a row a month
    totals = totals.select("month", "units", F.explode(F.array(*(F.lit(x).cast("date") for x in origins))).alias("train_end")).where(F.col("month") <= end)
    factors = seasonal_factors(totals, demand_shrink, ["train_end"]).groupBy("train_end").agg(F.transform(F.array_sort(F.collect_list(F.struct("month_of_year", "factor"))), lambda f: f["factor"]).alias("f"))

    of_month = lambda day: F.get("f", F.month(day) - 1)
    recent = F.filter("x", lambda r: r["sales"].isNotNull())
    known = F.filter(F.slice("x", F.greatest(F.size("x") - 2, F.lit(1)), F.lit(3)), lambda r: r["stock"].isNotNull())
    rows = at.join(F.broadcast(factors), "train_end").select(  # a row an origin
        "train_end", "key", "f", recent.alias("sold"), F.try_element_at(known, F.lit(-1))["stock"].alias("stock0"), F.coalesce(F.element_at("x", -1)["open_po"], F.lit(0.0)).alias("po0")
    ).where(F.size("sold") >= min_history)
    year = F.slice("sold", F.greatest(F.size("sold") - 11, F.lit(1)), F.lit(12))
    level = total(F.transform(year, lambda r: r["sales"] / F.greatest(of_month(r["month"]), F.lit(0.05)))) / F.size(year)
    rows = rows.select("train_end", "key", "stock0", "po0", "f", level.alias("level"))
    demand = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: F.greatest(F.col("level") * of_month(F.add_months(end, h)), F.lit(0.0)))
    rows = rows.withColumn("d", demand).join(pooled_habits(at, ["train_end"]), ["train_end", "key"])
    rows = rows.join(F.broadcast(shares_by(at, ["train_end"])), "train_end") if use_po_share else rows.withColumn("po_share", F.lit(1.0))  # a row an origin
    rows = rows.withColumn("r", replay(F.col("d"), F.coalesce("stock0", F.lit(0.0)), F.col("po0"), F.col("cover"), F.col("lot"), F.col("po_share")))
    units = F.transform("d", lambda x, i: F.when(F.col("stock0").isNull(), x).otherwise(F.get("r", i)["known"] + F.get("r", i)["new"]))
    flat = rows.select("train_end", "key", F.posexplode(units).alias("pos", "predicted"))
    return flat.select("train_end", "key", (F.col("pos") + 1).alias("step"), F.add_months(end, F.col("pos") + 1).alias("target_month"), "predicted")
