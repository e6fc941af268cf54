"""Replenishment: ordering habits, open orders, and the monthly stock replay that explains itself.

The replay is a recurrence over a short horizon, so it is a fold over an array of months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import let, middle, total
from ..session import use_checkpoints
from .ordered import exact_medians

EVENT_SHARE, FULL_TRUST = 0.3, 4
COVER_MIN, COVER_MAX, DEFAULT_COVER, DEFAULT_LOT_MONTHS = 0.25, 4.0, 1.0, 3.0
MIN_ORDER_SHARE = 0.25
PO_MIN, PO_MAX = 0.2, 1.0
DEFAULT_RATIOS = (1.25, 1.6)

#: Reason codes in their order; the first nine can decide a number.
REASONS = (
    "YOUNG_PRODUCT_BACKUP", "SALES_ONLY_NO_STOCK", "REORDER_MIN_ORDER_SIZE", "REORDER_TRIGGERED", "PINNED_ORDER",
    "OPEN_PO_DELIVERY", "NO_ORDER_DELAYED", "NO_ORDER_DISCONTINUED", "NO_ORDER_STOCK_COVERS", "DEMAND_AMAZON_BLEND",
    "DEMAND_OWN_NO_AMAZON", "DEMAND_OWN_AMAZON_OFF", "DEMAND_AMAZON_FORECAST", "DEMAND_RECENT_AVERAGE", "DEMAND_OVERRIDE",
    "DEMAND_MULTIPLIER", "HABIT_OWN", "HABIT_BLENDED", "HABIT_POOLED", "HABIT_MARKET_DEFAULT", "HABIT_OVERRIDE",
    "STOCK_OVERRIDE", "OPEN_PO_OVERRIDE", "ORDERS_DELAYED", "DELAY_NOT_APPLIED_NO_STOCK", "DISCONTINUED", "CLIENT_ADJUSTED",
    "HIGH_CASE_ORDER_ONLY", "SEASONALITY_FLAT", "PO_SHARE_DEFAULT", "AMAZON_RATIOS_DEFAULT",
)
LOW = ("YOUNG_PRODUCT_BACKUP", "SALES_ONLY_NO_STOCK", "HABIT_POOLED", "HABIT_MARKET_DEFAULT")
MEDIUM = ("HABIT_BLENDED", "DEMAND_OWN_NO_AMAZON", "DEMAND_OWN_AMAZON_OFF", "SEASONALITY_FLAT")


def held_months(months: DataFrame) -> DataFrame:
    """(key, x): a key's months in order, as structs of month, sales, stock, open_po (where months has it) and got."""
    carried = [c for c in ("month", "sales", "stock", "open_po") if c in months.columns]
    return months.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*carried, F.coalesce("received", F.lit(0.0)).alias("got")))).alias("x"))


def raw_habits(held: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, key, events, lot, cover, per_year, recent_sales) of held_months.

    An order event is a month that receives at least 0.3 of the median positive receipt. cover is the
    median of last month's stock by the month's sales over two events or more, cut to 0.25..4. All are
    folds over a key's months.
    """
    usual = middle(F.filter(F.transform("x", lambda r: r["got"]), lambda g: g > 0))
    seen = F.transform("x", lambda r, i: F.struct(r["got"].alias("got"), r["sales"].alias("sales"), F.get("x", i - 1)["stock"].alias("before")))
    events = let(usual, lambda u: F.filter(seen, lambda e: (e["got"] > 0) & (e["got"] >= EVENT_SHARE * u)))
    sold = F.filter("x", lambda r: r["sales"].isNotNull())
    active = F.months_between(F.element_at("x", -1)["month"], F.get("sold", 0)["month"]) + 1
    year = F.filter(F.transform(F.slice("x", F.greatest(F.size("x") - 11, F.lit(1)), F.lit(12)), lambda r: r["sales"].cast("double")), lambda v: v.isNotNull())
    m = held.select(*by, "key", "x", events.alias("found"), sold.alias("sold"), year.alias("year"))
    ratios = F.filter(F.transform("found", lambda e: F.when(e["before"].isNotNull() & (e["sales"] > 0), e["before"] / e["sales"])), lambda r: r.isNotNull())
    out = m.select(
        *by, "key", F.size("found").cast("long").alias("events"), middle(F.transform("found", lambda e: e["got"])).alias("lot"), ratios.alias("ratios"),
        active.alias("active"), F.try_divide(total(F.col("year")), F.size("year")).alias("recent_sales"),
    )
    return out.select(
        *by, "key", "events", "lot", F.when(F.size("ratios") >= 2, F.least(F.greatest(middle(F.col("ratios")), F.lit(COVER_MIN)), F.lit(COVER_MAX))).alias("cover"),
        F.try_divide(F.col("events") * 12.0, F.col("active")).alias("per_year"), "recent_sales",
    )


def learn_habits(months: DataFrame) -> DataFrame:
    """pooled_habits of a grid (key, month, sales, stock, received)."""
    return pooled_habits(held_months(months))


def pooled_habits(held: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, key, cover, lot, events, per_year, source, own_cover, default_cover, default_lot) of held_months: own habits, drawn
    to the market's median by few events; default_*: the market has no median of it, so a constant serves."""
    use_checkpoints(held.sparkSession)
    raw = raw_habits(held, by).checkpoint()  # a row an item (and group), read twice
    usable = (F.col("events") >= 3) & F.col("lot").isNotNull() & (F.col("recent_sales") > 0)
    pooled = exact_medians(raw, {"c": F.col("cover"), "r": F.when(usable, F.col("lot") / F.col("recent_sales"))}, by)
    w = F.least(F.col("events") / FULL_TRUST, F.lit(1.0))
    m_cover, pooled_lot = F.coalesce("c", F.lit(DEFAULT_COVER)), F.coalesce("r", F.lit(DEFAULT_LOT_MONTHS)) * F.coalesce("recent_sales", F.lit(0.0))
    joined = raw.join(F.broadcast(pooled), list(by), "left") if by else raw.crossJoin(F.broadcast(pooled))  # a row a group, or one
    return joined.select(
        *by, "key", F.when(F.col("cover").isNull(), m_cover).otherwise(w * F.col("cover") + (1 - w) * m_cover).alias("cover"),
        F.greatest(F.when(F.col("lot").isNull(), pooled_lot).otherwise(w * F.col("lot") + (1 - w) * pooled_lot), F.lit(0.0)).alias("lot"),
        "events", "per_year", F.when(F.col("events") == 0, "pooled").when(w >= 1, "own").otherwise("blended").alias("source"),
        F.col("cover").isNotNull().alias("own_cover"), F.col("c").isNull().alias("default_cover"), F.col("r").isNull().alias("default_lot"),
    )


def shares_by(held: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, po_share) of held_months, as po_share has it."""
    pairs = F.filter(F.transform("x", lambda r, i: F.struct(F.get("x", i - 1)["open_po"].alias("po"), r["got"].alias("got"))), lambda p: p["po"] > 0)
    sums = held.select(*by, pairs.alias("p")).select(*by, total(F.transform("p", lambda p: F.least(p["got"], p["po"]))).alias("got"), total(F.transform("p", lambda p: p["po"].cast("double"))).alias("po"))
    g = sums.groupBy(*by).agg(F.sum("got").alias("got"), F.sum("po").alias("po"))
    return g.select(*by, F.coalesce(F.least(F.greatest(F.try_divide("got", F.nullif("po", F.lit(0.0))), F.lit(PO_MIN)), F.lit(PO_MAX)), F.lit(1.0)).alias("po_share"))


def po_share(months: DataFrame) -> DataFrame:
    """One row (po_share): of open orders at a month's end, the share received in the next month, 0.2..1."""
    order = Window.partitionBy("key").orderBy("month")
    m = months.select(F.lag("open_po").over(order).alias("po"), F.coalesce("received", F.lit(0.0)).alias("got")).where("po > 0")
    share = m.agg(F.sum(F.least("got", "po")).alias("got"), F.sum("po").alias("po"))
    return share.select(F.coalesce(F.least(F.greatest(F.try_divide("got", "po"), F.lit(PO_MIN)), F.lit(PO_MAX)), F.lit(1.0)).alias("po_share"))


def replay(demand: Column, stock: Column, open_po: Column, cover: Column, lot: Column, share: Column, *, pinned: Column | None = None, stop_from: Column | None = None, min_order_share: float = MIN_ORDER_SHARE) -> Column:
    """array<struct<step, known, new, po_in, pinned, stock, ordered, floored, blocked>> of the horizon.

    Known inflow is the open orders (share of them in month 1, the rest in month 2) and pinned orders.
    Stock falls by the demand; where it is below cover x next month's demand the gap is ordered, but at
    least min_order_share of the usual lot. stop_from: the step (from 0) that blocks new orders.
    """
    double = lambda c: c.cast("double")
    record = "struct<step:int,known:double,new:double,po_in:double,pinned:double,stock:double,ordered:boolean,floored:boolean,blocked:boolean>"

    def step(acc: Column, h: Column) -> Column:
        now = F.get(demand, h)
        po_in = F.when(h == 0, open_po * share).when(h == 1, open_po * (1 - share)).otherwise(0.0)
        pin = F.coalesce(F.get(pinned, h), F.lit(0.0)) if pinned is not None else F.lit(0.0)
        known = po_in + pin
        left = F.greatest(acc["stock"] - now + known, F.lit(0.0))
        gap = cover * F.coalesce(F.get(demand, h + 1), now) - left
        needed = gap > 1e-9
        blocked = F.coalesce(h >= stop_from, F.lit(False)) if stop_from is not None else F.lit(False)
        size = F.when(needed & ~blocked, F.greatest(gap, min_order_share * lot)).otherwise(0.0)
        row = F.struct(
            h.alias("step"), double(known).alias("known"), double(size).alias("new"), double(po_in).alias("po_in"), double(pin).alias("pinned"), double(left + size).alias("stock"),
            (needed & ~blocked).alias("ordered"), (needed & ~blocked & (min_order_share * lot > gap)).alias("floored"), (needed & blocked).alias("blocked"),
        ).cast(record)
        return F.struct(double(left + size).alias("stock"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    start = F.struct(double(stock).alias("stock"), F.array().cast(f"array<{record}>").alias("rows"))
    return F.aggregate(F.sequence(F.lit(0), F.size(demand) - 1), start, step)["rows"]


def month_reason(r: Column) -> Column:
    """The code that decided a month of a replay, from its record."""
    units = F.bround(r["known"] + r["new"], 2)
    return (
        F.when(units <= 0, F.when(r["blocked"], "NO_ORDER_DISCONTINUED").otherwise("NO_ORDER_STOCK_COVERS"))
        .when(r["floored"], "REORDER_MIN_ORDER_SIZE").when(r["ordered"], "REORDER_TRIGGERED")
        .when(r["pinned"] > 1e-9, "PINNED_ORDER").otherwise("OPEN_PO_DELIVERY")
    )


def in_order(codes: Column) -> Column:
    """Codes in the order of REASONS, joined by '|'."""
    place = F.create_map(*[F.lit(x) for i, c in enumerate(REASONS) for x in (c, i)])
    ranked = F.array_sort(F.transform(F.array_distinct(codes), lambda c: F.struct(place[c].alias("i"), c.alias("c"))))
    return F.array_join(F.transform(ranked, lambda x: x["c"]), "|")


def confidence(codes: Column) -> Column:
    low, medium = (F.array(*map(F.lit, x)) for x in (LOW, MEDIUM))
    return F.when(F.arrays_overlap(codes, low), "LOW").when(F.arrays_overlap(codes, medium), "MEDIUM").otherwise("HIGH")


def weekly_to_monthly(weekly: DataFrame, shrink: float = 1.0, min_coverage: float = 0.5) -> DataFrame:
    """(key, month, mean, p80, p90, coverage) of the newest version of a weekly forecast.

    weekly: (key, version, week_end, mean, p80, p90). A week belongs to the month of its Saturday; a
    month with some of its Saturdays is scaled up from min_coverage on; shrink draws the percentiles in.
    """
    from quarrymill.functions.dates import month_start, n_saturdays

    newest = weekly.agg(F.max("version").alias("newest"))
    w = weekly.crossJoin(F.broadcast(newest)).where("version = newest")  # one row
    g = w.groupBy("key", month_start(F.col("week_end")).alias("month")).agg(F.sum("mean").alias("mean"), F.sum("p80").alias("p80"), F.sum("p90").alias("p90"), F.countDistinct("week_end").alias("weeks"))
    g = g.withColumn("coverage", F.least(F.col("weeks") / n_saturdays(F.col("month")), F.lit(1.0))).where(F.col("coverage") >= min_coverage)
    mean = F.col("mean") / F.col("coverage")
    up = lambda c: mean + shrink * F.greatest(F.col(c) / F.col("coverage") - mean, F.lit(0.0))
    return g.select("key", "month", mean.alias("mean"), up("p80").alias("p80"), up("p90").alias("p90"), "coverage")


def uplift_ratios(monthly: DataFrame) -> DataFrame:
    """One row (r80, r90): median percentile by mean, or the defaults."""
    ok = monthly.where("mean > 0")
    found = exact_medians(ok, {"a": F.col("p80") / F.col("mean"), "b": F.col("p90") / F.col("mean")})
    return found.select(F.coalesce("a", F.lit(DEFAULT_RATIOS[0])).alias("r80"), F.coalesce("b", F.lit(DEFAULT_RATIOS[1])).alias("r90"))


def scenarios(own: DataFrame, market: DataFrame, weight: float) -> DataFrame:
    """(key, month, mean, p80, p90): own forecasts (key, month, own) blended with the market's at a weight."""
    use_checkpoints(own.sparkSession)
    market = market.checkpoint()  # read for the ratios and for the join
    joined = own.join(market, ["key", "month"], "left").crossJoin(F.broadcast(uplift_ratios(market)))  # one row
    o = F.greatest("own", F.lit(0.0))
    blend = F.col("mean").isNotNull() & F.lit(weight > 0)
    base = F.when(blend, weight * F.col("mean") + (1 - weight) * o).otherwise(o)
    p80 = F.greatest(F.when(blend, base + weight * (F.col("p80") - F.col("mean"))).otherwise(o * F.col("r80")), base)
    p90 = F.greatest(F.when(blend, base + weight * (F.col("p90") - F.col("mean"))).otherwise(o * F.col("r90")), p80)
    return joined.select("key", "month", base.alias("mean"), p80.alias("p80"), p90.alias("p90"))


def fit_first_month(months: DataFrame, least_rows: int = 50) -> DataFrame:
    """One row (a, b, n): received = a * open order before + b * sales, no intercept, not negative.

    The normal equations of two features, from five sums; (0, 1) with too few rows.
    """
    order = Window.partitionBy("key").orderBy("month")
    m = months.select(F.lag("open_po").over(order).alias("x"), F.col("sales").alias("z"), F.coalesce("received", F.lit(0.0)).alias("y")).where("x is not null and z is not null")
    s = m.agg(*(F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in ("xx", "xz", "zz", "xy", "zy")), F.count("*").alias("n"))
    det = F.nullif(F.col("xx") * F.col("zz") - F.col("xz") * F.col("xz"), F.lit(0.0))
    a = F.greatest(F.try_divide(F.col("xy") * F.col("zz") - F.col("zy") * F.col("xz"), det), F.lit(0.0))
    b = F.greatest(F.try_divide(F.col("zy") * F.col("xx") - F.col("xy") * F.col("xz"), det), F.lit(0.0))
    few = (F.col("n") < least_rows) | det.isNull()
    return s.select(F.when(few, 0.0).otherwise(a).alias("a"), F.when(few, 1.0).otherwise(b).alias("b"), "n")


def adjust(demand: DataFrame, changes: DataFrame) -> DataFrame:
    """demand (key, month, units) after changes (key, month, kind, value, line): multipliers multiply,
    the last override wins and comes first; also the columns multiplier and override."""
    factor = F.aggregate(F.collect_list(F.when(F.col("kind") == "demand_multiplier", F.col("value"))), F.lit(1.0), lambda a, x: a * x)
    c = changes.groupBy("key", "month").agg(factor.alias("multiplier"), F.max_by(F.when(F.col("kind") == "demand_override", F.col("value")), F.when(F.col("kind") == "demand_override", F.col("line"))).alias("override"))
    joined = demand.join(c, ["key", "month"], "left")
    return joined.withColumn("adjusted", F.coalesce("override", F.col("units")) * F.coalesce("multiplier", F.lit(1.0)))


def sanity(forecast: DataFrame, grid: DataFrame, low: float = 0.5, high: float = 1.6) -> DataFrame:
    """One row (ratio, is_sane): the forecast by the last year's pace of the same series."""
    w = Window.partitionBy("key").orderBy(F.col("month").desc())
    pace = grid.where("units is not null").withColumn("r", F.row_number().over(w)).where("r <= 12").groupBy("key").agg(F.avg("units").alias("pace"))
    total = forecast.groupBy("key").agg(F.sum("predicted").alias("total"), F.count("*").alias("steps")).join(pace, "key")
    out = total.agg(F.try_divide(F.sum("total"), F.nullif(F.sum(F.col("pace") * F.col("steps")), F.lit(0.0))).alias("ratio"))
    return out.withColumn("is_sane", F.coalesce(F.col("ratio").between(low, high), F.lit(False)))


def simple_cover(months: DataFrame, least: int = 3, low: float = 0.5, high: float = 4.0) -> DataFrame:
    """(key, cover): median stock by sales over at least `least` months, cut to low..high."""
    ratio = F.when(F.col("stock").isNotNull() & (F.col("sales") > 0), F.col("stock") / F.col("sales"))
    g = months.groupBy("key").agg(F.count(ratio).alias("n"), F.median(ratio).alias("r"))
    return g.where(F.col("n") >= least).select("key", F.least(F.greatest("r", F.lit(low)), F.lit(high)).alias("cover"))


def simple_orders(demand: Column, stock: Column, open_po: Column, cover: Column) -> Column:
    """array<double>: orders that bring stock to cover x demand each month; open orders arrive in month 1."""

    def step(acc: Column, h: Column) -> Column:
        now = F.get(demand, h)
        left = acc["stock"] - now + F.when(h == 0, open_po).otherwise(0.0)
        order = F.greatest(cover * now - left, F.lit(0.0))
        return F.struct(F.greatest(left + order, F.lit(0.0)).cast("double").alias("stock"), F.concat(acc["orders"], F.array(order.cast("double"))).alias("orders"))

    start = F.struct(stock.cast("double").alias("stock"), F.array().cast("array<double>").alias("orders"))
    return F.aggregate(F.sequence(F.lit(0), F.size(demand) - 1), start, step)["orders"]


def blend_open_orders(forecast: DataFrame, months: DataFrame, fit: DataFrame) -> DataFrame:
    """forecast (key, step, predicted) with the first step replaced by the fitted blend of open orders and
    forecast, where the key's newest month has a reading of open orders."""
    newest = months.where("i = n and open_po is not null").select("key", "open_po")
    j = forecast.join(newest, "key", "left").crossJoin(F.broadcast(fit.select("a", "b")))  # one row
    first = (F.col("step") == 1) & F.col("open_po").isNotNull()
    return j.select("key", "step", F.when(first, F.col("a") * F.col("open_po") + F.col("b") * F.col("predicted")).otherwise(F.col("predicted")).alias("predicted"))
