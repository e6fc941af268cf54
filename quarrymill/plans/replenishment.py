"""Queries on ordering habits, the stock replay, scenarios and adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators import adjustments, forecast, grid, replenish
from quarrymill.operators import plan as planning
from quarrymill.session import table, use_checkpoints

from .bindings import ANCHOR, INVENTORY, WEEKLY, inventory, weekly_forecast
from .bindings import grid as month_grid
from .registry import query

R6 = lambda c: F.round(c, 6)

_HABITS = f"""{INVENTORY}, m AS (SELECT *, coalesce(received, 0) AS got, lag(stock) OVER (PARTITION BY key ORDER BY month) AS sb, row_number() OVER (PARTITION BY key ORDER BY month DESC) AS back FROM inv),
u AS (SELECT key, median(got) AS usual FROM m WHERE got > 0 GROUP BY 1),
e AS (SELECT m.*, got > 0 AND got >= 0.3 * usual AS ev, CASE WHEN got > 0 AND got >= 0.3 * usual AND sb IS NOT NULL AND sales > 0 THEN sb / sales END AS r FROM m LEFT JOIN u ON u.key = m.key),
raw AS (SELECT key, count(*) FILTER (ev) AS events, median(got) FILTER (ev) AS lot, CASE WHEN count(r) >= 2 THEN least(greatest(median(r), 0.25), 4) END AS cover, count(*) FILTER (ev) * 12.0 / count(*) AS per_year, avg(sales) FILTER (back <= 12) AS recent FROM e GROUP BY 1),
mk AS (SELECT coalesce(median(cover), 1) AS mc, coalesce(median(lot / recent) FILTER (events >= 3 AND recent > 0), 3) AS mr FROM raw),
habits AS (SELECT key, events, per_year, CASE WHEN cover IS NULL THEN mc ELSE least(events / 4, 1) * cover + (1 - least(events / 4, 1)) * mc END AS cover,
  greatest(CASE WHEN lot IS NULL THEN mr * coalesce(recent, 0) ELSE least(events / 4, 1) * lot + (1 - least(events / 4, 1)) * mr * coalesce(recent, 0) END, 0) AS lot,
  CASE WHEN events = 0 THEN 'pooled' WHEN events >= 4 THEN 'own' ELSE 'blended' END AS source FROM raw, mk)"""


@query(f"""WITH {_HABITS} SELECT key, events, round(per_year, 6) AS per_year, round(cover, 6) AS cover, round(lot, 6) AS lot, source FROM habits""")
def ordering_habits(spark: SparkSession, d: str) -> DataFrame:
    h = replenish.learn_habits(inventory(spark, d))
    return h.select("key", "events", R6("per_year").alias("per_year"), R6("cover").alias("cover"), R6("lot").alias("lot"), "source")


_SHARE = """p AS (SELECT lag(open_po) OVER (PARTITION BY key ORDER BY month) AS po, coalesce(received, 0) AS got FROM inv),
share AS (SELECT least(greatest(sum(least(got, po)) / sum(po), 0.2), 1) AS po_share FROM p WHERE po > 0)"""


@query(f"""WITH {INVENTORY}, {_SHARE} SELECT round(po_share, 6) AS po_share FROM share""")
def open_order_share(spark: SparkSession, d: str) -> DataFrame:
    return replenish.po_share(inventory(spark, d)).select(R6("po_share").alias("po_share"))


_DEMAND = """dm AS (SELECT key, avg(sales) FILTER (back <= 6) AS lv FROM m GROUP BY 1),
st AS (SELECT key, coalesce(max(stock) FILTER (back = 1), max(stock) FILTER (back = 2), max(stock) FILTER (back = 3)) AS stock0, max(open_po) FILTER (back = 1) AS po0 FROM m GROUP BY 1)"""


@query(f"""WITH RECURSIVE {_HABITS}, {_SHARE}, {_DEMAND},
start AS (SELECT h.key, cover, lot, lv, stock0, po0, po_share FROM habits h JOIN dm USING (key) JOIN st USING (key), share WHERE stock0 IS NOT NULL),
walk AS (SELECT key, -1 AS step, cover, lot, lv, po0, po_share, stock0::DOUBLE AS stock, 0.0::DOUBLE AS known, 0.0::DOUBLE AS new, FALSE AS ordered, FALSE AS floored FROM start
  UNION ALL SELECT key, step, cover, lot, lv, po0, po_share, lft + CASE WHEN gap > 1e-9 THEN greatest(gap, 0.25 * lot) ELSE 0 END, k, CASE WHEN gap > 1e-9 THEN greatest(gap, 0.25 * lot) ELSE 0 END, gap > 1e-9, gap > 1e-9 AND 0.25 * lot > gap FROM (
    SELECT *, cover * (lv * (1 + 0.1 * (CASE WHEN step < 5 THEN step + 1 ELSE step END))) - lft AS gap FROM (
      SELECT key, step + 1 AS step, cover, lot, lv, po0, po_share, k, greatest(stock - lv * (1 + 0.1 * (step + 1)) + k, 0) AS lft FROM (
        SELECT *, CASE WHEN step = -1 THEN po0 * po_share WHEN step = 0 THEN po0 * (1 - po_share) ELSE 0 END AS k FROM walk WHERE step < 5))))
SELECT key, CAST(step AS INTEGER) AS step, round(known + 1e-9, 4) AS known, round(new + 1e-9, 4) AS new, round(stock + 1e-9, 4) AS stock, ordered, floored FROM walk WHERE step >= 0""")
def stock_replay(spark: SparkSession, d: str) -> DataFrame:
    """Six months of replay; demand is the mean of the last six months, a tenth higher each month."""
    use_checkpoints(spark)
    inv = inventory(spark, d).checkpoint()  # habits, stock and share read it
    back = inv.withColumn("back", F.col("n") - F.col("i") + 1)
    known = back.withColumn("known_stock", grid.last_known(F.col("stock"))).groupBy("key").agg(
        F.avg(F.when(F.col("back") <= 6, F.col("sales"))).alias("level"), F.max(F.when(F.col("back") == 1, F.col("known_stock"))).alias("stock"), F.max(F.when(F.col("back") == 1, F.col("open_po"))).alias("open_po")
    )
    rows = replenish.learn_habits(inv).join(known, "key").crossJoin(F.broadcast(replenish.po_share(inv))).where("stock is not null")  # po_share is one row
    demand = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda h: F.col("level") * (1 + 0.1 * h))
    made = rows.withColumn("demand", demand).select("key", F.explode(replenish.replay(F.col("demand"), F.col("stock"), F.col("open_po"), F.col("cover"), F.col("lot"), F.col("po_share"))).alias("r"))
    return made.select("key", "r.step", *(F.round(F.col(f"r.{c}") + 1e-9, 4).alias(c) for c in ("known", "new", "stock")), "r.ordered", "r.floored")


@query(f"""WITH RECURSIVE {_HABITS}, b AS (SELECT h.key, source, cover, lot, sales + 1 AS dm, coalesce(stock, 0) AS st, open_po FROM habits h JOIN inv ON inv.key = h.key AND inv.i = inv.n),
walk AS (SELECT key, source, cover, lot, dm, open_po, -1 AS step, st::DOUBLE AS stock, 0.0::DOUBLE AS units, FALSE AS ordered, FALSE AS floored, FALSE AS blocked FROM b
  UNION ALL SELECT key, source, cover, lot, dm, open_po, step, lft + new, k + new, new > 0, new > 0 AND 0.25 * lot > gap, gap > 1e-9 AND NOT go FROM (
    SELECT *, CASE WHEN gap > 1e-9 AND go THEN greatest(gap, 0.25 * lot) ELSE 0 END AS new FROM (SELECT *, cover * dm - lft AS gap, key % 10 <> 0 OR step < 1 AS go FROM (
      SELECT key, source, cover, lot, dm, open_po, step, k, greatest(stock - dm + k, 0) AS lft FROM (
        SELECT key, source, cover, lot, dm, open_po, stock, step + 1 AS step, CASE step WHEN -1 THEN open_po * 0.6 WHEN 0 THEN open_po * 0.4 ELSE 0 END AS k FROM walk WHERE step < 3))))),
r AS (SELECT key, step, source, CASE WHEN round_even(units, 2) <= 0 THEN CASE WHEN blocked THEN 'NO_ORDER_DISCONTINUED' ELSE 'NO_ORDER_STOCK_COVERS' END WHEN floored THEN 'REORDER_MIN_ORDER_SIZE' WHEN ordered THEN 'REORDER_TRIGGERED' ELSE 'OPEN_PO_DELIVERY' END AS reason FROM walk WHERE step >= 0)
SELECT key, CAST(step AS INTEGER) AS step, reason, reason || '|DEMAND_OWN_NO_AMAZON|HABIT_' || upper(source) AS detail, CASE WHEN source = 'pooled' THEN 'LOW' ELSE 'MEDIUM' END AS confidence FROM r""")
def replay_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Why each month of the replay orders or does not, with a discontinued tenth of the items, and the confidence."""
    inv = inventory(spark, d)
    last = inv.where("i = n").select("key", F.col("sales").alias("level"), F.coalesce("stock", F.lit(0.0)).alias("stock"), "open_po")
    rows = replenish.learn_habits(inv).join(last, "key")
    demand = F.array_repeat(F.col("level") + 1, 4)
    stop = F.when(F.col("key") % 10 == 0, 1)
    made = rows.withColumn("demand", demand).select("key", "source", F.explode(replenish.replay(F.col("demand"), F.col("stock"), F.col("open_po"), F.col("cover"), F.col("lot"), F.lit(0.6), stop_from=stop)).alias("r"))
    habit = F.when(F.col("source") == "own", "HABIT_OWN").when(F.col("source") == "blended", "HABIT_BLENDED").otherwise("HABIT_POOLED")
    coded = made.withColumn("codes", F.array(replenish.month_reason(F.col("r")), F.lit("DEMAND_OWN_NO_AMAZON"), habit))
    return coded.select("key", "r.step", replenish.month_reason(F.col("r")).alias("reason"), replenish.in_order(F.col("codes")).alias("detail"), replenish.confidence(F.col("codes")).alias("confidence"))


_MONTHLY = f"""{WEEKLY}, nw AS (SELECT * FROM weekly WHERE version = (SELECT max(version) FROM weekly)),
mg AS (SELECT key, CAST(date_trunc('month', week_end) AS DATE) AS month, sum(mean) AS mean, sum(p80) AS p80, sum(p90) AS p90, count(DISTINCT week_end) AS weeks FROM nw GROUP BY 1, 2),
mc AS (SELECT *, least(weeks / len(list_filter(generate_series(month, last_day(month), INTERVAL 1 DAY), lambda x: dayofweek(x) = 6)), 1) AS coverage FROM mg),
mon AS (SELECT key, month, mean / coverage AS mean, mean / coverage + 0.5 * greatest(p80 / coverage - mean / coverage, 0) AS p80, mean / coverage + 0.5 * greatest(p90 / coverage - mean / coverage, 0) AS p90, coverage FROM mc WHERE coverage >= 0.5)"""


@query(f"""WITH {_MONTHLY} SELECT key, strftime(month, '%Y-%m') AS ym, round(mean, 6) AS mean, round(p80, 6) AS p80, round(p90, 6) AS p90, round(coverage, 6) AS coverage FROM mon""")
def monthly_from_weekly(spark: SparkSession, d: str) -> DataFrame:
    m = replenish.weekly_to_monthly(weekly_forecast(spark, d), 0.5)
    return m.select("key", F.date_format("month", "yyyy-MM").alias("ym"), *(R6(c).alias(c) for c in ("mean", "p80", "p90", "coverage")))


@query(f"""WITH {_MONTHLY} SELECT round(median(p80 / mean), 6) AS r80, round(median(p90 / mean), 6) AS r90 FROM mon WHERE mean > 0""")
def percentile_uplift(spark: SparkSession, d: str) -> DataFrame:
    u = replenish.uplift_ratios(replenish.weekly_to_monthly(weekly_forecast(spark, d), 0.5))
    return u.select(R6("r80").alias("r80"), R6("r90").alias("r90"))


@query(f"""WITH {_MONTHLY}, r AS (SELECT median(p80 / mean) AS r80, median(p90 / mean) AS r90 FROM mon WHERE mean > 0),
own AS (SELECT l_partkey % 150 AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) / 2 AS own FROM lineitem GROUP BY 1, 2),
x AS (SELECT o.key, o.month, CASE WHEN m.mean IS NOT NULL THEN 0.4 * m.mean + 0.6 * own ELSE own END AS b, CASE WHEN m.mean IS NOT NULL THEN 0.4 * m.mean + 0.6 * own + 0.4 * (p80 - mean) ELSE own * r80 END AS y, CASE WHEN m.mean IS NOT NULL THEN 0.4 * m.mean + 0.6 * own + 0.4 * (p90 - mean) ELSE own * r90 END AS z FROM own o LEFT JOIN mon m ON m.key = o.key AND m.month = o.month, r)
SELECT key, strftime(month, '%Y-%m') AS ym, round(b, 5) AS mean, round(greatest(y, b), 5) AS p80, round(greatest(z, y, b), 5) AS p90 FROM x""")
def demand_scenarios(spark: SparkSession, d: str) -> DataFrame:
    from quarrymill.functions.dates import month_start

    own = table(spark, d, "lineitem").groupBy((F.col("l_partkey") % 150).alias("key"), month_start(F.col("l_shipdate")).alias("month")).agg((F.sum("l_quantity") / 2).alias("own"))
    s = replenish.scenarios(own, replenish.weekly_to_monthly(weekly_forecast(spark, d), 0.5), 0.4)
    return s.select("key", F.date_format("month", "yyyy-MM").alias("ym"), *(F.round(c, 5).alias(c) for c in ("mean", "p80", "p90")))


@query(f"""WITH {INVENTORY}, p AS (SELECT lag(open_po) OVER (PARTITION BY key ORDER BY month) AS x, sales AS z, coalesce(received, 0) AS y FROM inv),
s AS (SELECT sum(x * x) AS xx, sum(x * z) AS xz, sum(z * z) AS zz, sum(x * y) AS xy, sum(z * y) AS zy, count(*) AS n FROM p WHERE x IS NOT NULL)
SELECT round(greatest((xy * zz - zy * xz) / (xx * zz - xz * xz), 0), 6) AS a, round(greatest((zy * xx - xy * xz) / (xx * zz - xz * xz), 0), 6) AS b, n FROM s""")
def first_month_fit(spark: SparkSession, d: str) -> DataFrame:
    return replenish.fit_first_month(inventory(spark, d)).select(R6("a").alias("a"), R6("b").alias("b"), "n")


@query(f"""WITH {INVENTORY}, a AS (SELECT key, strftime(month, '%Y-%m') AS ym, sales, CASE WHEN key % 5 = 0 THEN 1.5 * (CASE WHEN i % 2 = 0 THEN 0.8 ELSE 1 END) END AS m, CASE WHEN key % 7 = 0 AND i % 3 = 0 THEN 20.0 END AS o FROM inv)
SELECT key, ym, sales AS units, round(coalesce(o, sales) * coalesce(m, 1), 6) AS adjusted FROM a""")
def adjusted_demand(spark: SparkSession, d: str) -> DataFrame:
    """Multipliers on every fifth item (a second one in even months) and overrides, of which the last line wins."""
    inv = inventory(spark, d)
    cut = lambda on, kind, value, line: inv.where(on).select("key", "month", F.lit(kind).alias("kind"), F.lit(value).alias("value"), F.lit(line).alias("line"))
    changes = cut("key % 5 = 0", "demand_multiplier", 1.5, 1).unionByName(cut("key % 5 = 0 and i % 2 = 0", "demand_multiplier", 0.8, 2))
    changes = changes.unionByName(cut("key % 7 = 0 and i % 3 = 0", "demand_override", 10.0, 3)).unionByName(cut("key % 7 = 0 and i % 3 = 0", "demand_override", 20.0, 4))
    a = replenish.adjust(inv.select("key", "month", F.col("sales").alias("units")), changes)
    return a.select("key", F.date_format("month", "yyyy-MM").alias("ym"), "units", R6("adjusted").alias("adjusted"))


@query(f"""WITH {INVENTORY}, s AS (SELECT key, month, stock, last_value(stock IGNORE NULLS) OVER (PARTITION BY key ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS known FROM inv) SELECT key, strftime(month, '%Y-%m') AS ym, stock, known FROM s""")
def last_known_stock(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).select("key", F.date_format("month", "yyyy-MM").alias("ym"), "stock", grid.last_known(F.col("stock")).alias("known"))


@query(f"""WITH {INVENTORY}, h AS (SELECT key, avg(sales) FILTER (i > n - 12) AS pace, least(n, 3) AS k, avg(sales) FILTER (i > n - 3) AS m3, count(*) AS c FROM inv GROUP BY key, n) SELECT round(sum(m3 * 6) / sum(pace * 6), 6) AS ratio, sum(m3 * 6) / sum(pace * 6) BETWEEN 0.5 AND 1.6 AS is_sane FROM h WHERE c >= 12""")
def forecast_sanity(spark: SparkSession, d: str) -> DataFrame:
    g = month_grid(spark, d)
    s = replenish.sanity(forecast.forecast(forecast.histories(g), 6, ["mean3"]), g)
    return s.select(R6("ratio").alias("ratio"), "is_sane")


def _ahead(spark: SparkSession, d: str) -> DataFrame:
    """The market's forecast, two months later, so that it covers months after the anchor."""
    return weekly_forecast(spark, d).withColumn("week_end", F.add_months("week_end", 2))


def _entered(spark: SparkSession, d: str) -> DataFrame:
    """An adjustments table as people enter it, from the parts: one or two lines for every seventh part."""
    p = table(spark, d, "part").where("p_size % 7 = 0").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("z"))
    kind = F.element_at(F.array(*map(F.lit, adjustments.TYPES)), (F.col("k") % 9 + 1).cast("int"))
    month = F.when((F.col("k") % 2 == 0) | (kind == "pinned_order"), F.concat(F.lit("2001-1"), (F.col("k") % 3).cast("string"), F.lit("-15"))).otherwise("")
    value = F.when(kind == "discontinue", "").when(kind == "delay_orders", (F.col("k") % 3).cast("string")).when(kind == "demand_multiplier", "1.25").otherwise(F.concat(F.lit("1,"), F.lpad((F.col("z") * 20).cast("string"), 3, "0")))
    first = p.select(F.lit("").alias("marketplace"), F.concat(F.lit(" "), F.col("k").cast("string")).alias("asin"), month.alias("month_start"), kind.alias("type"), value.alias("value"), F.when(F.col("z") > 30, "by hand").otherwise("").alias("note"), F.lit("").alias("valid_until"), (F.col("k") * 2).alias("line"))
    second = first.where("type = 'demand_multiplier' or type = 'pinned_order'").withColumn("line", F.col("line") + 1).withColumn("value", F.lit("2"))
    return first.unionByName(second)


_ENTERED = """k AS (SELECT p_partkey AS k, p_size AS z, ['demand_multiplier', 'demand_override', 'pinned_order', 'stock_override', 'open_po_override', 'cover_override', 'lot_override', 'discontinue', 'delay_orders'][p_partkey % 9 + 1] AS t FROM part WHERE p_size % 7 = 0),
one AS (SELECT k, z, t, k * 2 AS line, CASE WHEN k % 2 = 0 OR t = 'pinned_order' THEN '2001-1' || (k % 3) END AS m, CASE WHEN t = 'discontinue' THEN NULL WHEN t = 'delay_orders' THEN k % 3 WHEN t = 'demand_multiplier' THEN 1.25 ELSE 1000 + z * 20 END AS v FROM k),
lines AS (SELECT * FROM one UNION ALL SELECT k, z, t, line + 1, m, 2 FROM one WHERE t IN ('demand_multiplier', 'pinned_order'))"""


@query(f"""WITH {_ENTERED}, g AS (SELECT *, CASE WHEN v IS NULL THEN '' WHEN v = 1.25 THEN ' 1.25' ELSE ' ' || CAST(CAST(v AS BIGINT) AS VARCHAR) END AS n FROM lines)
SELECT CAST(k AS VARCHAR) AS key, string_agg(t || coalesce(' ' || m, '') || n || CASE WHEN z > 30 THEN ' (by hand)' ELSE '' END, '; ' ORDER BY line) AS notes, CAST(max(CASE WHEN t = 'delay_orders' THEN v ELSE 0 END) AS INTEGER) AS delay,
  max(CASE WHEN t = 'stock_override' THEN v END)::DOUBLE AS stock, min(CASE WHEN t = 'discontinue' THEN CASE WHEN m IS NULL THEN 0 ELSE CAST(right(m, 2) AS INTEGER) - 9 END END) AS stop_from, coalesce(sum(CASE WHEN t = 'pinned_order' AND m = '2001-11' THEN v END), 0)::DOUBLE AS pinned_third FROM g GROUP BY k""")
def adjustments_by_item(spark: SparkSession, d: str) -> DataFrame:
    """What entered lines mean for each item over six months from September 2001."""
    rows = adjustments.usable_adjustments(adjustments.read_adjustments(_entered(spark, d)), "UK", "2001-09-01")
    a = adjustments.by_item(rows, "2001-09-01", 6)
    return a.select("key", "notes", "delay", "stock", "stop_from", F.get("pinned", F.lit(2)).alias("pinned_third"))


def _origin_sql(origin: str, horizon: int) -> str:
    """The replay at one origin, as a query over the months up to it."""
    habits = _HABITS.replace("inv AS (", "inv_all AS (", 1).replace(", m AS (", f", inv AS (SELECT * FROM inv_all WHERE month <= DATE '{origin}'), m AS (", 1)
    return f"""WITH RECURSIVE {habits}, {_SHARE}, tt AS (SELECT month, sum(sales) AS u FROM inv GROUP BY 1),
ma AS (SELECT month, u / ((lag(u, 6) OVER w + 2 * sum(u) OVER (ORDER BY month ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + lead(u, 6) OVER w) / 24) AS r FROM tt WINDOW w AS (ORDER BY month)),
f0 AS (SELECT month(month) AS mo, avg(r) AS f FROM ma WHERE r IS NOT NULL GROUP BY 1), f AS (SELECT mo, 1 + 0.5 * (f / (SELECT avg(f) FROM f0) - 1) AS f FROM f0),
hh AS (SELECT key, sales, month(month) AS mo, row_number() OVER (PARTITION BY key ORDER BY month DESC) AS r, count(*) OVER (PARTITION BY key) AS c FROM inv),
lv AS (SELECT key, avg(sales / greatest(f, 0.05)) AS lv FROM hh JOIN f USING (mo) WHERE r <= 12 AND c >= 12 GROUP BY 1),
st AS (SELECT key, coalesce(max(stock) FILTER (back = 1), max(stock) FILTER (back = 2), max(stock) FILTER (back = 3)) AS stock0, coalesce(max(open_po) FILTER (back = 1), 0) AS po0 FROM m GROUP BY 1),
dd AS (SELECT l.key, s.h, greatest(lv * f, 0) AS d FROM lv l, (SELECT unnest(range({horizon})) AS h) s JOIN f ON f.mo = month(DATE '{origin}' + to_months(CAST(s.h + 1 AS INTEGER)))),
arr AS (SELECT key, list(d ORDER BY h) AS ds FROM dd GROUP BY 1), start AS (SELECT a.key, ds, cover, lot, stock0, po0, po_share FROM arr a JOIN habits h USING (key) JOIN st USING (key), share),
walk AS (SELECT key, ds, cover, lot, stock0, po0, po_share, -1 AS step, coalesce(stock0, 0)::DOUBLE AS stock, 0.0::DOUBLE AS units FROM start
  UNION ALL SELECT key, ds, cover, lot, stock0, po0, po_share, step, lft + new, k + new FROM (SELECT *, CASE WHEN gap > 1e-9 THEN greatest(gap, 0.25 * lot) ELSE 0 END AS new FROM (
    SELECT *, cover * coalesce(ds[step + 2], ds[step + 1]) - lft AS gap FROM (SELECT *, greatest(stock - ds[step + 1] + k, 0) AS lft FROM (
      SELECT key, ds, cover, lot, stock0, po0, po_share, stock, step + 1 AS step, CASE step WHEN -1 THEN po0 * po_share WHEN 0 THEN po0 * (1 - po_share) ELSE 0 END AS k FROM walk WHERE step < {horizon - 1})))))
SELECT '{origin}' AS train_end, key, CAST(step + 1 AS INTEGER) AS step, round(CASE WHEN stock0 IS NULL THEN ds[step + 1] ELSE units END + 1e-9, 4) AS predicted FROM walk WHERE step >= 0"""


_ORIGINS = ("1999-12-01", "2000-03-01", "2000-06-01", "2000-09-01", "2001-02-01")


@query(" UNION ALL ".join(f"SELECT * FROM ({_origin_sql(o, 3)})" for o in _ORIGINS))
def replay_backtest(spark: SparkSession, d: str) -> DataFrame:
    """The replay at past origins, from what was known then."""
    use_checkpoints(spark)
    inv = inventory(spark, d).checkpoint()
    out = planning.backtest(inv, _ORIGINS, 3)
    return out.select(F.date_format("train_end", "yyyy-MM-dd").alias("train_end"), "key", "step", F.round(F.col("predicted") + 1e-9, 4).alias("predicted"))


_STATUS = f"""{INVENTORY}, {WEEKLY}, pa AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY month DESC) AS back FROM inv WHERE month <= DATE '{ANCHOR}'),
s AS (SELECT key, count(*) AS history, sum(sales) AS sold, sum(sales) FILTER (back <= 12) AS last12, min(month) AS first_month, count(stock) FILTER (back <= 3) > 0 AS has_stock FROM pa GROUP BY 1),
nw AS (SELECT key, CAST(week_end + INTERVAL 2 MONTH AS DATE) AS week_end FROM weekly WHERE version = (SELECT max(version) FROM weekly)),
mc AS (SELECT key, CAST(date_trunc('month', week_end) AS DATE) AS month, count(DISTINCT week_end) AS weeks FROM nw GROUP BY 1, 2),
am AS (SELECT key, count(*) AS amazon_months FROM mc WHERE month > DATE '{ANCHOR}' AND month <= DATE '{ANCHOR}' + INTERVAL 4 MONTH AND least(weeks / len(list_filter(generate_series(month, last_day(month), INTERVAL 1 DAY), lambda x: dayofweek(x) = 6)), 1) >= 0.5 GROUP BY 1),
u AS (SELECT coalesce(s.key, n.key) AS key, s.* EXCLUDE (key), n.key IS NOT NULL AS in_market FROM s FULL JOIN (SELECT DISTINCT key FROM nw) n ON n.key = s.key),
st AS (SELECT u.*, coalesce(amazon_months, 0) AS amazon_months, CASE WHEN history >= 12 OR (history >= 3 AND sold > 0) THEN 'FORECAST' WHEN history > 0 AND sold <= 0 THEN 'NO_SALES' WHEN history > 0 THEN 'SHORT_HISTORY' ELSE 'AMAZON_FORECAST_ONLY' END AS status FROM u LEFT JOIN am ON am.key = u.key),
dec AS (SELECT *, CASE WHEN status <> 'FORECAST' THEN status WHEN history < 12 THEN 'YOUNG_PRODUCT_BACKUP' WHEN has_stock THEN 'REPLAY' ELSE 'SALES_ONLY_NO_STOCK' END AS reason_code FROM st)"""


def _decided(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    use_checkpoints(spark)
    inv, weekly = inventory(spark, d).checkpoint(), _ahead(spark, d)
    made = planning.plan(inv, weekly, ANCHOR, 4, 0.4).checkpoint()
    return made, planning.decisions(made, inv, weekly, ANCHOR, 4)


@query(f"""WITH {_STATUS} SELECT key, status, reason_code, coalesce(history, 0) AS months_of_history, amazon_months > 0 AS has_amazon_forecast, coalesce(has_stock, FALSE) AS has_stock_data, amazon_months, strftime(first_month, '%Y-%m-%d') AS first_sales_month, coalesce(last12, 0.0) AS last12_units FROM dec""")
def plan_decisions(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d)[1].drop("confidence", "basis", "habit_source", "forecast_units")


@query(f"""WITH {_STATUS} SELECT count(*) FILTER (history > 0) AS asins_in_sales, count(*) FILTER (status = 'FORECAST') AS asins_forecast, count(*) FILTER (reason_code = 'YOUNG_PRODUCT_BACKUP') AS young_product_backups, count(*) FILTER (status = 'SHORT_HISTORY') AS skipped_short_history,
  count(*) FILTER (status = 'FORECAST' AND amazon_months = 0) AS asins_without_amazon_forecast, count(*) FILTER (status = 'FORECAST' AND NOT has_stock) AS sales_only_asins, 4 * count(*) FILTER (status = 'FORECAST') AS rows_planned FROM dec""")
def plan_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a run, read from its JSON summary."""
    document = planning.summary(*_decided(spark, d))
    fields = ("asins_in_sales", "asins_forecast", "young_product_backups", "skipped_short_history", "asins_without_amazon_forecast", "sales_only_asins")
    rows = F.aggregate(F.map_values(F.from_json(F.get_json_object("document", "$.reason_rows"), "map<string,bigint>")), F.lit(0).cast("long"), lambda a, x: a + x)
    return document.select(*(F.get_json_object("document", f"$.{c}").cast("long").alias(c) for c in fields), rows.alias("rows_planned"))


@query()
def replenishment_plan(spark: SparkSession, d: str) -> DataFrame:
    """The whole forecast of orders with entered adjustments: demand, market blend, habits, three replays, reasons and confidence."""
    use_checkpoints(spark)
    rows = adjustments.usable_adjustments(adjustments.read_adjustments(_entered(spark, d)), "UK", "2001-09-01")
    p = planning.plan(inventory(spark, d).checkpoint(), _ahead(spark, d), ANCHOR, 4, 0.4, adjustments=rows)
    return p.withColumn("month", F.date_format("month", "yyyy-MM"))
