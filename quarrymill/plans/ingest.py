"""Queries on report checks, upserts, versions, invoices and week planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.functions import dates, parsing
from quarrymill.operators import checks, upsert, vendor
from quarrymill.session import table

from .bindings import ANCHOR, INVOICES, REPORTS, WEEKLY, invoices, reports, weekly_forecast
from .registry import query

DAY = lambda c: F.date_format(c, "yyyy-MM-dd")


@query(f"""WITH {REPORTS} SELECT market, kind, strftime(s, '%Y-%m-%d') AS start FROM reports GROUP BY 1, 2, 3 HAVING count(*) FILTER (item = 'ALL') = 0""")
def periods_without_total(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_totals(reports(spark, d)).select("market", "kind", DAY("start").alias("start"))


@query(f"""WITH {REPORTS}, g AS (SELECT market, kind, s, sum(units) FILTER (item = 'ALL') AS t, sum(units) FILTER (item <> 'ALL') AS i FROM reports GROUP BY 1, 2, 3) SELECT market, kind, strftime(s, '%Y-%m-%d') AS start, t AS total, i AS items FROM g WHERE t <> i""")
def totals_that_differ(spark: SparkSession, d: str) -> DataFrame:
    return checks.totals_against_items(reports(spark, d), "units").select("market", "kind", DAY("start").alias("start"), "total", "items")


@query(f"""WITH {REPORTS}, t AS (SELECT * FROM reports WHERE item = 'ALL') SELECT m.market, strftime(m.s, '%Y-%m-%d') AS start, any_value(m.units) AS month_value, sum(w.units) AS week_value, count(w.units) AS weeks FROM t m LEFT JOIN t w ON w.kind = 'WEEK' AND w.market = m.market AND w.e BETWEEN m.s AND m.e WHERE m.kind = 'MONTH' GROUP BY 1, 2""")
def weeks_and_months(spark: SparkSession, d: str) -> DataFrame:
    return checks.weeks_against_months(reports(spark, d), "units").select("market", DAY("start").alias("start"), "month_value", "week_value", "weeks")


@query(f"""WITH {REPORTS}, a AS (SELECT count(*) AS n, count(*) - count(currency) AS c, count(*) - count(units) AS u FROM reports) SELECT unnest(['currency', 'units']) AS "column", unnest([c, u]) AS nulls, n AS "rows" FROM a""")
def report_null_profile(spark: SparkSession, d: str) -> DataFrame:
    return checks.null_profile(reports(spark, d), ["currency", "units"])


@query(f"""WITH {REPORTS}, g AS (SELECT market, count(DISTINCT s) AS months, min(s) AS a, max(s) AS b FROM reports WHERE kind = 'MONTH' GROUP BY 1) SELECT market, months, strftime(a, '%Y-%m-%d') AS first_month, strftime(b, '%Y-%m-%d') AS last_month, datediff('month', a, b) + 1 - months AS gaps FROM g""")
def report_month_coverage(spark: SparkSession, d: str) -> DataFrame:
    return checks.month_coverage(reports(spark, d)).select("market", "months", DAY("first_month").alias("first_month"), DAY("last_month").alias("last_month"), "gaps")


@query(f"""WITH {REPORTS}, g AS (SELECT market, max(e) AS e FROM reports WHERE kind = 'WEEK' GROUP BY 1) SELECT market, strftime(e, '%Y-%m-%d') AS last_end, CAST(DATE '2001-12-20' - e AS INTEGER) AS age FROM g WHERE DATE '2001-12-20' - e > 13""")
def stale_markets(spark: SparkSession, d: str) -> DataFrame:
    return checks.freshness(reports(spark, d).where("kind = 'WEEK'"), "2001-12-20", 13).select("market", DAY("last_end").alias("last_end"), "age")


@query(f"""WITH {REPORTS} SELECT market, string_agg(DISTINCT currency, ' | ' ORDER BY currency) AS currencies FROM reports GROUP BY 1 HAVING count(DISTINCT currency) > 1""")
def mixed_currencies(spark: SparkSession, d: str) -> DataFrame:
    return checks.currencies(reports(spark, d))


@query(f"""WITH {REPORTS} SELECT DISTINCT item FROM reports WHERE item <> 'ALL' AND item NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_partkey % 3 <> 0)""")
def unmapped_items(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "part").where("p_partkey % 3 <> 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("item"))
    return checks.unmapped(reports(spark, d), known, "item")


@query("""WITH f AS (SELECT l_partkey % 100 AS item, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS qty, count(*) AS txns FROM lineitem WHERE (month(l_shipdate) <> 5 OR year(l_shipdate) <> 2000 OR l_orderkey % 3 = 0) GROUP BY 1, 2),
m AS (SELECT month, count(DISTINCT item) AS items, sum(txns) AS txns, sum(qty) AS qty FROM f GROUP BY 1),
w AS (SELECT *, row_number() OVER o AS i, txns / nullif(lag(txns, 12) OVER o, 0) AS yoy, CASE WHEN count(*) OVER (o ROWS BETWEEN 24 PRECEDING AND 13 PRECEDING) = 12 THEN sum(txns) OVER (o ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) / nullif(sum(txns) OVER (o ROWS BETWEEN 24 PRECEDING AND 13 PRECEDING), 0) END AS lv,
  CASE WHEN count(*) OVER (o ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) = 6 THEN median(items) OVER (o ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS ui FROM m WINDOW o AS (ORDER BY month)),
p AS (SELECT f.item, w.i FROM f JOIN w USING (month)), c AS (SELECT w.i, p.item FROM w JOIN p ON p.i BETWEEN w.i - 6 AND w.i - 1 WHERE w.i > 6 GROUP BY 1, 2 HAVING count(*) >= 5),
r AS (SELECT c.i, count(p.item) / count(*) AS cover FROM c LEFT JOIN p ON p.i = c.i AND p.item = c.item GROUP BY 1)
SELECT strftime(month, '%Y-%m') AS ym, items, CAST(txns AS BIGINT) AS txns, round(yoy / lv, 6) AS seasonal_ratio, round(items / ui, 6) AS item_ratio, round(cover, 6) AS regular_cover,
CASE WHEN yoy / lv IS NULL THEN TRUE ELSE NOT (yoy / lv < 0.6 OR coalesce(items / ui < 0.7, FALSE) OR coalesce(cover < 0.75, FALSE)) END AS is_complete FROM w LEFT JOIN r ON r.i = w.i""")
def month_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Two thirds of the lines of one month are left out, to be found."""
    line = table(spark, d, "lineitem").where("month(l_shipdate) <> 5 or year(l_shipdate) <> 2000 or l_orderkey % 3 = 0")
    f = line.groupBy((F.col("l_partkey") % 100).alias("item"), dates.month_start(F.col("l_shipdate")).alias("month")).agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("txns"))
    c = checks.month_completeness(f)
    return c.select(F.date_format("month", "yyyy-MM").alias("ym"), "items", "txns", *(F.round(x, 6).alias(x) for x in ("seasonal_ratio", "item_ratio", "regular_cover")), "is_complete")


@query(f"""WITH b AS (SELECT l_partkey AS item, l_quantity AS q, CASE WHEN l_partkey % 4 = 0 AND l_linenumber > 0 THEN 'big' WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'other' END AS ch, l_shipdate AS s FROM lineitem), g AS (SELECT item, sum(q) AS total, sum(CASE WHEN coalesce(ch, '') = 'big' THEN 0 ELSE q END) AS other FROM b WHERE date_trunc('month', s) <= DATE '{ANCHOR}' AND date_trunc('month', s) > DATE '{ANCHOR}' - INTERVAL 12 MONTH GROUP BY 1) SELECT item, total, other FROM g WHERE total >= 50 AND other < 60 AND total - other >= 0.9 * total""")
def single_channel_items(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    channel = F.when((F.col("l_partkey") % 4 == 0) & (F.col("l_linenumber") > 0), "big").when(F.col("l_suppkey") % 3 != 0, "other")
    rows = line.select(F.col("l_partkey").alias("item"), dates.month_start(F.col("l_shipdate")).alias("month"), F.col("l_quantity").cast("double").alias("qty"), channel.alias("channel"))
    return checks.channel_mismatch(rows, "big", ANCHOR, least_total=50)


_MERGE_T = "SELECT o_orderkey AS k, o_custkey % 10 AS g, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 3 <> 0"
_MERGE_S = "SELECT o_orderkey AS k, o_custkey % 10 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS g, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 2 = 0"


@query(f"""WITH t AS ({_MERGE_T}), s AS ({_MERGE_S}) SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NULL THEN t.g ELSE s.g END AS g, CASE WHEN s.k IS NULL THEN t.status ELSE s.status END AS status,
CASE WHEN t.k IS NULL THEN 'insert' WHEN s.k IS NULL OR (t.g IS NOT DISTINCT FROM s.g AND t.status IS NOT DISTINCT FROM s.status) THEN 'keep' ELSE 'update' END AS action FROM t FULL OUTER JOIN s ON s.k = t.k""")
def merge_changed_rows(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k, status = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status")
    t = o.where(k % 3 != 0).select(k.alias("k"), (F.col("o_custkey") % 10).alias("g"), status)
    s = o.where(k % 2 == 0).select(k.alias("k"), (F.col("o_custkey") % 10 + F.when(k % 7 == 0, 1).otherwise(0)).alias("g"), status)
    return upsert.merge(t, s, ["k"])


@query(f"""WITH {WEEKLY}, a AS (SELECT key, version, week_end, mean FROM weekly WHERE version < 3), b AS (SELECT key, version, week_end, CASE WHEN version = 2 AND key = 5 THEN mean + 1 ELSE mean END AS mean FROM weekly)
SELECT version, CASE WHEN version NOT IN (SELECT version FROM a) THEN 'new' WHEN (SELECT count(*) FROM ((SELECT * FROM a WHERE a.version = v.version) EXCEPT (SELECT * FROM b WHERE b.version = v.version))) = 0 AND (SELECT count(*) FROM ((SELECT * FROM b WHERE b.version = v.version) EXCEPT (SELECT * FROM a WHERE a.version = v.version))) = 0 THEN 'unchanged' ELSE 'replaced' END AS status FROM (SELECT DISTINCT version FROM b) v""")
def forecast_version_status(spark: SparkSession, d: str) -> DataFrame:
    w = weekly_forecast(spark, d).select("key", "version", "week_end", "mean")
    loaded = w.withColumn("mean", F.when((F.col("version") == 2) & (F.col("key") == 5), F.col("mean") + 1).otherwise(F.col("mean")))
    return upsert.version_changes(w.where("version < 3"), loaded, ["version"])


@query(f"""WITH {WEEKLY}, v AS (SELECT DISTINCT key % 3 AS market, version * 10 + key % 2 AS version FROM weekly) SELECT market, version, dense_rank() OVER (PARTITION BY market ORDER BY version) AS version_no, version = max(version) OVER (PARTITION BY market) AS is_latest FROM v""")
def numbered_forecast_versions(spark: SparkSession, d: str) -> DataFrame:
    v = weekly_forecast(spark, d).select((F.col("key") % 3).alias("market"), (F.col("version") * 10 + F.col("key") % 2).alias("version")).distinct()
    return upsert.numbered_versions(v, ["market"], "version")


@query("""SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_event_of_user(spark: SparkSession, d: str) -> DataFrame:
    e = upsert.latest(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])
    return e.select("user_id", "event_id", "event_type", DAY("ts").alias("day"))


@query("""SELECT l_orderkey AS k, CAST(l_suppkey % 10 AS BIGINT) AS s, count(*) AS "rows" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_report_keys(spark: SparkSession, d: str) -> DataFrame:
    return upsert.duplicate_keys(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 10).alias("s")), ["k", "s"])


@query("""SELECT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def rows_not_analysed(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.when(F.col("l_returnflag") == "R", "R").alias("done"))
    return upsert.not_stored(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), done, "k", "done")


@query(f"""WITH {INVOICES}, g AS (SELECT customer, upper(trim(item)) AS item, strftime(d, '%Y-%m') AS ym, coalesce(sum(q) FILTER (q > 0), 0) AS gross, coalesce(-sum(q) FILTER (q < 0), 0) AS credit FROM inv WHERE d IS NOT NULL AND q IS NOT NULL AND k % 9 <> 0 AND customer <> 'C3' GROUP BY 1, 2, 3)
SELECT customer, item, ym, CAST(gross AS DOUBLE) AS gross, CAST(credit AS DOUBLE) AS credit FROM g WHERE gross > 0 OR credit > 0""")
def invoice_months(spark: SparkSession, d: str) -> DataFrame:
    # a generated row is parsed once, whatever reads its columns afterwards
    read = F.inline(F.array(F.struct(parsing.invoice_date(F.col("date")).alias("day"), parsing.quantity(F.col("qty")).alias("q"))))
    inv = invoices(spark, d).select("customer", "item", read)
    ok = inv.where(parsing.is_product_code(F.col("item")) & F.col("day").isNotNull() & F.col("q").isNotNull() & F.trim("customer").isin("C0", "C1", "C2"))
    g = ok.groupBy(F.trim("customer").alias("customer"), F.upper(F.trim("item")).alias("item"), F.date_format("day", "yyyy-MM").alias("ym"))
    return g.agg(F.coalesce(F.sum(F.when(F.col("q") > 0, F.col("q"))), F.lit(0.0)).alias("gross"), F.coalesce(F.sum(F.when(F.col("q") < 0, -F.col("q"))), F.lit(0.0)).alias("credit")).where("gross > 0 or credit > 0")


@query(f"""WITH {INVOICES} SELECT CASE WHEN customer = 'C3' THEN 'customer' WHEN k % 9 = 0 THEN 'item' WHEN d IS NULL THEN 'date' WHEN q IS NULL THEN 'quantity' ELSE 'used' END AS reason, count(*) AS "rows" FROM inv GROUP BY 1""")
def invoice_drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    inv = invoices(spark, d)
    reason = F.when(~F.trim("customer").isin("C0", "C1", "C2"), "customer").when(~parsing.is_product_code(F.col("item")), "item").when(parsing.invoice_date(F.col("date")).isNull(), "date")
    return inv.select(reason.when(parsing.quantity(F.col("qty")).isNull(), "quantity").otherwise("used").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), p AS (SELECT d, d - 5 AS q FROM d) SELECT strftime(d, '%Y-%m-%d') AS day, strftime(q - CAST((dayofweek(q) + 1) % 7 AS INTEGER), '%Y-%m-%d') AS published, CAST(len(list_filter(generate_series(date_trunc('month', d), last_day(d), INTERVAL 1 DAY), lambda x: dayofweek(x) = 6)) AS INTEGER) AS saturdays,
strftime(date_trunc('month', d) - CASE WHEN day(d) > 5 THEN INTERVAL 1 MONTH ELSE INTERVAL 2 MONTH END, '%Y-%m') AS closed, dayofweek(d) = 0 AS starts_week FROM p""")
def report_calendar(spark: SparkSession, d: str) -> DataFrame:
    day = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    c = F.col("d")
    return day.select(
        DAY("d").alias("day"), DAY(dates.latest_published_saturday(c)).alias("published"), dates.n_saturdays(dates.month_start(c)).alias("saturdays"),
        F.date_format(dates.last_closed_month(c), "yyyy-MM").alias("closed"), dates.is_whole_period(F.lit("WEEK"), c, F.date_add(c, 6)).alias("starts_week"),
    )


#: Every line; a market is a supplier and its line's return flag, so weeks without such lines are gaps.
_STORED = "st AS (SELECT DISTINCT l_suppkey || l_returnflag AS market, CAST(l_shipdate AS DATE) + 6 - CAST(dayofweek(l_shipdate) AS INTEGER) AS w FROM lineitem)"


def _stored_weeks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.concat(F.col("l_suppkey").cast("string"), "l_returnflag").alias("market"), dates.week_end(F.col("l_shipdate")).alias("week_end"))


@query(f"""WITH {_STORED}, a AS (SELECT *, CASE WHEN w - lag(w) OVER (PARTITION BY market ORDER BY w) = 7 THEN 0 ELSE 1 END AS nw FROM st), b AS (SELECT *, sum(nw) OVER (PARTITION BY market ORDER BY w) AS run FROM a), c AS (SELECT *, (row_number() OVER (PARTITION BY market, run ORDER BY w) - 1) // 7 AS part FROM b)
SELECT market, strftime(min(w), '%Y-%m-%d') AS first_week, strftime(max(w), '%Y-%m-%d') AS last_week, count(*) AS weeks FROM c GROUP BY market, run, part""")
def week_request_windows(spark: SparkSession, d: str) -> DataFrame:
    return vendor.week_windows(_stored_weeks(spark, d)).select("market", DAY("first_week").alias("first_week"), DAY("last_week").alias("last_week"), "weeks")


@query(f"""WITH {_STORED}, x AS (SELECT DATE '2001-06-30' - 7 * CAST(i AS INTEGER) AS w FROM (SELECT unnest(range(6)) AS i)) SELECT m.market, strftime(x.w, '%Y-%m-%d') AS week_end FROM (SELECT DISTINCT market FROM st) m, x WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.market = m.market AND st.w = x.w)""")
def weeks_still_to_fetch(spark: SparkSession, d: str) -> DataFrame:
    return vendor.weeks_to_fetch(_stored_weeks(spark, d), "2001-06-30").select("market", DAY("week_end").alias("week_end"))


@query("""WITH p AS (SELECT o_custkey AS k, month(o_orderdate) AS m, CAST(sum(o_totalprice) AS DOUBLE) AS v FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1, 2) SELECT k, m AS month_no, round(v, 2) AS qty FROM p""")
def sheet_months_unpivoted(spark: SparkSession, d: str) -> DataFrame:
    """A sheet with twelve month columns, as rows; empty months give none."""
    o = table(spark, d, "orders").where("year(o_orderdate) = 1998").select(F.col("o_custkey").alias("k"), F.month("o_orderdate").alias("m"), F.col("o_totalprice").cast("decimal(18,4)").alias("v"))
    sheet = o.groupBy("k").pivot("m", list(range(1, 13))).agg(F.sum("v"))
    long = sheet.unpivot(["k"], [str(i) for i in range(1, 13)], "month_no", "qty").where("qty is not null")
    return long.select("k", F.col("month_no").cast("int").alias("month_no"), F.round("qty", 2).cast("double").alias("qty"))


@query("""SELECT event_type, count(*) AS "rows", count(TRY_CAST(json_extract_string(props, '$.page') AS VARCHAR)) AS pages, round(sum(value), 4) AS value FROM events GROUP BY 1""")
def event_properties(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("rows"), F.count(F.get_json_object("props", "$.page")).alias("pages"), F.round(F.sum("value"), 4).alias("value"))


_JSON_ROWS = """SELECT 'M' || (l_suppkey % 5) AS market, 'ALL' AS item, sum(l_quantity) AS units, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT 'M' || (l_suppkey % 5), 'P' || (l_partkey % 20), sum(l_quantity), count(*) FROM lineitem GROUP BY 1, 2"""


@query(f"""SELECT market, item, CAST(units AS DOUBLE) AS units, CAST(n AS DOUBLE) AS revenue FROM ({_JSON_ROWS})""")
def flattened_reports(spark: SparkSession, d: str) -> DataFrame:
    """Nested reports, written as JSON and read again: a total object and a list of items."""
    line = table(spark, d, "lineitem").select(F.concat(F.lit("M"), (F.col("l_suppkey") % 5).cast("string")).alias("market"), F.concat(F.lit("P"), (F.col("l_partkey") % 20).cast("string")).alias("asin"), F.col("l_quantity").cast("double").alias("q"))
    items = line.groupBy("market", "asin").agg(F.sum("q").alias("units"), F.count("*").alias("n"))
    item = F.struct("asin", F.lit("2001-01-01").alias("startDate"), F.lit("2001-01-31").alias("endDate"), F.col("units").alias("orderedUnits"), F.struct(F.col("n").alias("amount"), F.lit("USD").alias("currencyCode")).alias("orderedRevenue"))
    whole = F.struct(F.lit("2001-01-01").alias("startDate"), F.lit("2001-01-31").alias("endDate"), F.sum("units").alias("orderedUnits"), F.sum("n").alias("orderedRevenue"))
    json = items.groupBy("market").agg(F.to_json(F.struct(whole.alias("salesAggregate"), F.collect_list(item).alias("salesByAsin"))).alias("json"))
    flat = vendor.flatten_report(json, "salesAggregate", "salesByAsin", {"units": "orderedUnits", "revenue": "orderedRevenue"})
    return flat.select("market", "item", "units", "revenue")


@query(f"""WITH {WEEKLY}, w AS (SELECT key, version, week_end, CASE WHEN key % 5 = 1 AND month(week_end) = 3 THEN NULL ELSE mean END AS mean, mean + key % 7 - CASE WHEN key % 4 = 2 THEN -1 ELSE 3 END AS p70,
  CASE WHEN key % 11 = 3 AND dayofyear(week_end) < 8 THEN -5.0 WHEN key % 6 = 5 THEN NULL ELSE p80 END AS p80, p90, year(week_end) AS y FROM weekly)
SELECT key * 100 + y - 1900 AS key, version, count(*) AS "rows", count(DISTINCT week_end) = 52 AND count(*) = 52 AND max(week_end) - min(week_end) = 357 AS contiguous,
  count(*) FILTER (coalesce(mean, 0) < 0 OR coalesce(p70, 0) < 0 OR coalesce(p80, 0) < 0 OR coalesce(p90, 0) < 0) AS negative, count(*) FILTER (NOT (p70 <= p80 AND p80 <= p90) AND p70 IS NOT NULL AND p80 IS NOT NULL AND p90 IS NOT NULL) AS unordered,
  contiguous AND negative = 0 AND unordered = 0 AS is_valid FROM w GROUP BY key, y, version""")
def valid_forecasts(spark: SparkSession, d: str) -> DataFrame:
    """Every part group's forecast of every year; some values are taken away, negative or out of order."""
    w, key = weekly_forecast(spark, d), F.col("key")
    mean = F.when((key % 5 == 1) & (F.month("week_end") == 3), None).otherwise(F.col("mean"))
    p70 = F.col("mean") + key % 7 - F.when(key % 4 == 2, -1).otherwise(3)
    p80 = F.when((key % 11 == 3) & (F.dayofyear("week_end") < 8), -5.0).when(key % 6 == 5, None).otherwise(F.col("p80"))
    rows = w.select((key * 100 + F.year("week_end") - 1900).alias("key"), "version", "week_end", mean.alias("mean"), p70.alias("p70"), p80.alias("p80"), "p90")
    return checks.forecast_is_valid(rows, 52)


@query(f"""WITH r AS (SELECT p_partkey AS key, p_partkey % 2 = 0 AS s, p_partkey % 3 = 0 AS f, p_partkey % 5 = 0 AS i FROM part) SELECT key, s AS in_sales, f AS in_forecast, i AS in_stock, CASE WHEN s AND f THEN 'forecast' WHEN f THEN 'forecast_only' WHEN s THEN 'sales_only' ELSE 'stock_only' END AS status FROM r WHERE s OR f OR i""")
def item_universe(spark: SparkSession, d: str) -> DataFrame:
    """All items of three tables, with where they are known."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("key"))
    tagged = None
    for name, n in (("in_sales", 2), ("in_forecast", 3), ("in_stock", 5)):
        part = p.where(F.col("key") % n == 0).select("key", *(F.lit(x == name).alias(x) for x in ("in_sales", "in_forecast", "in_stock")))
        tagged = part if tagged is None else tagged.unionByName(part)
    u = tagged.groupBy("key").agg(*(F.bool_or(x).alias(x) for x in ("in_sales", "in_forecast", "in_stock")))
    status = F.when(F.col("in_sales") & F.col("in_forecast"), "forecast").when(F.col("in_forecast"), "forecast_only").when(F.col("in_sales"), "sales_only").otherwise("stock_only")
    return u.withColumn("status", status)


@query("""WITH f AS (SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderkey % 4 AS run, o_totalprice AS y FROM orders), m AS (SELECT run, min(ym) AS first_month FROM f WHERE ym >= '1996-0' || (run // 2 + 1) GROUP BY 1), n AS (SELECT first_month, max(run) AS run FROM m GROUP BY 1) SELECT run, first_month FROM n""")
def delivered_batches(spark: SparkSession, d: str) -> DataFrame:
    """The newest run of each first forecast month."""
    f = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ym"), (F.col("o_orderkey") % 4).alias("run")).where(F.col("ym") >= F.concat(F.lit("1996-0"), F.floor(F.col("run") / 2 + 1).cast("string")))
    first = f.withColumn("first_month", F.min("ym").over(Window.partitionBy("run")))
    return upsert.latest(first.select("run", "first_month").distinct(), ["first_month"], ["run"])
