"""How the engine's inputs are read from the star-schema tables, in Spark and in SQL.

Items are parts, units are line quantities, markets are supplier nations, channels are customer
segments; stock and open orders are fixed functions of item and month; reviews are documents with
their labels. Each binding is a DataFrame function and a common table expression of the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions.dates import month_start, week_end
from quarrymill.operators.grid import dense_grid, monthly_series
from quarrymill.session import table

ANCHOR = "2001-08-01"


def sales(spark: SparkSession, d: str) -> DataFrame:
    return monthly_series(table(spark, d, "lineitem"), "l_partkey", "l_shipdate", "l_quantity")


def grid(spark: SparkSession, d: str) -> DataFrame:
    return dense_grid(sales(spark, d))


SALES = """sales AS (SELECT l_partkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(sum(l_quantity) AS DOUBLE) AS units FROM lineitem GROUP BY 1, 2)"""
GRID = SALES + """, bounds AS (SELECT min(month) lo, max(month) hi FROM sales),
months AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds),
firsts AS (SELECT key, min(month) AS first FROM sales GROUP BY 1),
grid AS (SELECT f.key, m.month, coalesce(s.units, 0.0) AS units,
  row_number() OVER (PARTITION BY f.key ORDER BY m.month) AS i, count(*) OVER (PARTITION BY f.key) AS n
  FROM firsts f JOIN months m ON m.month >= f.first LEFT JOIN sales s ON s.key = f.key AND s.month = m.month)"""


def _index(month: Column) -> Column:
    return (F.year(month) * 12 + F.month(month)).cast("long")


def inventory(spark: SparkSession, d: str) -> DataFrame:
    """(key, month, sales, received, stock, open_po) on the grid; stock is null in one month of eleven."""
    line = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("key"), month_start(F.col("l_shipdate")).alias("month"))
    units = F.col("l_quantity").cast("double")
    both = line.agg(F.sum(units).alias("units"), F.sum(F.when(F.col("l_linestatus") == "F", units)).alias("received"))
    i = _index(F.col("month"))
    stock = F.when((F.col("key") + i) % 11 != 0, ((F.col("key") * 7 + i * 13) % 50).cast("double"))
    po = ((F.col("key") * 3 + i * 5) % 40).cast("double")
    return dense_grid(both, carry=("received",)).select("key", "month", F.col("units").alias("sales"), "received", stock.alias("stock"), po.alias("open_po"), "i", "n")


INVENTORY = GRID + """, got AS (SELECT l_partkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(sum(l_quantity) AS DOUBLE) AS received FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
inv AS (SELECT g.key, g.month, g.units AS sales, r.received,
  CASE WHEN (g.key + year(g.month) * 12 + month(g.month)) % 11 <> 0 THEN CAST((g.key * 7 + (year(g.month) * 12 + month(g.month)) * 13) % 50 AS DOUBLE) END AS stock,
  CAST((g.key * 3 + (year(g.month) * 12 + month(g.month)) * 5) % 40 AS DOUBLE) AS open_po, g.i, g.n
  FROM grid g LEFT JOIN got r ON r.key = g.key AND r.month = g.month)"""


def reports(spark: SparkSession, d: str) -> DataFrame:
    """Weekly and monthly rows (market, item, kind, start, end, currency, units); some periods lack their ALL row,
    and in some the ALL row is off by one."""
    line, part = table(spark, d, "lineitem"), F.col("l_shipdate").cast("date")
    base = line.select(F.concat(F.lit("M"), (F.col("l_suppkey") % 5).cast("string")).alias("market"), F.concat(F.lit("P"), (F.col("l_partkey") % 200).cast("string")).alias("item"), part.alias("day"), F.col("l_quantity").cast("double").alias("q"))
    week = base.select("market", "item", F.lit("WEEK").alias("kind"), F.date_sub(week_end(F.col("day")), 6).alias("start"), week_end(F.col("day")).alias("end"), "q")
    month = base.select("market", "item", F.lit("MONTH").alias("kind"), month_start(F.col("day")).alias("start"), F.last_day("day").alias("end"), "q")
    rows = week.unionByName(month)
    items = rows.groupBy("market", "item", "kind", "start", "end").agg(F.sum("q").alias("units"))
    off = (F.dayofyear("start") % 7 == 3).cast("double")
    total = rows.groupBy("market", "kind", "start", "end").agg((F.sum("q")).alias("units")).withColumn("units", F.col("units") + off).where(F.dayofyear("start") % 13 != 5).withColumn("item", F.lit("ALL"))
    both = items.unionByName(total)
    currency = F.when(F.col("market") == "M1", "GBP").when((F.col("market") == "M2") & (F.dayofyear("start") % 2 == 0), "EUR").when(F.col("market") != "M3", "USD")
    return both.withColumn("currency", currency)


REPORTS = """base AS (SELECT 'M' || (l_suppkey % 5) AS market, 'P' || (l_partkey % 200) AS item, CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS DOUBLE) AS q FROM lineitem),
raw AS (SELECT market, item, 'WEEK' AS kind, d - CAST(dayofweek(d) AS INTEGER) AS s, d - CAST(dayofweek(d) AS INTEGER) + 6 AS e, q FROM base
  UNION ALL SELECT market, item, 'MONTH', CAST(date_trunc('month', d) AS DATE), last_day(d), q FROM base),
both_ AS (SELECT market, item, kind, s, e, sum(q) AS units FROM raw GROUP BY ALL
  UNION ALL SELECT market, 'ALL', kind, s, e, sum(q) + CASE WHEN dayofyear(s) % 7 = 3 THEN 1.0 ELSE 0.0 END FROM raw WHERE dayofyear(s) % 13 <> 5 GROUP BY market, kind, s, e),
reports AS (SELECT *, CASE WHEN market = 'M1' THEN 'GBP' WHEN market = 'M2' AND dayofyear(s) % 2 = 0 THEN 'EUR' WHEN market <> 'M3' THEN 'USD' END AS currency FROM both_)"""


def weekly_forecast(spark: SparkSession, d: str) -> DataFrame:
    """(key, version, week_end, mean, p80, p90): weekly sums of a part group, three versions."""
    line = table(spark, d, "lineitem")
    g = line.groupBy((F.col("l_partkey") % 100).alias("key"), week_end(F.col("l_shipdate")).alias("week_end")).agg(F.sum("l_quantity").cast("double").alias("q"))
    v = g.select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("version")).where((F.col("key") + F.col("version") + F.dayofyear("week_end")) % 9 != 0)
    mean = F.col("q") + F.col("version")
    return v.select("key", "version", "week_end", mean.alias("mean"), (mean + F.col("key") % 7).alias("p80"), (mean + F.col("key") % 7 + 2).alias("p90"))


WEEKLY = """wk AS (SELECT l_partkey % 100 AS key, CAST(l_shipdate AS DATE) + 6 - CAST(dayofweek(l_shipdate) AS INTEGER) AS week_end, CAST(sum(l_quantity) AS DOUBLE) AS q FROM lineitem GROUP BY 1, 2),
weekly AS (SELECT key, version, week_end, q + version AS mean, q + version + key % 7 AS p80, q + version + key % 7 + 2 AS p90
  FROM wk, (SELECT unnest([1, 2, 3]) AS version) WHERE (key + version + dayofyear(week_end)) % 9 <> 0)"""


def successors(spark: SparkSession, d: str) -> DataFrame:
    """(old, new, changeover): a part whose key ends in 0 is replaced by the next; of every third of these the next again, or two at once."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k")).where("k % 10 = 0")
    when = F.add_months(F.lit("1998-01-01").cast("date"), (F.col("k") % 24).cast("int"))
    one = p.select(F.col("k").alias("old"), (F.col("k") + 1).alias("new"), when.alias("changeover"))
    chain = p.where("k % 30 = 0").select((F.col("k") + 1).alias("old"), (F.col("k") + 2).alias("new"), when.alias("changeover"))
    split = p.where("k % 40 = 0").select(F.col("k").alias("old"), (F.col("k") + 3).alias("new"), when.alias("changeover"))
    return one.unionByName(chain).unionByName(split)


SUCCESSORS = """succ AS (SELECT p_partkey AS o, p_partkey + 1 AS w, CAST(DATE '1998-01-01' + to_months(CAST(p_partkey % 24 AS INTEGER)) AS DATE) AS c FROM part WHERE p_partkey % 10 = 0
  UNION ALL SELECT p_partkey + 1, p_partkey + 2, CAST(DATE '1998-01-01' + to_months(CAST(p_partkey % 24 AS INTEGER)) AS DATE) FROM part WHERE p_partkey % 30 = 0
  UNION ALL SELECT p_partkey, p_partkey + 3, CAST(DATE '1998-01-01' + to_months(CAST(p_partkey % 24 AS INTEGER)) AS DATE) FROM part WHERE p_partkey % 40 = 0),
families AS (SELECT code, min(family) AS family, min(c) AS changeover, bool_and(is_current) AS is_current FROM (
  SELECT code, fam - fam % 10 AS family, min(c) OVER (PARTITION BY fam - fam % 10) AS c, is_current FROM (
    SELECT o AS code, o AS fam, c, FALSE AS is_current FROM succ UNION ALL SELECT w, w, c, w NOT IN (SELECT o FROM succ) FROM succ)) GROUP BY code)"""


def reviews(spark: SparkSession, d: str) -> DataFrame:
    """(uid, source, kind, sentiment, rating, area, product, themes, day, text, confidence) of every document."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    labels = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    sentiment = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative").otherwise("neutral")
    words = F.array(F.concat(F.lit("Price "), F.col("lang")), F.when(F.col("doc_id") % 3 == 0, "late deliveries").otherwise("delivery late"), F.concat(F.lit("sizes "), (F.col("doc_id") % 4).cast("string")))
    return docs.join(labels, "doc_id", "left").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("uid"), F.when(F.col("doc_id") % 2 == 0, "shop").otherwise("market").alias("source"),
        F.when(F.col("doc_id") % 3 == 0, "service").otherwise("product").alias("kind"), sentiment.alias("sentiment"), (F.col("doc_id") % 5 + 1).cast("int").alias("rating"),
        F.col("source").alias("area"), F.concat(F.lit("p"), (F.col("doc_id") % 37).cast("string")).alias("product"), words.alias("themes"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("day"), "text",
        F.when(F.col("doc_id") % 13 != 0, (F.col("doc_id") * 37 % 101) / 100).alias("confidence"),
    )


REVIEWS = """lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1),
reviews AS (SELECT 'd' || d.doc_id AS uid, CASE WHEN d.doc_id % 2 = 0 THEN 'shop' ELSE 'market' END AS source, CASE WHEN d.doc_id % 3 = 0 THEN 'service' ELSE 'product' END AS kind,
  CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' WHEN quality = 0 THEN 'negative' ELSE 'neutral' END AS sentiment, CAST(d.doc_id % 5 + 1 AS INTEGER) AS rating,
  d.source AS area, 'p' || (d.doc_id % 37) AS product, ['Price ' || lang, CASE WHEN d.doc_id % 3 = 0 THEN 'late deliveries' ELSE 'delivery late' END, 'sizes ' || (d.doc_id % 4)] AS themes,
  DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS day, text, CASE WHEN d.doc_id % 13 <> 0 THEN (d.doc_id * 37 % 101) / 100 END AS confidence FROM documents d LEFT JOIN lab l ON l.doc_id = d.doc_id)"""


def invoices(spark: SparkSession, d: str) -> DataFrame:
    """Invoice lines as text: padded codes, dates of two shapes, quantities with commas; some broken."""
    line = table(spark, d, "lineitem")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    code = F.concat(F.lit(" "), F.when(k % 9 == 0, "X").when(k % 2 == 0, "DN").otherwise("u"), F.col("l_partkey").cast("string"), F.lit("  "))
    shown = F.when(k % 17 == 0, "n/a").when(k % 2 == 0, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(F.concat(F.lit("on "), F.date_format("l_shipdate", "yyyy-MM-dd")))
    q = (F.when(k % 10 == 0, -1).otherwise(1) * F.col("l_quantity").cast("long") * 1000).cast("string")
    q = F.when(k % 19 == 0, " ").otherwise(F.regexp_replace(q, r"(\d)(\d{3})$", "$1,$2"))
    return line.select(code.alias("item"), shown.alias("date"), q.alias("qty"), F.concat(F.lit(" C"), (F.col("l_suppkey") % 4).cast("string")).alias("customer"))


INVOICES = """inv AS (SELECT ' ' || CASE WHEN k % 9 = 0 THEN 'X' WHEN k % 2 = 0 THEN 'DN' ELSE 'u' END || l_partkey || '  ' AS item,
  CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d, CASE WHEN k % 19 = 0 THEN NULL ELSE CASE WHEN k % 10 = 0 THEN -1 ELSE 1 END * l_quantity * 1000 END AS q,
  'C' || (l_suppkey % 4) AS customer, k FROM (SELECT *, l_orderkey + l_linenumber AS k FROM lineitem))"""
