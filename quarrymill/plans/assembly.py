"""Queries on assembled tables: comparisons, coverage, answer keys, audits, stores and parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import dates, parsing, text
from quarrymill.operators import assembly, families, forecast, trend_model, upsert
from quarrymill.session import table, use_checkpoints

from .bindings import GRID, INVENTORY, REVIEWS, SALES, SUCCESSORS, inventory, reviews, successors
from .bindings import grid as month_grid
from .bindings import sales as month_sales
from .demand import _FOLDS, _predictions
from .registry import query

R6 = lambda c: F.round(c, 6)
R4 = lambda c: F.round(F.col(c) + 1e-9, 4).alias(c)
YM = lambda c: F.date_format(c, "yyyy-MM")

def known_changeovers(spark: SparkSession, d: str) -> DataFrame:
    """(key) of parts that a dated changeover names, old or new."""
    dated = successors(spark, d).where("changeover is not null")
    return dated.select(F.explode(F.array("old", "new")).alias("key")).distinct()


#: A planning sheet: what customers of a nation ordered by clerk's month, as rows of year and month name.
_SHEET = """sheet AS (SELECT CAST(o_custkey AS VARCHAR) AS item, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(o_totalprice) AS DOUBLE) AS qty FROM orders GROUP BY 1, 2)"""


def _sheet(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").cast("string").alias("item"), F.year("o_orderdate").cast("string").alias("year"), F.date_format("o_orderdate", "MMMM").alias("month_name"), F.col("o_totalprice").alias("qty"))


@query(f"""WITH {_SHEET} SELECT item, month, round(qty, 2) AS qty FROM sheet""")
def sheet_quantities(spark: SparkSession, d: str) -> DataFrame:
    return assembly.sheet_by_month(_sheet(spark, d)).select("item", "month", F.round("qty", 2).alias("qty"))


@query(f"""WITH {_SHEET}, scope AS (SELECT CAST(c_custkey AS VARCHAR) AS item FROM customer WHERE c_mktsegment = 'BUILDING'), months AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS month FROM lineitem),
c AS (SELECT month, count(DISTINCT item) AS sheet_items, count(DISTINCT item) FILTER (item IN (SELECT item FROM scope)) AS covered FROM sheet GROUP BY 1), n AS (SELECT count(*) AS in_scope FROM scope)
SELECT m.month, coalesce(sheet_items, 0) AS sheet_items, coalesce(covered, 0) AS covered, in_scope, round(100 * coalesce(covered, 0) / in_scope, 1) AS coverage_pct, CASE WHEN coalesce(covered, 0) > 0 THEN 'OK' ELSE 'EMPTY: no sheet rows for ' || m.month END AS status
FROM months m LEFT JOIN c ON c.month = m.month, n""")
def sheet_coverage(spark: SparkSession, d: str) -> DataFrame:
    scope = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("item"))
    months = table(spark, d, "lineitem").select(YM("l_shipdate").alias("month"))
    return assembly.sheet_coverage(assembly.sheet_by_month(_sheet(spark, d)), months, scope)


@query("""WITH raw AS (SELECT CAST(l_partkey AS VARCHAR) AS item, n_name AS region FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_discount > 0.05),
rg AS (SELECT item, min(region) AS region, count(DISTINCT region) > 1 AS region_is_multi FROM raw GROUP BY 1),
rt AS (SELECT CAST(o_custkey AS VARCHAR) AS item, arg_min(o_orderpriority, o_orderkey) AS rating FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
ms AS (SELECT CAST(p_partkey AS VARCHAR) AS item, p_name AS name, p_type AS category, p_brand AS family FROM part)
SELECT coalesce(rg.item, rt.item, ms.item) AS item, region, region_is_multi, rating, name, category, family FROM rg FULL JOIN rt ON rt.item = rg.item FULL JOIN ms ON ms.item = coalesce(rg.item, rt.item)""")
def reference_columns(spark: SparkSession, d: str) -> DataFrame:
    line, supplier, nation = (table(spark, d, t) for t in ("lineitem", "supplier", "nation"))
    raw = line.where("l_discount > 0.05").join(supplier, F.col("s_suppkey") == F.col("l_suppkey")).join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    rating = table(spark, d, "orders").select(F.col("o_custkey").alias("item"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(" nan ").alias("rating"), F.col("o_orderkey").alias("line"))
    master = table(spark, d, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_brand").alias("family"), F.col("p_partkey").alias("line"))
    return assembly.reference_columns(raw.select(F.col("l_partkey").alias("item"), F.concat(F.lit(" "), "n_name").alias("region")), rating, master)


@query(f"""WITH {SALES}, t AS (SELECT key AS item, strftime(month, '%Y-%m') AS month, month AS m, units AS actual FROM sales WHERE month > DATE '2000-12-01'),
e AS (SELECT t.item, t.month, CASE WHEN t.item % 3 = 0 THEN 'Naive-3mo' ELSE 'Prophet' END AS model, p_brand AS region, CASE WHEN p_size > 25 THEN 'A' END AS rating, actual, a.units AS model_forecast, b.units * 2 AS sheet_forecast, c.units AS prior_year_forecast
  FROM t LEFT JOIN part ON p_partkey = t.item LEFT JOIN sales a ON a.key = t.item AND a.month = t.m - INTERVAL 1 MONTH LEFT JOIN sales b ON b.key = t.item AND b.month = t.m - INTERVAL 2 MONTH LEFT JOIN sales c ON c.key = t.item AND c.month = t.m - INTERVAL 12 MONTH),
r AS (SELECT *, round(100 * abs(actual - model_forecast) / nullif(actual, 0), 6) AS model_error, round(100 * abs(actual - sheet_forecast) / nullif(actual, 0), 6) AS sheet_error, round(100 * abs(actual - prior_year_forecast) / nullif(actual, 0), 6) AS prior_year_error FROM e)
SELECT *, CASE WHEN model_error IS NULL AND sheet_error IS NULL AND prior_year_error IS NULL THEN NULL WHEN model_error <= coalesce(sheet_error, 1e300) AND model_error <= coalesce(prior_year_error, 1e300) THEN 'model' WHEN sheet_error <= coalesce(prior_year_error, 1e300) THEN 'sheet' ELSE 'prior_year' END AS winner FROM r""")
def forecast_comparison(spark: SparkSession, d: str) -> DataFrame:
    s = month_sales(spark, d).withColumnRenamed("key", "item")
    shifted = lambda n: s.select("item", YM(F.add_months("month", n)).alias("month"), F.col("units").alias("qty"))
    test = s.where("month > '2000-12-01'").select("item", YM("month").alias("month"), F.when(F.col("item") % 3 == 0, "Naive-3mo").alias("model"), F.col("units").alias("actual"))
    test = test.join(shifted(1).withColumnRenamed("qty", "model_forecast"), ["item", "month"], "left")
    sheet = shifted(2).unionByName(shifted(2))  # two planners enter the same
    part = table(spark, d, "part")
    ratings = part.where("p_size > 25").select(F.col("p_partkey").alias("item"), F.lit("A").alias("rating"))
    return assembly.comparison(test, sheet, ratings, s.select("item", YM("month").alias("month"), "units"), part.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("region")))


@query(f"""WITH {SALES}, s AS (SELECT CAST(key AS VARCHAR) AS item, month, units FROM sales), a AS (SELECT item, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, units AS yhat FROM s WHERE month >= DATE '2000-12-01'),
b AS (SELECT item, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, units AS yhat FROM s WHERE month >= DATE '2000-01-01' AND month < DATE '2000-09-01'), common AS (SELECT item FROM a INTERSECT SELECT item FROM b), ms AS (SELECT DISTINCT month FROM a WHERE month <= DATE '2001-06-01'),
x AS (SELECT 'a' AS t, item, month, yhat FROM a UNION ALL SELECT 'b', item, month, yhat FROM b),
k AS (SELECT x.*, coalesce(s.units, 0) AS u FROM x LEFT JOIN s ON s.item = x.item AND s.month = x.month WHERE x.item IN (SELECT item FROM common) AND x.month IN (SELECT month FROM ms)),
g AS (SELECT t, sum(u) AS actual, round(100 * sum(abs(yhat - u)) / sum(u), 1) AS wape, round(100 * sum(yhat - u) / sum(u), 1) AS bias FROM k GROUP BY 1), z AS (SELECT t, count(*) FILTER (y = 0) AS zero FROM (SELECT t, item, sum(yhat) AS y FROM k GROUP BY 1, 2) GROUP BY 1)
SELECT ga.actual, ga.wape AS wape_a, ga.bias AS bias_a, za.zero AS zero_items_a, (SELECT count(DISTINCT item) FROM a) AS items_a, gb.wape AS wape_b, gb.bias AS bias_b, zb.zero AS zero_items_b, (SELECT count(DISTINCT item) FROM b) AS items_b, (SELECT count(*) FROM common) AS items_scored, (SELECT count(*) FROM ms) AS months, round(ga.wape - gb.wape, 1) AS wape_gain
FROM g ga, g gb, z za, z zb WHERE ga.t = 'a' AND gb.t = 'b' AND za.t = 'a' AND zb.t = 'b'""")
def two_runs_compared(spark: SparkSession, d: str) -> DataFrame:
    """Last month's units against those of a year ago, as two forecasts of the same months."""
    s = month_sales(spark, d).select(F.col("key").cast("string").alias("item"), "month", "units")
    ahead = lambda rows, n: rows.select("item", F.add_months("month", n).alias("month"), F.col("units").alias("yhat"))
    return assembly.compare_runs(ahead(s.where("month >= '2000-12-01'"), 1), ahead(s.where("month >= '2000-01-01' and month < '2000-09-01'"), 12), s, "2001-06-01")


_BLOCK = """SELECT '{key}' AS answer_key, 'item-month' AS level, method, count(*) AS "rows", round(sum(abs(predicted - coalesce(u, 0))) / sum(coalesce(u, 0)), 6) AS wape, round(sum(predicted - coalesce(u, 0)) / sum(coalesce(u, 0)), 6) AS bias FROM pred p LEFT JOIN {table} r ON r.key = p.key AND r.month = p.target_month GROUP BY method"""
_TOTAL = """SELECT '{key}' AS answer_key, 'market-month' AS level, method, count(*) AS "rows", round(sum(abs(p - coalesce(a, 0))) / sum(coalesce(a, 0)), 6) AS wape, round(sum(p - coalesce(a, 0)) / sum(coalesce(a, 0)), 6) AS bias FROM tp LEFT JOIN (SELECT month, sum(u) AS a FROM {table} GROUP BY 1) x ON x.month = tp.target_month GROUP BY method"""


@query(f"""WITH {_FOLDS}, so AS (SELECT key, month, units AS u FROM sales), re AS (SELECT l_partkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(sum(l_quantity) AS DOUBLE) AS u FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
iv AS (SELECT o_custkey AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(count(*) AS DOUBLE) * 100 AS u FROM orders GROUP BY 1, 2), tp AS (SELECT method, train_end, target_month, sum(predicted) AS p FROM pred GROUP BY ALL)
{_BLOCK.format(key='sellout', table='so')} UNION ALL {_BLOCK.format(key='receipts', table='re')} UNION ALL {_TOTAL.format(key='sellout', table='so')} UNION ALL {_TOTAL.format(key='receipts', table='re')} UNION ALL {_TOTAL.format(key='invoices', table='iv')}""")
def scores_by_answer_key(spark: SparkSession, d: str) -> DataFrame:
    received = inventory(spark, d).where("received is not null").select("key", "month", F.col("received").alias("units"))
    invoiced = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key"), dates.month_start(F.col("o_orderdate")).alias("month")).agg((F.count("*").cast("double") * 100).alias("units"))
    out = assembly.score_against_keys(_predictions(spark, d), month_sales(spark, d), received, invoiced)
    return out.select("answer_key", "level", "method", "rows", R6("wape").alias("wape"), R6("bias").alias("bias"))


@query("""SELECT 'outside' AS method, '2000-12' AS train_end, strftime(l_shipdate, '%Y-%m') AS target_month, CAST(datediff('month', DATE '2000-12-01', l_shipdate) AS INTEGER) AS step, CAST(l_partkey AS VARCHAR) AS key, greatest(round(l_quantity - 20, 4), 0) AS predicted
FROM lineitem WHERE l_linenumber <> 2 AND datediff('month', DATE '2000-12-01', l_shipdate) BETWEEN 1 AND 6""")
def external_forecasts(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    value = F.when(F.col("l_linenumber") == 2, "n/a").otherwise((F.col("l_quantity") - 20).cast("string"))
    raw = line.select(F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("series_id"), dates.month_start(F.col("l_shipdate")).alias("ds"), value.alias("y_predicted"))
    out = assembly.external_predictions(raw, "2000-12-01", 6, "outside")
    return out.select("method", YM("train_end").alias("train_end"), YM("target_month").alias("target_month"), "step", "key", F.round("predicted", 4).alias("predicted"))


@query(f"""WITH {_FOLDS}, {SUCCESSORS}, w AS (SELECT s.key AS item, s.month, s.units AS actual, a.units AS routed, b.units AS sheet FROM sales s LEFT JOIN sales a ON a.key = s.key AND a.month = s.month - INTERVAL 1 MONTH LEFT JOIN sales b ON b.key = s.key AND b.month = s.month - INTERVAL 2 MONTH WHERE s.month > DATE '2000-12-01' AND s.month <= DATE '2001-06-01'),
h AS (SELECT w.*, CASE WHEN item % 10 = 1 THEN 0.5 ELSE 1.0 END AS split_ratio FROM w WHERE sheet IS NOT NULL),
c AS (SELECT key, target_month AS month, method, predicted FROM pred WHERE train_end = DATE '2000-12-01'),
f AS (SELECT h.*, method AS candidate, predicted * split_ratio AS y FROM h JOIN c ON c.key = h.item - h.item % 10 AND c.month = h.month),
u AS (SELECT item, month, candidate, actual, sheet, split_ratio, y FROM f UNION ALL SELECT item, month, 'blend', actual, sheet, split_ratio, 0.5 * routed + 0.5 * y FROM f WHERE candidate = 'mean12' AND routed IS NOT NULL
  UNION ALL SELECT item, month, 'routed', actual, sheet, split_ratio, routed FROM h WHERE routed IS NOT NULL UNION ALL SELECT item, month, 'sheet', actual, sheet, split_ratio, sheet FROM h)
SELECT candidate, count(*) AS "rows", round(sum(abs(y - actual)) / sum(actual), 6) AS wape, round(sum(y * split_ratio), 3) AS weighted FROM u GROUP BY 1""")
def held_out_window(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of tens of items (families) split to their items, beside delivered and planned quantities."""
    s = month_sales(spark, d)
    shifted = lambda n, name: s.select("key", F.add_months("month", n).alias("month"), F.col("units").alias(name))
    window = s.where("month > '2000-12-01' and month <= '2001-06-01'").join(shifted(1, "routed"), ["key", "month"], "left").join(shifted(2, "sheet"), ["key", "month"], "left")
    window = window.select(F.col("key").alias("item"), (F.col("key") - F.col("key") % 10).alias("family"), "month", F.col("units").alias("actual"), "routed", "sheet")
    candidates = _predictions(spark, d).where("train_end = '2000-12-01'").select(F.col("key").alias("family"), "method", F.col("target_month").alias("month"), "predicted")
    ratios = s.where("key % 10 = 1").select(F.col("key").alias("item")).distinct().withColumn("ratio", F.lit(0.5))
    out = assembly.window_rows(window, candidates, ratios)
    error = F.try_divide(F.sum(F.abs(F.col("yhat_raw") - F.col("actual"))), F.sum("actual"))
    return out.groupBy("candidate").agg(F.count("*").alias("rows"), R6(error).alias("wape"), F.round(F.sum(F.col("yhat_raw") * F.col("split_ratio")), 3).alias("weighted"))


@query(f"""WITH {REVIEWS}, k AS (SELECT day, sentiment, list_distinct(['lang ' || split_part(themes[1], ' ', 2), themes[3]]) AS keys FROM reviews), p AS (SELECT *, CASE WHEN day >= DATE '2024-09-01' THEN 'recent' ELSE 'earlier' END AS part FROM k),
t AS (SELECT DISTINCT unnest(keys) AS theme FROM p), n AS (SELECT part, count(*) AS reviews FROM p GROUP BY 1), m AS (SELECT part, theme, count(*) AS mentions FROM (SELECT part, unnest(keys) AS theme FROM p WHERE sentiment = 'negative') GROUP BY 1, 2),
j AS (SELECT t.theme, x.part, coalesce(reviews, 0) AS reviews, coalesce(mentions, 0) AS mentions FROM t CROSS JOIN (VALUES ('recent'), ('earlier')) x(part) LEFT JOIN n ON n.part = x.part LEFT JOIN m ON m.theme = t.theme AND m.part = x.part)
SELECT theme, part, reviews, mentions, round(100.0 * mentions / nullif(reviews, 0), 1) AS share_pct, reviews < 20 AS small_sample, sum(mentions) OVER (PARTITION BY theme) < 5 AS few_mentions FROM j""")
def theme_trend(spark: SparkSession, d: str) -> DataFrame:
    rows = reviews(spark, d)
    keys = F.array_distinct(F.array(F.concat(F.lit("lang "), F.split(F.get("themes", F.lit(0)), " ")[1]), F.get("themes", F.lit(2))))
    rows = rows.select("day", "sentiment", F.filter(keys, lambda x: x.isNotNull()).alias("keys"))
    return assembly.theme_trend(rows, rows.select(F.explode("keys").alias("theme")), F.lit("2024-09-01").cast("date"))


@query(f"""WITH {GRID}, l AS (SELECT key, count(*) AS months, regr_intercept(units, i) + regr_slope(units, i) * max(n) AS e, sum(units) FILTER (i > n - 6) / 6 AS m6, sum(units) FILTER (i > n - 12) / 12 AS m12 FROM grid GROUP BY 1 HAVING count(*) >= 12)
SELECT key, months, round(e + 1e-9, 4) AS trend_at_end, round(m6 + 1e-9, 4) AS mean6, round(m12 + 1e-9, 4) AS mean12, round(100 * (e - m6) / nullif(abs(m6), 0) + 1e-9, 4) AS pct_diff, CASE WHEN m6 <> 0 THEN abs(100 * (e - m6) / m6) > 30 ELSE abs(e) > 0 END AS disconnected FROM l""")
def trend_audit(spark: SparkSession, d: str) -> DataFrame:
    g = month_grid(spark, d).where("n >= 12")
    out = assembly.trend_audit(g, assembly.line_trend(g))
    return out.select("key", "months", R4("trend_at_end"), R4("mean6"), R4("mean12"), R4("pct_diff"), "disconnected")


@query(f"""WITH {GRID}, y AS (SELECT key, year(month) AS y, avg(units) AS lv FROM grid WHERE n >= 24 GROUP BY 1, 2 HAVING count(*) = 12 AND avg(units) > 0),
f AS (SELECT g.key, month(month) AS mo, avg(units / lv) AS f FROM grid g JOIN y ON y.key = g.key AND y.y = year(month) GROUP BY 1, 2) SELECT key, round(min(100 * (f - 1)) + 1e-9, 4) AS min_pct, round(max(100 * (f - 1)) + 1e-9, 4) AS max_pct FROM f GROUP BY 1""")
def seasonal_swing(spark: SparkSession, d: str) -> DataFrame:
    out = assembly.seasonal_swing(assembly.series_seasonality(month_grid(spark, d)))
    return out.select("key", R4("min_pct"), R4("max_pct"))


@query("""WITH c AS (SELECT c_nationkey AS k, string_agg(DISTINCT c_mktsegment || '_' || (c_custkey % 90), '|' ORDER BY c_mktsegment || '_' || (c_custkey % 90)) AS detail FROM customer GROUP BY 1)
SELECT k, CASE WHEN length(detail) <= 120 THEN detail ELSE regexp_replace(left(detail, 120), '\\|[^|]*$', '') END AS detail FROM c""")
def trimmed_code_lists(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat_ws("_", "c_mktsegment", (F.col("c_custkey") % 90).cast("string"))
    by = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.array_join(F.array_sort(F.collect_set(code)), "|").alias("detail"))
    return by.select("k", text.trim_codes(F.col("detail"), 120).alias("detail"))


@query("""SELECT 'good' AS side, trim(k) AS key FROM (SELECT ' ' || p_type || ' ' AS k FROM part) WHERE length(trim(k)) = 10 UNION ALL SELECT 'bad', trim(k) FROM (SELECT ' ' || p_type || ' ' AS k FROM part) WHERE length(trim(k)) <> 10""")
def keys_by_length(spark: SparkSession, d: str) -> DataFrame:
    good, bad = upsert.split_keys(table(spark, d, "part").select(F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("key")), "key")
    return good.select(F.lit("good").alias("side"), "key").unionByName(bad.select(F.lit("bad").alias("side"), "key"))


@query("""SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'translated' END, d.lang) AS lang, d.source FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id""")
def filled_translations(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q")).select("doc_id", F.when(F.col("q") == 1, "translated").alias("lang"))
    return upsert.fill_column(table(spark, d, "documents").select("doc_id", "lang", "source"), new, "doc_id", ["lang"])


@query("""SELECT o_orderkey AS k, CAST(trunc(o_totalprice) AS INTEGER) AS whole, CAST(round_even(CAST(o_totalprice AS DECIMAL(18, 6)), 1) AS DECIMAL(18, 1)) AS money, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS cleaned, o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 AS truthy,
CASE WHEN o_orderstatus = 'F' THEN 'Order f' WHEN o_orderstatus = 'O' THEN 'Order o' ELSE 'Order ' || lower(o_orderstatus) END AS label, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def typed_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of an export as text, read back: numbers, decimals, blanks, truth values, labels and days."""
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(
        k.alias("k"), F.col("o_totalprice").cast("string").alias("price"), F.when(k % 3 == 0, F.when(k % 2 == 0, " NaN ").otherwise("none")).otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))).alias("name"),
        F.when(k % 3 == 0, F.when(k % 2 == 0, "0").otherwise("")).when(k % 2 == 0, "yes").otherwise("No").alias("flag"), F.concat(F.lit("order_"), F.lower("o_orderstatus")).alias("status"), F.date_format("o_orderdate", "'on' dd/MM/yyyy").alias("shown"),
    )
    return o.select(
        "k", parsing.whole_number(F.col("price")).alias("whole"), parsing.typed_decimal(F.col("price"), 18, 1).alias("money"), parsing.clean_text(F.col("name")).alias("cleaned"),
        parsing.truth(F.col("flag")).alias("truthy"), parsing.readable(F.col("status")).alias("label"), F.date_format(parsing.invoice_date(F.col("shown")), "yyyy-MM-dd").alias("day"),
    )


@query(f"""WITH {SALES}, {SUCCESSORS}, c AS (SELECT family, code FROM families WHERE is_current), r AS (SELECT family, code, 1.0 / count(*) OVER (PARTITION BY family) AS ratio FROM c),
t AS (SELECT key, sum(units) AS predicted FROM sales GROUP BY 1) SELECT t.key, coalesce(r.code, t.key) AS item, round(predicted * coalesce(ratio, 1), 6) AS predicted FROM t LEFT JOIN r ON r.family = t.key""")
def forecast_split_to_codes(spark: SparkSession, d: str) -> DataFrame:
    members = families.resolve(successors(spark, d)).where("is_current")
    ratios = members.join(members.groupBy("family").agg(F.count("*").alias("n")), "family").select("family", "code", (1.0 / F.col("n")).alias("ratio"))
    totals = month_sales(spark, d).groupBy("key").agg(F.sum("units").alias("predicted"))
    return families.split_forecast(totals, ratios).select("key", "item", R6("predicted").alias("predicted"))


@query(f"""WITH {GRID}, b AS (SELECT key, max(n) AS n FROM grid GROUP BY 1), o AS (SELECT key, unnest(generate_series(12, CAST(n AS BIGINT) - 6, 6)) AS train FROM b WHERE n >= 18) SELECT train, count(*) AS series FROM o GROUP BY 1""")
def rolling_origins(spark: SparkSession, d: str) -> DataFrame:
    """How many series each train length of a rolling back-test has."""
    n = month_grid(spark, d).groupBy("key").agg(F.max("n").alias("n"))
    longest = n.agg(F.max("n")).first()[0] or 0
    lengths = spark.createDataFrame([(x,) for x in forecast.origins(longest, 12, 6, 6)], "train long")
    return n.join(F.broadcast(lengths), F.col("train") <= F.col("n") - 6).groupBy("train").agg(F.count("*").alias("series"))  # train lengths of a back-test


@query()
def fitted_trend_audit(spark: SparkSession, d: str) -> DataFrame:
    """The trend model against recent sales, its slope changes and its seasonal swing; each series is fitted once."""
    g = month_grid(spark, d)
    use_checkpoints(spark)
    parts = trend_model.fit_trends(g, known_changeovers(spark, d), ahead=False).checkpoint()
    audit = assembly.trend_audit(g, parts.select("key", "trend_at_end"))
    rest = parts.select("key", "known_changeover", "slope_changes", "places", "min_pct", "max_pct")
    return audit.join(rest, "key").select("key", "months", R4("trend_at_end"), R4("mean6"), R4("mean12"), R4("pct_diff"), "disconnected", "known_changeover", "slope_changes", "places", R4("min_pct"), R4("max_pct"))


@query()
def multiplicative_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Six months ahead with a simulated 95 % band by trend x season; parts with a known changeover get the wider prior."""
    out = trend_model.trend_forecast(trend_model.fit_trends(month_grid(spark, d), known_changeovers(spark, d)))
    return out.select("key", "step", YM("target_month").alias("target"), R4("yhat"), R4("yhat_lower"), R4("yhat_upper"))
