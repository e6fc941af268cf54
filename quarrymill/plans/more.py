"""Queries on accuracy in detail, training tables, replies and review views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import dates, parsing, replies
from quarrymill.operators import checks, forecast, replenish, scoring
from quarrymill.operators import reviews as ops
from quarrymill.session import table

from .bindings import ANCHOR, GRID, INVENTORY, REVIEWS, SALES, inventory, reviews, sales
from .bindings import grid as month_grid
from .demand import _FOLDS, _folds
from .registry import query

R6 = lambda c: F.round(c, 6)

_PAIRS = f"""{SALES}, ap AS (SELECT a.key AS item, a.key % 20 AS family, a.month, a.units AS actual, coalesce(p.units, 0) AS predicted FROM sales a LEFT JOIN sales p ON p.key = a.key AND p.month = a.month - INTERVAL 12 MONTH)"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    s = sales(spark, d)
    before = s.select("key", F.add_months("month", 12).alias("month"), F.col("units").alias("p"))
    return s.join(before, ["key", "month"], "left").select(F.col("key").alias("item"), (F.col("key") % 20).alias("family"), "month", F.col("units").alias("actual"), F.coalesce("p", F.lit(0.0)).alias("predicted"))


@query(f"""WITH {_PAIRS}, i AS (SELECT 'item' AS grain, CAST(item AS VARCHAR) AS name, month, sum(actual) AS a, sum(predicted) AS p FROM ap GROUP BY ALL UNION ALL SELECT 'family', CAST(family AS VARCHAR), month, sum(actual), sum(predicted) FROM ap GROUP BY ALL)
SELECT grain, name, count(*) AS "rows", round(sum(abs(p - a)) / nullif(sum(a), 0), 6) AS wape, round(sum(p - a) / nullif(sum(a), 0), 6) AS bias FROM i GROUP BY 1, 2""")
def two_grain_accuracy(spark: SparkSession, d: str) -> DataFrame:
    a = scoring.two_grain_accuracy(_pairs(spark, d))
    return a.withColumns({"wape": R6("wape"), "bias": R6("bias")})


@query(f"""WITH {_PAIRS}, w AS (SELECT *, sum(actual) OVER x AS fa, sum(predicted) OVER x AS fp FROM ap WINDOW x AS (PARTITION BY family, month)), l AS (SELECT family, month, sum(actual) AS a, sum(predicted) AS p FROM ap GROUP BY 1, 2), f AS (SELECT family, sum(abs(p - a)) / sum(a) AS fl FROM l GROUP BY 1)
SELECT w.family, round(sum(abs(predicted - actual)) / sum(actual), 6) AS as_is, round(sum(abs(CASE WHEN fa <> 0 THEN fp * actual / fa ELSE predicted END - actual)) / sum(actual), 6) AS perfect_share, round(any_value(fl), 6) AS family_level FROM w JOIN f ON f.family = w.family GROUP BY 1""")
def family_split_error(spark: SparkSession, d: str) -> DataFrame:
    e = scoring.split_error(_pairs(spark, d))
    return e.select("family", *(R6(c).alias(c) for c in ("as_is", "perfect_share", "family_level")))


@query(f"""WITH {_PAIRS}, e AS (SELECT item, count(*) AS n, sum(abs(predicted - actual)) / nullif(sum(actual), 0) AS w FROM ap GROUP BY 1) SELECT CASE WHEN n <= 10 THEN '0-10' WHEN n <= 20 THEN '11-20' WHEN n <= 30 THEN '21-30' ELSE '31+' END AS bucket, count(*) AS items, round(avg(w), 6) AS mean, round(median(w), 6) AS median FROM e GROUP BY 1""")
def error_by_occurrences(spark: SparkSession, d: str) -> DataFrame:
    e = _pairs(spark, d).groupBy("item").agg(F.count("*").alias("n"), scoring.wape(F.col("actual"), F.col("predicted")).alias("w"))
    return scoring.bucket_curve(e, "w", "n", (10, 20, 30)).withColumns({"mean": R6("mean"), "median": R6("median")})


@query(f"""WITH {_FOLDS}, g AS (SELECT method, key, train_end, sum(predicted) AS p, sum(actual) AS a, round(sum(abs(predicted - actual)) / nullif(sum(actual), 0), 9) AS w FROM scored GROUP BY ALL) SELECT method, round(sum(p) / sum(a), 6) AS bias_ratio, round(avg((round(p, 9) < 0.5)::INTEGER), 6) AS near_zero_share, round(avg((w = 1)::INTEGER), 6) AS lost_share FROM g GROUP BY 1""")
def method_shrinkage(spark: SparkSession, d: str) -> DataFrame:
    s = scoring.shrinkage(_folds(spark, d))
    return s.select("method", *(R6(c).alias(c) for c in ("bias_ratio", "near_zero_share", "lost_share")))


@query(f"""WITH {_FOLDS}, e AS (SELECT method, abs(predicted - actual) AS e, actual, predicted FROM scored) SELECT method, round(avg(e), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse, round(100 * avg(e / actual) FILTER (actual <> 0), 4) AS mape, round(100 * sum(e) / sum(actual), 4) AS wape, round(100 * sum(predicted - actual) / sum(actual), 4) AS bias FROM e GROUP BY 1""")
def metric_bundle(spark: SparkSession, d: str) -> DataFrame:
    return _folds(spark, d).groupBy("method").agg(*scoring.metrics(F.col("actual"), F.col("predicted"), 4))


_BATCHES = f"""{SALES}, bt AS (SELECT key, CAST(month + to_months(12) AS DATE) AS month, units AS yhat, 1 AS run FROM sales WHERE month >= DATE '2000-01-01' AND key % 2 = 0 UNION ALL SELECT key, CAST(month + to_months(12) AS DATE), units + 1, 2 FROM sales WHERE month >= DATE '2000-01-01' AND key % 3 = 0
  UNION ALL SELECT key, CAST(month + to_months(12) AS DATE), units + 2, 3 FROM sales WHERE month >= DATE '2000-03-01' AND key % 5 = 0)"""


@query(f"""WITH {_BATCHES}, f AS (SELECT *, min(month) OVER (PARTITION BY run) AS fm FROM bt), n AS (SELECT *, max(run) OVER (PARTITION BY fm) AS nr FROM f)
SELECT n.key, strftime(n.month, '%Y-%m') AS ym, run, CAST(datediff('month', fm, n.month) + 1 AS INTEGER) AS horizon, yhat, CASE WHEN n.month <= DATE '{ANCHOR}' THEN coalesce(s.units, 0) END AS actual, n.month <= DATE '{ANCHOR}' AS month_complete FROM n LEFT JOIN sales s ON s.key = n.key AND s.month = n.month WHERE run = nr""")
def delivered_scores(spark: SparkSession, d: str) -> DataFrame:
    s = sales(spark, d)
    batch = lambda run, since, n: s.where((F.col("month") >= since) & (F.col("key") % n == 0)).select("key", F.add_months("month", 12).alias("month"), (F.col("units") + run - 1).alias("yhat"), F.lit(run).alias("run"))
    batches = batch(1, "2000-01-01", 2).unionByName(batch(2, "2000-01-01", 3)).unionByName(batch(3, "2000-03-01", 5))
    complete = batches.select("month").distinct().withColumn("is_complete", F.col("month") <= ANCHOR)
    out = scoring.score_deliveries(batches, s, complete)
    return out.select("key", F.date_format("month", "yyyy-MM").alias("ym"), "run", "horizon", "yhat", "actual", "month_complete")


@query(f"""WITH {GRID}, p AS (SELECT CAST(key AS VARCHAR) AS id, month, units FROM grid), k AS (SELECT id FROM p WHERE month <= DATE '{ANCHOR}' GROUP BY 1 HAVING count(*) >= 12),
t AS (SELECT 'train' AS part, p.* FROM p JOIN k USING (id) WHERE month <= DATE '{ANCHOR}' UNION ALL SELECT 'horizon', id, CAST(DATE '{ANCHOR}' + to_months(h) AS DATE), 0 FROM k, (SELECT unnest([1, 2, 3]) AS h) UNION ALL SELECT 'holdout', p.* FROM p JOIN k USING (id) WHERE month > DATE '{ANCHOR}' AND month <= DATE '{ANCHOR}' + INTERVAL 3 MONTH)
SELECT part, count(*) AS "rows", count(DISTINCT id) AS series, strftime(min(month), '%Y-%m') AS first, strftime(max(month), '%Y-%m') AS last, sum(units) AS y FROM t GROUP BY 1""")
def training_tables(spark: SparkSession, d: str) -> DataFrame:
    parts = zip(("train", "horizon", "holdout"), forecast.training_tables(month_grid(spark, d), ANCHOR, 3), strict=True)
    out = None
    for name, df in parts:
        df = df.withColumn("part", F.lit(name))
        out = df if out is None else out.unionByName(df)
    ym = lambda c: F.date_format(c, "yyyy-MM")
    return out.groupBy("part").agg(F.count("*").alias("rows"), F.count_distinct("series_id").alias("series"), ym(F.min("ds")).alias("first"), ym(F.max("ds")).alias("last"), F.sum("y").alias("y"))


@query(f"""WITH {INVENTORY}, r AS (SELECT key, count(*) AS n, median(stock / sales) AS r FROM inv WHERE stock IS NOT NULL AND sales > 0 GROUP BY 1) SELECT key, round(least(greatest(r, 0.5), 4), 6) AS cover FROM r WHERE n >= 3""")
def simple_cover(spark: SparkSession, d: str) -> DataFrame:
    return replenish.simple_cover(inventory(spark, d)).select("key", R6("cover").alias("cover"))


@query(f"""WITH {INVENTORY}, s AS (SELECT key, sales AS d, coalesce(stock, 0) AS st, open_po AS po FROM inv WHERE i = n), a AS (SELECT *, st - d + po AS l1 FROM s), b AS (SELECT *, greatest(1.5 * d - l1, 0) AS o1 FROM a), c AS (SELECT *, greatest(l1 + o1, 0) - d AS l2 FROM b)
SELECT key, round(o1, 4) AS first_order, round(greatest(1.5 * d - l2, 0), 4) AS second_order FROM c""")
def simple_orders(spark: SparkSession, d: str) -> DataFrame:
    last = inventory(spark, d).where("i = n")
    o = replenish.simple_orders(F.array("sales", "sales"), F.coalesce("stock", F.lit(0.0)), F.col("open_po"), F.lit(1.5))
    return last.withColumn("o", o).select("key", F.round(F.col("o")[0], 4).alias("first_order"), F.round(F.col("o")[1], 4).alias("second_order"))


@query(f"""WITH {INVENTORY}, p AS (SELECT lag(open_po) OVER (PARTITION BY key ORDER BY month) AS x, sales AS z, coalesce(received, 0) AS y FROM inv), s AS (SELECT sum(x * x) AS xx, sum(x * z) AS xz, sum(z * z) AS zz, sum(x * y) AS xy, sum(z * y) AS zy FROM p WHERE x IS NOT NULL),
f AS (SELECT greatest((xy * zz - zy * xz) / (xx * zz - xz * xz), 0) AS a, greatest((zy * xx - xy * xz) / (xx * zz - xz * xz), 0) AS b FROM s), m AS (SELECT key, avg(sales) FILTER (i > n - 3) AS m, max(open_po) FILTER (i = n) AS po, count(*) AS c FROM inv GROUP BY 1)
SELECT key, CAST(step AS INTEGER) AS step, round(CASE WHEN step = 1 THEN a * po + b * m ELSE m END, 4) AS predicted FROM m, f, (SELECT unnest([1, 2]) AS step) WHERE c >= 12""")
def open_order_blend(spark: SparkSession, d: str) -> DataFrame:
    inv = inventory(spark, d)
    f = forecast.forecast(forecast.histories(month_grid(spark, d)), 2, ["mean3"])
    out = replenish.blend_open_orders(f, inv, replenish.fit_first_month(inv))
    return out.select("key", "step", F.round("predicted", 4).alias("predicted"))


@query("""SELECT c_nationkey AS key, CAST(count(DISTINCT c_mktsegment) AS INTEGER) AS n, string_agg(DISTINCT c_mktsegment, ' | ' ORDER BY c_mktsegment) AS "values" FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1""")
def ambiguous_segments(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_mktsegment").alias("v"))
    return checks.ambiguous_values(c, "key", "v")


@query(f"""WITH {REVIEWS} SELECT count(*) AS reviews, round(100 * count(*) FILTER (sentiment = 'positive') / count(*), 1) AS positive, round(100 * count(*) FILTER (sentiment = 'neutral') / count(*), 1) AS neutral, round(100 * count(*) FILTER (sentiment = 'negative') / count(*), 1) AS negative FROM reviews""")
def overall_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return ops.overall(reviews(spark, d))


@query(f"""WITH {REVIEWS}, sc AS (SELECT * FROM (VALUES ('all', NULL, NULL), ('shop', 'shop', NULL), ('service', NULL, 'service')) t(name, so, ki)) SELECT name, count(*) AS reviews, count(*) FILTER (sentiment = 'negative') AS negatives FROM reviews JOIN sc ON (so IS NULL OR so = source) AND (ki IS NULL OR ki = kind) GROUP BY 1""")
def scoped_reviews(spark: SparkSession, d: str) -> DataFrame:
    scopes = spark.createDataFrame([("all", None, None), ("shop", "shop", None), ("service", None, "service")], "name string, source string, kind string")
    return ops.in_scope(reviews(spark, d), scopes).groupBy("name").agg(F.count("*").alias("reviews"), F.count_if(F.col("sentiment") == "negative").alias("negatives"))


@query("""WITH g AS (SELECT conv_id % 5 AS w, CASE WHEN conv_id % 2 = 0 THEN 'shop' ELSE 'market' END AS scope, turn AS rank, conv_id AS generated FROM conversations), n AS (SELECT *, max(generated) OVER (PARTITION BY w, scope) AS m FROM g), o AS (SELECT w, scope, rank, generated FROM n WHERE generated = m)
SELECT * FROM o UNION ALL SELECT w, 'all', rank, generated FROM o WHERE scope = 'shop'""")
def latest_generation(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select((F.col("conv_id") % 5).alias("w"), F.when(F.col("conv_id") % 2 == 0, "shop").otherwise("market").alias("scope"), F.col("turn").alias("rank"), F.col("conv_id").alias("generated"))
    return ops.latest_generation(c, ("w", "scope"), "generated", {"shop": "all"})


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'neutral' ELSE ['positive', 'neutral', 'negative'][doc_id % 4 + 1] END AS sentiment, CASE WHEN doc_id % 5 = 0 THEN 0.5 ELSE least(doc_id % 13 / 10, 1) END AS confidence, CAST(least(doc_id % 9, 6) AS INTEGER) AS themes, replace(lower(source), '-', '_') || '_area' AS area FROM documents""")
def normalised_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies written as fenced JSON with odd values, read back into the closed form."""
    i = F.col("doc_id")
    themes = F.slice(F.array(*(F.lit(f" Theme {k}") for k in range(9))), F.lit(1), (i % 9).cast("int"))
    sentiment = F.element_at(F.array(*map(F.lit, ("Positive", "neutral", " NEGATIVE ", "mixed"))), (i % 4 + 1).cast("int"))
    reply = F.concat(F.lit("```json\n"), F.to_json(F.struct(sentiment.alias("sentiment"), F.when(i % 5 == 0, "high").otherwise((i % 13 / 10).cast("string")).alias("confidence"), themes.alias("key_themes"), F.concat("source", F.lit(" Area!")).alias("area"))), F.lit("\n```"))
    r = table(spark, d, "documents").select("doc_id", replies.normalised(reply).alias("r"))
    return r.select("doc_id", "r.sentiment", "r.confidence", F.size("r.themes").alias("themes"), "r.area")


@query("""WITH b AS (SELECT conv_id AS batch, turn AS position, CASE WHEN turn % 3 = 0 THEN NULL ELSE turn + 1 END AS id FROM conversations), z AS (SELECT batch, CAST(count(*) AS INTEGER) AS size FROM b GROUP BY 1), s AS (SELECT batch, unnest(range(1, size + 1)) AS slot FROM z),
k AS (SELECT b.*, coalesce(id BETWEEN 1 AND size, FALSE) AS named FROM b JOIN z USING (batch)), a AS (SELECT s.batch, s.slot, k.position FROM s LEFT JOIN k ON k.batch = s.batch AND k.id = s.slot AND named),
e AS (SELECT batch, slot, row_number() OVER (PARTITION BY batch ORDER BY slot) AS r FROM a WHERE position IS NULL), p AS (SELECT batch, position, row_number() OVER (PARTITION BY batch ORDER BY position) AS r FROM k WHERE NOT named)
SELECT a.batch, CAST(a.slot AS INTEGER) AS slot, coalesce(a.position, p.position) AS position FROM a LEFT JOIN e ON e.batch = a.batch AND e.slot = a.slot LEFT JOIN p ON p.batch = e.batch AND p.r = e.r""")
def aligned_replies(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("batch"), F.col("turn").alias("position"), F.when(F.col("turn") % 3 != 0, F.col("turn") + 1).alias("id"))
    return replies.aligned(c, c.groupBy("batch").agg(F.count("*").cast("int").alias("size")))


@query("""SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def localised_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in three languages, read back."""
    o = table(spark, d, "orders")
    m, day, year = F.month("o_orderdate"), F.day("o_orderdate").cast("string"), F.year("o_orderdate").cast("string")
    name = lambda lang: F.element_at(F.array(*map(F.lit, dates.MONTH_NAMES[lang])), m)
    k = F.col("o_orderkey") % 4
    shown = F.when(k == 0, F.concat(F.lit("Reviewed in Spain on "), name("en"), F.lit(" "), day, F.lit(", "), year)).when(k == 1, F.concat(F.lit("Bewertet in Deutschland vom "), day, F.lit(". "), name("de"), F.lit(" "), year))
    shown = shown.when(k == 2, F.concat(day, F.lit(" de "), name("es"), F.lit(" de "), year)).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm"))
    return o.select(F.col("o_orderkey").alias("k"), F.date_format(dates.localised_date(shown), "yyyy-MM-dd").alias("day"))


@query("""SELECT p_partkey AS k, CASE left(upper(p_name), 1) WHEN 'D' THEN 'UK' WHEN 'E' THEN 'EU' WHEN 'U' THEN 'US' WHEN 'A' THEN 'AU' END AS region, p_size > 10 AS large FROM part""")
def code_regions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("k"), parsing.region_of_code(F.col("p_name")).alias("region"), parsing.truth(F.when(F.col("p_size") > 10, "yes").otherwise("No")).alias("large"))


@query("""WITH w AS (SELECT user_id AS item, CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS s, arg_max(event_id, ts) AS stock FROM events GROUP BY 1, 2), d AS (SELECT user_id AS item, CAST(ts AS DATE) AS d, arg_max(event_id, ts) AS stock FROM events GROUP BY 1, 2)
SELECT count(*) AS compared, count(*) FILTER (w.stock = a.stock) AS first_day, count(*) FILTER (w.stock = b.stock) AS last_day FROM w JOIN d a ON a.item = w.item AND a.d = w.s JOIN d b ON b.item = w.item AND b.d = w.s + 6""")
def snapshot_side(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("item"), F.col("ts").cast("date").alias("day"), "ts", "event_id")
    start = F.date_sub(dates.week_end(F.col("day")), 6)
    weeks = e.groupBy("item", start.alias("start")).agg(F.max_by("event_id", "ts").alias("stock")).withColumn("end", F.date_add("start", 6))
    return checks.snapshot_side(weeks, e.groupBy("item", "day").agg(F.max_by("event_id", "ts").alias("stock")))
