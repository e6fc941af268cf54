"""Queries on grids, forecasts, scores, classes and families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.operators import classify, families, forecast, grid, models, scoring
from quarrymill.session import table

from .bindings import ANCHOR, GRID, SALES, SUCCESSORS, successors
from .bindings import grid as month_grid
from .bindings import sales as month_sales
from .registry import query

ENDS, HORIZON = ("1999-12-01", "2000-06-01", "2000-12-01"), 6
R6 = lambda c: F.round(c, 6)

_FOLDS = f"""{GRID}, ends AS (SELECT CAST(unnest(['1999-12-01', '2000-06-01', '2000-12-01']) AS DATE) AS train_end),
hist AS (SELECT g.key, e.train_end, g.month, g.units, row_number() OVER (PARTITION BY g.key, e.train_end ORDER BY g.month) AS j,
  count(*) OVER (PARTITION BY g.key, e.train_end) AS m FROM grid g JOIN ends e ON g.month <= e.train_end),
usable AS (SELECT * FROM hist WHERE m >= 12),
levels AS (SELECT key, train_end, max(CASE WHEN j = m THEN units END) AS naive_last, avg(CASE WHEN j > m - 3 THEN units END) AS mean3,
  avg(CASE WHEN j > m - 6 THEN units END) AS mean6, avg(CASE WHEN j > m - 12 THEN units END) AS mean12 FROM usable GROUP BY 1, 2),
steps AS (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step),
flat AS (UNPIVOT levels ON naive_last, mean3, mean6, mean12 INTO NAME method VALUE predicted),
pred AS (SELECT key, train_end, method, step, CAST(train_end + to_months(step) AS DATE) AS target_month, predicted FROM flat, steps
  UNION ALL SELECT l.key, l.train_end, 'prior_year', step, CAST(l.train_end + to_months(step) AS DATE), coalesce(u.units, l.mean12)
  FROM levels l CROSS JOIN steps LEFT JOIN usable u ON u.key = l.key AND u.train_end = l.train_end AND u.month = CAST(l.train_end + to_months(step - 12) AS DATE)),
scored AS (SELECT p.*, coalesce(s.units, 0.0) AS actual FROM pred p LEFT JOIN sales s ON s.key = p.key AND s.month = p.target_month)"""
_METHODS = ("naive_last", "mean3", "mean6", "mean12", "prior_year")


def _predictions(spark: SparkSession, d: str, methods: tuple[str, ...] = _METHODS) -> DataFrame:
    past = forecast.histories(month_grid(spark, d), ENDS)
    return forecast.forecast(past, HORIZON, methods)


def _fold_errors(spark: SparkSession, d: str) -> DataFrame:
    return forecast.fold_errors(forecast.histories(month_grid(spark, d), ENDS, ahead=HORIZON), HORIZON, _METHODS)


def _folds(spark: SparkSession, d: str) -> DataFrame:
    actual = month_sales(spark, d).select("key", F.col("month").alias("target_month"), F.col("units").alias("actual"))
    return _predictions(spark, d).join(actual, ["key", "target_month"], "left").withColumn("actual", F.coalesce("actual", F.lit(0.0)))


@query(f"""WITH {_FOLDS} SELECT method, count(*) AS "rows", round(sum(abs(predicted - actual)) / sum(actual), 6) AS wape, round(sum(predicted - actual) / sum(actual), 6) AS bias FROM scored GROUP BY 1""")
def forecast_error_by_method(spark: SparkSession, d: str) -> DataFrame:
    """Rolling back-test of the simple methods at series level."""
    s = scoring.score_folds(_fold_errors(spark, d))
    return s.select("method", "rows", R6("wape").alias("wape"), R6("bias").alias("bias"))


@query(f"""WITH {_FOLDS}, t AS (SELECT method, train_end, target_month, sum(predicted) AS p FROM pred GROUP BY ALL), a AS (SELECT month, sum(units) AS a FROM sales GROUP BY 1)
SELECT method, count(*) AS "rows", round(sum(abs(p - coalesce(a, 0))) / sum(coalesce(a, 0)), 6) AS wape, round(sum(p - coalesce(a, 0)) / sum(coalesce(a, 0)), 6) AS bias FROM t LEFT JOIN a ON a.month = t.target_month GROUP BY 1""")
def forecast_error_of_totals(spark: SparkSession, d: str) -> DataFrame:
    s = scoring.score_totals(_predictions(spark, d), month_sales(spark, d))
    return s.select("method", "rows", R6("wape").alias("wape"), R6("bias").alias("bias"))


@query(f"""WITH {_FOLDS}, f AS (SELECT key, method, train_end, sum(abs(predicted - actual)) AS e, nullif(sum(actual), 0) AS a FROM scored GROUP BY ALL)
SELECT key, method, count(*) AS folds, round(avg(e / a), 6) AS mean_wape, round(median(e / a), 6) AS median_wape, round(sum(e) / nullif(sum(coalesce(a, 0)), 0), 6) AS pooled_wape FROM f GROUP BY 1, 2""")
def item_method_scores(spark: SparkSession, d: str) -> DataFrame:
    s = scoring.item_scores(_fold_errors(spark, d))
    return s.select("key", "method", "folds", R6("mean_wape").alias("mean_wape"), R6("median_wape").alias("median_wape"), R6("pooled_wape").alias("pooled_wape"))


@query(f"""WITH {_FOLDS}, f AS (SELECT key, method, train_end, sum(CAST(round(60 * abs(predicted - actual)) AS BIGINT)) / (60 * nullif(CAST(sum(actual) AS BIGINT), 0)) AS w FROM scored GROUP BY ALL),
s AS (SELECT key, method, count(w) AS folds, round(median(w) + 1e-9, 6) AS w FROM f GROUP BY 1, 2),
n AS (SELECT key, max(folds) AS folds, max(w) FILTER (method = 'mean12') AS current_wape FROM s GROUP BY 1),
b AS (SELECT key, method, w, row_number() OVER (PARTITION BY key ORDER BY w, method) AS r FROM s WHERE w IS NOT NULL)
SELECT n.key, b.method AS best, b.w AS best_wape, n.current_wape, n.folds,
  CASE WHEN n.folds < 3 THEN 'too_few_folds' WHEN b.method IS NULL OR b.method = 'mean12' THEN 'keep' WHEN n.current_wape IS NULL THEN 'no_baseline' WHEN n.current_wape - b.w > 0.05 + 1e-9 THEN 'switch' ELSE 'keep_within_margin' END AS verdict
FROM n LEFT JOIN b ON b.key = n.key AND b.r = 1""")
def method_tournament(spark: SparkSession, d: str) -> DataFrame:
    """Which method an item should use, by exact errors: units are whole, and means of 3, 6 or 12 are sixtieths."""
    e = F.sum(F.round(60 * F.abs(F.col("predicted") - F.col("actual"))).cast("long")) / (60 * F.nullif(F.sum("actual").cast("long"), F.lit(0)))
    folds = _folds(spark, d).groupBy("key", "method", "train_end").agg(e.alias("w"))
    scores = folds.groupBy("key", "method").agg(F.count("w").alias("folds"), R6(F.median("w") + 1e-9).alias("median_wape"))
    return scoring.tournament(scores, "mean12")


@query(f"""WITH {_FOLDS} SELECT round(sum(CASE WHEN key IN (SELECT key FROM pred) THEN units END) / sum(units), 6) AS coverage FROM sales""")
def forecast_coverage(spark: SparkSession, d: str) -> DataFrame:
    return scoring.coverage(_predictions(spark, d, ("naive_last",)), month_sales(spark, d)).select(R6("coverage").alias("coverage"))


@query(f"""WITH RECURSIVE {GRID}, alphas AS (SELECT unnest([0.1, 0.2, 0.3, 0.5, 0.7, 0.9])::DOUBLE AS a),
g AS (SELECT key, i, n, units FROM grid WHERE n >= 12),
walk AS (SELECT key, a, 1::BIGINT AS i, n, units AS level, 0.0::DOUBLE AS sse FROM g, alphas WHERE i = 1
  UNION ALL SELECT w.key, w.a, g.i, w.n, w.a * g.units + (1 - w.a) * w.level, w.sse + (g.units - w.level) * (g.units - w.level) FROM walk w JOIN g ON g.key = w.key AND g.i = w.i + 1)
SELECT key, round(arg_min(level, (round(sse, 6), a)), 4) AS level FROM (SELECT * FROM walk WHERE i = n) GROUP BY key""")
def exponential_smoothing_levels(spark: SparkSession, d: str) -> DataFrame:
    past = forecast.histories(month_grid(spark, d))
    out = forecast.forecast(past, 1, ["ses"])
    return out.select("key", F.round("predicted", 4).alias("level"))


@query(f"""WITH RECURSIVE {GRID}, g AS (SELECT key, i, n, units FROM grid WHERE n >= 12),
walk AS (SELECT key, i, n, units AS z, 1.0::DOUBLE AS p, 1.0::DOUBLE AS q, 1.0::DOUBLE AS pr, units AS tz FROM g WHERE i = 1
  UNION ALL SELECT w.key, g.i, w.n, CASE WHEN g.units > 0 THEN 0.1 * g.units + 0.9 * w.z ELSE w.z END, CASE WHEN g.units > 0 THEN 0.1 * w.q + 0.9 * w.p ELSE w.p END,
  CASE WHEN g.units > 0 THEN 1.0 ELSE w.q + 1 END, CASE WHEN g.units > 0 THEN 0.1 + 0.9 * w.pr ELSE 0.9 * w.pr END, CASE WHEN g.units > 0 THEN 0.2 * g.units + 0.8 * w.tz ELSE w.tz END
  FROM walk w JOIN g ON g.key = w.key AND g.i = w.i + 1)
SELECT key, round(z / p, 4) AS croston, round(0.95 * z / p, 4) AS sba, round(tz * pr, 4) AS tsb FROM walk WHERE i = n""")
def intermittent_rates(spark: SparkSession, d: str) -> DataFrame:
    past = forecast.histories(month_grid(spark, d))
    out = forecast.forecast(past, 1, ["croston", "sba", "tsb"])
    return out.groupBy("key").pivot("method", ["croston", "sba", "tsb"]).agg(F.round(F.first("predicted"), 4))


@query(f"""WITH {SALES}, t AS (SELECT month, sum(units) AS u FROM sales WHERE month <= DATE '{ANCHOR}' GROUP BY 1),
m AS (SELECT month, u / ((lag(u, 6) OVER w + 2 * sum(u) OVER (ORDER BY month ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + lead(u, 6) OVER w) / 24) AS r FROM t WINDOW w AS (ORDER BY month)),
f AS (SELECT month(month) AS month_of_year, avg(r) AS f FROM m WHERE r IS NOT NULL GROUP BY 1)
SELECT CAST(month_of_year AS INTEGER) AS month_of_year, round(1 + 0.5 * (f / (SELECT avg(f) FROM f) - 1), 6) AS factor FROM f""")
def seasonal_shape(spark: SparkSession, d: str) -> DataFrame:
    totals = month_sales(spark, d).where(F.col("month") <= F.lit(ANCHOR).cast("date")).groupBy("month").agg(F.sum("units").alias("units"))
    return forecast.seasonal_factors(totals, 0.5).select("month_of_year", R6("factor").alias("factor"))


@query(f"""WITH {GRID}, p AS (SELECT * FROM grid WHERE month <= DATE '{ANCHOR}'), t AS (SELECT month, sum(units) AS u FROM p GROUP BY 1),
m AS (SELECT month, u / ((lag(u, 6) OVER w + 2 * sum(u) OVER (ORDER BY month ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + lead(u, 6) OVER w) / 24) AS r FROM t WINDOW w AS (ORDER BY month)),
f0 AS (SELECT month(month) AS mo, avg(r) AS f FROM m WHERE r IS NOT NULL GROUP BY 1), f AS (SELECT mo, f / (SELECT avg(f) FROM f0) AS f FROM f0),
h AS (SELECT key, units, month(month) AS mo, row_number() OVER (PARTITION BY key ORDER BY month DESC) AS r, count(*) OVER (PARTITION BY key) AS c FROM p),
l AS (SELECT key, avg(units / greatest(f, 0.05)) AS lv FROM h JOIN f USING (mo) WHERE r <= 12 AND c >= 12 GROUP BY 1)
SELECT key, s.step, strftime(CAST(DATE '{ANCHOR}' + to_months(s.step) AS DATE), '%Y-%m') AS target, round(lv * f, 4) AS predicted FROM l, (SELECT unnest([1, 2, 3]) AS step) s JOIN f ON f.mo = month(DATE '{ANCHOR}' + to_months(s.step))""")
def seasonal_item_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = forecast.seasonal_forecast(month_grid(spark, d), ANCHOR, 3)
    return out.select("key", "step", F.date_format("target_month", "yyyy-MM").alias("target"), F.round("predicted", 4).alias("predicted"))


@query(f"""WITH {SALES}, l AS (SELECT key, coalesce(sum(units) FILTER (month <= DATE '{ANCHOR}' AND month > DATE '{ANCHOR}' - INTERVAL 3 MONTH), 0) / 3 AS y FROM sales GROUP BY 1)
SELECT key, strftime(DATE '{ANCHOR}' + to_months(h), '%Y-%m') AS target, round(y, 6) AS yhat, round(y * 0.6, 6) AS yhat_lower, round(y * 1.4, 6) AS yhat_upper FROM l, (SELECT unnest([1, 2]) AS h)""")
def naive_route_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = forecast.naive_route(month_sales(spark, d), ANCHOR, 3, 2)
    return out.select("key", F.date_format("target_month", "yyyy-MM").alias("target"), *(R6(c).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")))


_CLASS = f"""{SALES}, z AS (SELECT key, month, units FROM sales WHERE month <= DATE '{ANCHOR}' AND units > 0),
c AS (SELECT key, count(*) AS n, min(month) AS f, var_pop(units) / (avg(units) * avg(units)) AS v, datediff('month', min(month), DATE '{ANCHOR}') + 1 AS t,
  coalesce(sum(units) FILTER (month > DATE '{ANCHOR}' - INTERVAL 24 MONTH), 0) AS late, coalesce(sum(units) FILTER (month <= DATE '{ANCHOR}' - INTERVAL 24 MONTH AND month > DATE '{ANCHOR}' - INTERVAL 48 MONTH), 0) AS early FROM z GROUP BY 1),
k AS (SELECT key, t / n AS adi, CASE WHEN n >= 2 THEN v END AS cv2, n AS n_nonzero_months, CAST(t AS INTEGER) AS tenure_months,
  CASE WHEN early > 0 THEN (late / least(t, 24)) / (early / least(greatest(t - 24, 0), 24)) END AS decline_ratio FROM c),
classes AS (SELECT *, CASE WHEN n_nonzero_months < 4 OR cv2 IS NULL THEN 'Insufficient Data to Classify' WHEN adi >= 1.32 THEN CASE WHEN cv2 >= 0.49 THEN 'Lumpy' ELSE 'Intermittent' END WHEN cv2 >= 0.49 THEN 'Erratic' ELSE 'Smooth' END AS category FROM k)"""


@query(f"""WITH {_CLASS} SELECT key, round(adi, 6) AS adi, round(cv2, 6) AS cv2, n_nonzero_months, tenure_months, round(decline_ratio, 6) AS decline_ratio, category,
category <> 'Insufficient Data to Classify' AND (abs(adi - 1.32) <= 0.132 OR abs(cv2 - 0.49) <= 0.049) AS near_threshold FROM classes""")
def demand_classes(spark: SparkSession, d: str) -> DataFrame:
    c = classify.classify(month_sales(spark, d), ANCHOR)
    return c.select("key", R6("adi").alias("adi"), R6("cv2").alias("cv2"), "n_nonzero_months", "tenure_months", R6("decline_ratio").alias("decline_ratio"), "category", "near_threshold")


@query(f"""WITH {_CLASS}, i AS (SELECT *, key % 10 = 0 AS ret, key % 7 <> 3 AS act, key % 50 = 9 AS mis, tenure_months AS tr, category IN ('Smooth', 'Erratic') AS fit FROM classes),
b AS (SELECT *, CASE WHEN ret THEN 'retired' WHEN NOT act THEN 'inactive' WHEN mis THEN 'channel_mismatch' WHEN category = 'Insufficient Data to Classify' THEN 'unclassified' WHEN fit AND tr < 24 THEN 'short_history' WHEN NOT fit AND n_nonzero_months < 12 THEN 'few_occurrences' END AS why FROM i)
SELECT key, category, CASE WHEN why IS NOT NULL THEN 'blocked' WHEN fit THEN 'regression' WHEN decline_ratio < 1 THEN 'naive_3' ELSE 'naive_12' END AS route, coalesce(why, '') AS block_reason,
CAST(CASE WHEN why IN ('retired', 'inactive', 'channel_mismatch') THEN NULL WHEN fit THEN tr ELSE n_nonzero_months END AS BIGINT) AS qualifying_months,
CASE WHEN why IN ('retired', 'inactive', 'channel_mismatch') THEN NULL WHEN category LIKE 'Insuff%' THEN 4 WHEN fit THEN 24 ELSE 12 END AS threshold FROM b""")
def model_routes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("key")
    items = classify.classify(month_sales(spark, d), ANCHOR).withColumns({
        "is_retired": k % 10 == 0, "is_active": k % 7 != 3, "is_channel_mismatch": k % 50 == 9, "n_train_months": F.col("tenure_months"),
    })
    return classify.route(items).select("key", "category", "route", "block_reason", "qualifying_months", "threshold")


@query(f"""WITH {GRID}, e AS (SELECT *, units - avg(units) OVER (PARTITION BY key) AS dv FROM grid), l AS (SELECT key, dv, lag(dv) OVER w AS d1, lag(dv, 12) OVER w AS d12 FROM e WINDOW w AS (PARTITION BY key ORDER BY month))
SELECT key, round(coalesce(sum(dv * d1), 0) / nullif(sum(dv * dv), 0), 6) AS acf_1, round(coalesce(sum(dv * d12), 0) / nullif(sum(dv * dv), 0), 6) AS acf_12 FROM l GROUP BY 1""")
def grid_autocorrelation(spark: SparkSession, d: str) -> DataFrame:
    a = grid.autocorrelation(month_grid(spark, d), (1, 12))
    return a.select("key", R6("acf_1").alias("acf_1"), R6("acf_12").alias("acf_12"))


@query(f"""WITH {GRID} SELECT key, round(regr_slope(units, i), 6) AS slope, round(regr_slope(units, i) FILTER (i > n - 6), 6) AS recent_slope FROM grid WHERE n >= 12 GROUP BY 1""")
def grid_trend(spark: SparkSession, d: str) -> DataFrame:
    t = grid.trend(month_grid(spark, d))
    return t.select("key", R6("slope").alias("slope"), R6("recent_slope").alias("recent_slope"))


@query(f"""WITH {GRID}, l AS (SELECT key, median(units) AS m FROM grid WHERE units > 0 GROUP BY 1) SELECT g.key, round(avg((units = 0)::INTEGER), 6) AS zero_rate, round(avg((units <= coalesce(m * 0.1, 0))::INTEGER), 6) AS near_zero_rate FROM grid g LEFT JOIN l ON l.key = g.key GROUP BY 1""")
def grid_zero_rates(spark: SparkSession, d: str) -> DataFrame:
    return grid.zero_rates(month_grid(spark, d)).select("key", R6("zero_rate").alias("zero_rate"), R6("near_zero_rate").alias("near_zero_rate"))


@query(f"""WITH {GRID}, t AS (SELECT key, (i - 1) // 12 AS b, n // 12 AS k, var_samp(units) AS v, avg(units) AS m FROM grid GROUP BY 1, 2, 3)
SELECT key, round(var_samp(v) FILTER (b < k AND k >= 2) + 1e-7, 4) AS lumpiness, round(var_samp(m) FILTER (b < k AND k >= 2) + 1e-7, 4) AS stability FROM t GROUP BY 1""")
def grid_tile_features(spark: SparkSession, d: str) -> DataFrame:
    return grid.tile_features(month_grid(spark, d)).select("key", F.round(F.col("lumpiness") + 1e-7, 4).alias("lumpiness"), F.round(F.col("stability") + 1e-7, 4).alias("stability"))


@query(f"""WITH {GRID} SELECT g.key, strftime(g.month, '%Y-%m') AS ym, g.units AS actual, p.units AS prior_year, round(sum(g.units) OVER (PARTITION BY g.key ORDER BY g.month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / 3, 6) AS trailing FROM grid g LEFT JOIN sales p ON p.key = g.key AND p.month = g.month - INTERVAL 12 MONTH""")
def prior_year_and_trailing(spark: SparkSession, d: str) -> DataFrame:
    s = month_sales(spark, d).select("key", F.add_months("month", 12).alias("month"), F.col("units").alias("prior_year"))
    return month_grid(spark, d).withColumn("trailing", R6(grid.trailing_mean(F.col("units"), 3))).join(s, ["key", "month"], "left").select("key", F.date_format("month", "yyyy-MM").alias("ym"), F.col("units").alias("actual"), "prior_year", "trailing")


@query(f"""WITH {SUCCESSORS} SELECT family, code, is_current, strftime(changeover, '%Y-%m') AS changeover FROM families""")
def successor_families(spark: SparkSession, d: str) -> DataFrame:
    return families.resolve(successors(spark, d)).select("family", "code", "is_current", F.date_format("changeover", "yyyy-MM").alias("changeover"))


@query(f"""WITH {SALES}, {SUCCESSORS} SELECT coalesce(f.family, s.key) AS key, strftime(month, '%Y-%m') AS ym, sum(units) AS units FROM sales s LEFT JOIN families f ON f.code = s.key GROUP BY 1, 2""")
def pooled_series(spark: SparkSession, d: str) -> DataFrame:
    members = families.resolve(successors(spark, d))
    return families.pool(month_sales(spark, d), members).select("key", F.date_format("month", "yyyy-MM").alias("ym"), "units")


_RATIOS = """SELECT {cut} AS cut, c.family, c.code, m.months, m.total FROM (SELECT * FROM families WHERE is_current) c LEFT JOIN (
  SELECT family, code, count(DISTINCT month) FILTER (units > 0) AS months, sum(units) FILTER (r <= 6) AS total FROM (
    SELECT f.family, f.code, s.month, s.units, dense_rank() OVER (PARTITION BY f.family ORDER BY s.month DESC) AS r FROM sales s JOIN families f ON f.code = s.key AND f.is_current AND s.month >= f.changeover {where}) GROUP BY 1, 2) m
  ON m.family = c.family AND m.code = c.code"""


@query(f"""WITH {SALES}, {SUCCESSORS}, r0 AS ({_RATIOS.format(cut="'test'", where="WHERE s.month <= DATE '2000-12-01'")} UNION ALL {_RATIOS.format(cut="'forward'", where="")}),
r1 AS (SELECT cut, family, code, coalesce(months, 0) AS months, coalesce(total, 0) AS total FROM r0),
r2 AS (SELECT *, count(*) OVER w AS n, min(months) OVER w AS thin, sum(total) OVER w AS whole FROM r1 WINDOW w AS (PARTITION BY cut, family)),
r3 AS (SELECT cut, family, code, CASE WHEN n = 1 THEN 1 WHEN thin >= 3 AND whole > 0 THEN total / whole ELSE 1 / n END AS ratio, CASE WHEN n = 1 THEN 'single' WHEN thin >= 3 AND whole > 0 THEN 'observed' ELSE 'equal' END AS method FROM r2)
SELECT a.family, a.code, round(a.ratio, 6) AS test_ratio, a.method AS test_method, round(b.ratio, 6) AS forward_ratio, b.method AS forward_method FROM r3 a JOIN r3 b ON a.family = b.family AND a.code = b.code AND a.cut = 'test' AND b.cut = 'forward'""")
def family_split_ratios(spark: SparkSession, d: str) -> DataFrame:
    members = families.resolve(successors(spark, d))
    r = families.two_ratios(month_sales(spark, d), members, "2000-12-01")
    return r.select("family", "code", R6("test_ratio").alias("test_ratio"), "test_method", R6("forward_ratio").alias("forward_ratio"), "forward_method")


@query(f"""WITH {GRID}, x AS (SELECT key, count(*) FILTER (units > 0) AS a, max(units) AS b FROM grid GROUP BY 1),
r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 AS rb FROM x) SELECT round(corr(ra, rb), 6) AS rho, count(*) AS n FROM r""")
def rank_correlation(spark: SparkSession, d: str) -> DataFrame:
    x = month_grid(spark, d).groupBy("key").agg(F.count_if(F.col("units") > 0).alias("a"), F.max("units").alias("b"))
    return scoring.spearman(x, "a", "b").select(R6("rho").alias("rho"), "n")


@query(f"""WITH {SALES}, a AS (SELECT key, month, units FROM sales WHERE month > DATE '2000-12-01'), c AS (SELECT a.key, a.month, a.units AS actual, p.units AS prior, m.units AS sheet FROM a LEFT JOIN sales p ON p.key = a.key AND p.month = a.month - INTERVAL 12 MONTH LEFT JOIN sales m ON m.key = a.key AND m.month = a.month - INTERVAL 1 MONTH),
e AS (SELECT key, month, round(100 * abs(actual - sheet) / nullif(actual, 0), 6) AS es, round(100 * abs(actual - prior) / nullif(actual, 0), 6) AS ep FROM c)
SELECT key, strftime(month, '%Y-%m') AS ym, es AS sheet_error, ep AS prior_error, CASE WHEN es IS NULL AND ep IS NULL THEN NULL WHEN ep IS NULL OR es <= ep THEN 'sheet' ELSE 'prior_year' END AS winner FROM e""")
def benchmark_winners(spark: SparkSession, d: str) -> DataFrame:
    s = month_sales(spark, d)
    back = lambda n, name: s.select("key", F.add_months("month", n).alias("month"), F.col("units").alias(name))
    c = s.where("month > '2000-12-01'").join(back(12, "prior"), ["key", "month"], "left").join(back(1, "sheet"), ["key", "month"], "left")
    err = lambda p: R6(scoring.absolute_percentage_error(F.col("units"), F.col(p)))
    c = c.withColumns({"sheet_error": err("sheet"), "prior_error": err("prior")})
    return c.select("key", F.date_format("month", "yyyy-MM").alias("ym"), "sheet_error", "prior_error", scoring.winner({"sheet": F.col("sheet_error"), "prior_year": F.col("prior_error")}).alias("winner"))


@query(f"""WITH {_FOLDS}, x AS (SELECT method, key % 10 AS cohort, predicted, actual FROM scored) SELECT coalesce(CAST(cohort AS VARCHAR), 'ALL') AS cohort, method, count(*) AS "rows", round(sum(abs(predicted - actual)) / nullif(sum(actual), 0), 6) AS wape FROM x GROUP BY GROUPING SETS ((cohort, method), (method))""")
def cohort_accuracy(spark: SparkSession, d: str) -> DataFrame:
    x = _folds(spark, d).select("method", (F.col("key") % 10).cast("string").alias("cohort"), "predicted", "actual")
    g = x.rollup("method", "cohort").agg(F.count("*").alias("rows"), R6(scoring.wape(F.col("actual"), F.col("predicted"))).alias("wape"))
    return g.where("method is not null").select(F.coalesce("cohort", F.lit("ALL")).alias("cohort"), "method", "rows", "wape")


@query()
def regression_forecast(spark: SparkSession, d: str) -> DataFrame:
    return models.fit_models(month_grid(spark, d), "trend_and_season")


@query(f"""WITH RECURSIVE {GRID}, g AS (SELECT key, i, n, units FROM grid WHERE n >= 24),
tried AS (SELECT a, b, phi FROM (SELECT unnest([0.1, 0.3, 0.5, 0.8])::DOUBLE AS a), (SELECT unnest([0.01, 0.1, 0.3])::DOUBLE AS b), (SELECT unnest([0.8, 0.9, 0.98])::DOUBLE AS phi)),
walk AS (SELECT key, n, a, b, phi, 1::BIGINT AS i, units AS level, 0.0::DOUBLE AS slope, 0.0::DOUBLE AS sse FROM g, tried WHERE i = 1
  UNION ALL SELECT key, n, a, b, phi, i, nw, b * (nw - level) + (1 - b) * phi * slope, sse + (y - ahead) * (y - ahead) FROM (SELECT *, a * y + (1 - a) * ahead AS nw FROM (
    SELECT w.key, w.n, a, b, phi, g.i, level, slope, sse, g.units AS y, level + phi * slope AS ahead FROM walk w JOIN g ON g.key = w.key AND g.i = w.i + 1))),
best AS (SELECT key, n, arg_min({{'sse': round(sse, 4), 'phi': phi, 'level': level, 'slope': slope}}, (round(sse, 4), a, b, phi)) AS f FROM walk WHERE i = n GROUP BY 1, 2),
x AS (SELECT key, s.step, f.level + f.slope * f.phi * (1 - f.phi ** s.step) / (1 - f.phi) AS y, 1.96 * sqrt(f.sse / (n - 1)) AS w FROM best, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step) s)
SELECT key, CAST(step AS INTEGER) AS step, round(greatest(y, 0) + 1e-9, 4) AS yhat, round(greatest(y - w, 0) + 1e-9, 4) AS yhat_lower, round(greatest(y + w, 0) + 1e-9, 4) AS yhat_upper FROM x""")
def holt_forecast(spark: SparkSession, d: str) -> DataFrame:
    out = forecast.holt(forecast.histories(month_grid(spark, d), min_history=24), 6)
    return out.select("key", "step", *(F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")))


@query("""SELECT c_mktsegment AS channel, count(DISTINCT o_custkey) AS customers, strftime(o_orderdate, '%Y-%m') AS ym, round(sum(o_totalprice), 2) AS amount, count(*) AS "rows" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 3""")
def training_facts(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    price = F.sum(F.col("o_totalprice").cast("decimal(18,4)"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("channel"), F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(
        F.count_distinct("o_custkey").alias("customers"), F.round(price, 2).cast("double").alias("amount"), F.count("*").alias("rows")
    )


@query("""WITH m AS (SELECT o_custkey AS customer, c_mktsegment AS channel, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), n AS (SELECT n_name AS nation, channel, sum(n) AS n FROM m JOIN customer ON c_custkey = customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
SELECT nation, channel, round(n / sum(n) OVER (PARTITION BY nation), 6) AS share FROM n""")
def channel_mix(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    g = j.groupBy(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("channel")).agg(F.count("*").alias("n"))
    return g.select("nation", "channel", R6(F.col("n") / F.sum("n").over(Window.partitionBy("nation"))).alias("share"))
