"""Accuracy of forecasts and comparison of methods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import middle, total
from .ordered import ordered_counts


def wape(actual: Column, predicted: Column) -> Column:
    """Sum of absolute errors by sum of absolute actuals; null where the actuals are all 0."""
    return F.try_divide(F.sum(F.abs(predicted - actual)), F.nullif(F.sum(F.abs(actual)), F.lit(0.0)))


def bias(actual: Column, predicted: Column) -> Column:
    return F.try_divide(F.sum(predicted - actual), F.nullif(F.sum(actual), F.lit(0.0)))


def mape_percent(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over actuals that are not 0."""
    return 100 * F.avg(F.when(actual != 0, F.abs((actual - predicted) / actual)))


def metrics(actual: Column, predicted: Column, digits: int = 2) -> list[Column]:
    """mae, rmse, mape, wape and bias (percent), rounded half to even."""
    e = predicted - actual
    values = {
        "mae": F.avg(F.abs(e)), "rmse": F.sqrt(F.avg(e * e)), "mape": mape_percent(actual, predicted),
        "wape": 100 * wape(actual, predicted), "bias": 100 * bias(actual, predicted),
    }
    return [F.bround(v, digits).alias(k) for k, v in values.items()]


def score_by_series(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """(method, rows, wape, bias) at series and month level; a month without an actual counts as 0."""
    joined = predicted.join(actual.select("key", F.col("month").alias("target_month"), F.col("units").alias("actual")), ["key", "target_month"], "left")
    joined = joined.withColumn("actual", F.coalesce("actual", F.lit(0.0)))
    return joined.groupBy("method").agg(F.count("*").alias("rows"), wape(F.col("actual"), F.col("predicted")).alias("wape"), bias(F.col("actual"), F.col("predicted")).alias("bias"))


def score_totals(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """(method, rows, wape, bias) of monthly totals, in two aggregation steps."""
    totals = predicted.groupBy("method", "train_end", "target_month").agg(F.sum("predicted").alias("predicted"))
    real = actual.groupBy(F.col("month").alias("target_month")).agg(F.sum("units").alias("actual"))
    joined = totals.join(real, "target_month", "left").withColumn("actual", F.coalesce("actual", F.lit(0.0)))
    return joined.groupBy("method").agg(F.count("*").alias("rows"), wape(F.col("actual"), F.col("predicted")).alias("wape"), bias(F.col("actual"), F.col("predicted")).alias("bias"))


def coverage(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """Share of the actual volume that belongs to series with a forecast."""
    keys = predicted.select("key").distinct().withColumn("has", F.lit(True))
    return actual.join(keys, "key", "left").agg(F.try_divide(F.sum(F.when(F.col("has"), F.col("units"))), F.sum("units")).alias("coverage"))


def winner(errors: dict[str, Column]) -> Column:
    """Name of the least error; of equal ones the first listed; null where all are null."""
    ranked = F.array(*(F.when(e.isNotNull(), F.struct(e.alias("e"), F.lit(i).alias("i"), F.lit(k).alias("k"))) for i, (k, e) in enumerate(errors.items())))
    return F.array_min(F.filter(ranked, lambda x: x.isNotNull()))["k"]


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    return 100 * F.try_divide(F.abs(actual - predicted), F.nullif(F.abs(actual), F.lit(0.0)))


def score_folds(errors: DataFrame) -> DataFrame:
    """(method, rows, wape, bias) of forecast.fold_errors; actuals are not negative."""
    actual = F.nullif(F.sum("actual"), F.lit(0.0))
    return errors.groupBy("method").agg(F.sum("steps").alias("rows"), F.try_divide(F.sum("absolute"), actual).alias("wape"), F.try_divide(F.sum("error"), actual).alias("bias"))


def item_scores(errors: DataFrame) -> DataFrame:
    """(key, method, folds, mean_wape, median_wape, pooled_wape) of forecast.fold_errors; a fold without units counts, but has no error."""
    each = errors.withColumn("w", F.try_divide("absolute", F.nullif("actual", F.lit(0.0))))
    g = each.groupBy("key", "method").agg(F.count("*").alias("folds"), F.collect_list("w").alias("w"), F.sum("absolute").alias("e"), F.sum("actual").alias("a"))  # a number a fold
    return g.select("key", "method", "folds", F.try_divide(total(F.col("w")), F.size("w")).alias("mean_wape"), middle(F.col("w")).alias("median_wape"), F.try_divide("e", F.nullif("a", F.lit(0.0))).alias("pooled_wape"))


def tournament(scores: DataFrame, current: str, min_folds: int = 3, margin: float = 0.05) -> DataFrame:
    """(key, best, best_wape, current_wape, folds, verdict) of scores (key, method, folds, median_wape).

    best has the least median error, of equals the first by name. The current method stays where no
    method was scored on min_folds folds, where it is the best itself, where it has no score, and where
    the gain is not more than the margin. folds: the most that any method of the item has.
    """
    at = F.when(F.col("median_wape").isNotNull(), F.struct("median_wape", "method"))
    g = scores.groupBy("key").agg(F.min(at).alias("b"), F.max(F.when(F.col("method") == current, F.col("median_wape"))).alias("current_wape"), F.max("folds").alias("folds"))
    g = g.select("key", F.col("b.method").alias("best"), F.col("b.median_wape").alias("best_wape"), "current_wape", "folds")
    gain = F.col("current_wape") - F.col("best_wape")
    verdict = (
        F.when(F.col("folds") < min_folds, "too_few_folds").when(F.col("best").isNull() | (F.col("best") == current), "keep").when(F.col("current_wape").isNull(), "no_baseline")
        .when(gain > margin + 1e-9, "switch").otherwise("keep_within_margin")
    )
    return g.select("*", verdict.alias("verdict"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation of two columns, ties at their average rank; one row.

    Ranks come from counts by value, which are ordered by ranges.
    """
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("n"))
    weighed = lambda c: known.groupBy(c).agg(F.sum("n").alias("n"))

    def ranks(c: str) -> DataFrame:
        return ordered_counts(weighed(c), F.col(c), F.col("n")).select(F.col("value").alias(f"_{c}"), (F.col("before") + (F.col("n") + 1) / 2).alias(f"rank_{c}"))

    # equal pairs are one row, so a value that most rows share meets its rank once for each value beside it
    both = known.join(ranks("x"), F.col("x") == F.col("_x")).join(ranks("y"), F.col("y") == F.col("_y"))
    a, b, n = F.col("rank_x"), F.col("rank_y"), F.col("n")
    s = both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *(F.sum(e).alias(k) for k, e in (("a", a * n), ("b", b * n), ("aa", a * a * n), ("bb", b * b * n), ("ab", a * b * n))))
    spread = lambda p, q, pq: F.col(pq) - F.col(p) * F.col(q) / F.col("n")
    scale = F.sqrt(spread("a", "a", "aa") * spread("b", "b", "bb"))
    return s.select(F.try_divide(spread("a", "b", "ab"), F.nullif(scale, F.lit(0.0))).alias("rho"), "n")


def two_grain_accuracy(rows: DataFrame, item: str = "item", family: str = "family") -> DataFrame:
    """(grain, name, rows, wape, bias) of items and of families, in one grouping-sets pass.

    A family's errors are those of its monthly totals, so rows are summed by family and month first.
    """
    by_item = rows.groupBy(F.lit("item").alias("grain"), F.col(item).cast("string").alias("name"), "month").agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
    by_family = rows.groupBy(F.lit("family").alias("grain"), F.col(family).cast("string").alias("name"), "month").agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
    return by_item.unionByName(by_family).groupBy("grain", "name").agg(F.count("*").alias("rows"), wape(F.col("actual"), F.col("predicted")).alias("wape"), bias(F.col("actual"), F.col("predicted")).alias("bias"))


def split_error(rows: DataFrame) -> DataFrame:
    """(family, as_is, perfect_share, family_level): how much of a family's error its split makes.

    rows: (family, item, month, actual, predicted). perfect_share divides the family's forecast by the
    items' real shares of the month, so its error is that of the family's level alone.
    """
    w = Window.partitionBy("family", "month")
    r = rows.select("*", F.sum("actual").over(w).alias("fa"), F.sum("predicted").over(w).alias("fp"))
    perfect = F.when(F.col("fa") != 0, F.col("fp") * F.col("actual") / F.col("fa")).otherwise(F.col("predicted"))
    items = r.groupBy("family").agg(wape(F.col("actual"), F.col("predicted")).alias("as_is"), wape(F.col("actual"), perfect).alias("perfect_share"))
    level = rows.groupBy("family", "month").agg(F.sum("actual").alias("a"), F.sum("predicted").alias("p")).groupBy("family").agg(wape(F.col("a"), F.col("p")).alias("family_level"))
    return items.join(level, "family")


def bucket_curve(rows: DataFrame, value: str, count: str, cuts: tuple[int, ...]) -> DataFrame:
    """(bucket, items, mean, median) of a value by ranges of a count: up to each cut, and above."""
    bucket = F.when(F.col(count) <= cuts[0], F.lit(f"0-{cuts[0]}"))
    for a, b in zip(cuts, cuts[1:], strict=False):
        bucket = bucket.when(F.col(count) <= b, F.lit(f"{a + 1}-{b}"))
    return rows.groupBy(bucket.otherwise(f"{cuts[-1] + 1}+").alias("bucket")).agg(F.count("*").alias("items"), F.avg(value).alias("mean"), F.median(value).alias("median"))


def shrinkage(folds: DataFrame, near_zero: float = 0.5) -> DataFrame:
    """(method, bias_ratio, near_zero_share, lost_share): does a method hide in small forecasts?"""
    g = folds.groupBy("method", "key", "train_end").agg(F.sum("predicted").alias("p"), F.sum("actual").alias("a"), wape(F.col("actual"), F.col("predicted")).alias("w"))
    return g.groupBy("method").agg(
        F.try_divide(F.sum("p"), F.nullif(F.sum("a"), F.lit(0.0))).alias("bias_ratio"), F.avg((F.round("p", 9) < near_zero).cast("double")).alias("near_zero_share"), F.avg((F.round("w", 9) == 1).cast("double")).alias("lost_share")
    )


def score_deliveries(batches: DataFrame, actual: DataFrame, complete: DataFrame) -> DataFrame:
    """Delivered forecasts (key, month, yhat, run) with horizon, actual and whether the month can be scored.

    The newest run of each first month counts; an absent actual of a complete month is 0, of others null.
    """
    first = batches.withColumn("first_month", F.min("month").over(Window.partitionBy("run")))
    newest = first.withColumn("newest", F.max("run").over(Window.partitionBy("first_month"))).where("run = newest").drop("newest")
    j = newest.join(actual.select("key", "month", F.col("units").alias("actual")), ["key", "month"], "left").join(complete.select("month", "is_complete"), "month", "left")
    done = F.coalesce("is_complete", F.lit(False))
    horizon = (F.months_between("month", "first_month") + 1).cast("int")
    return j.select("key", "month", "run", "first_month", horizon.alias("horizon"), "yhat", F.when(done, F.coalesce("actual", F.lit(0.0))).alias("actual"), done.alias("month_complete"))
