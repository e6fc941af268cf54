"""Demand classes and the route of each item to a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADI_CUT, CV2_CUT, MIN_MONTHS, NEAR = 1.32, 0.49, 4, 0.10
TREND_MONTHS, MIN_TRAIN, MIN_OCCURRENCES = 24, 24, 12


def category(adi: Column, cv2: Column, n: Column) -> Column:
    """The quadrant of demand interval and size variation, or why there is none."""
    return (
        F.when(n == 0, "No Data").when((n < MIN_MONTHS) | adi.isNull() | cv2.isNull(), "Insufficient Data to Classify")
        .when(adi >= ADI_CUT, F.when(cv2 >= CV2_CUT, "Lumpy").otherwise("Intermittent"))
        .otherwise(F.when(cv2 >= CV2_CUT, "Erratic").otherwise("Smooth"))
    )


def near_threshold(adi: Column, cv2: Column) -> Column:
    close = [F.coalesce(F.abs(v - cut) <= cut * NEAR, F.lit(False)) for v, cut in ((adi, ADI_CUT), (cv2, CV2_CUT))]
    return close[0] | close[1]


def classify(series: DataFrame, anchor: str, ddof: int = 0) -> DataFrame:
    """(key, adi, cv2, n_nonzero_months, tenure_months, category, near_threshold, decline_ratio).

    series: (key, month, units). Months after the anchor and months without demand do not count for
    interval and variation; the decline ratio is the rate of the last 24 calendar months by that of
    the 24 before, both from the first month with demand, null without a rate to divide by.
    """
    end = F.to_date(F.lit(anchor))
    sold = series.where(F.col("month") <= end).groupBy("key", "month").agg(F.sum("units").alias("y")).where("y > 0")
    spread = F.var_pop("y") if ddof == 0 else F.var_samp("y")
    facts = sold.groupBy("key").agg(
        F.min("month").alias("first"), F.count("*").alias("n"), spread.alias("v"), F.avg("y").alias("m"),
        F.sum(F.when(F.col("month") > F.add_months(end, -TREND_MONTHS), F.col("y"))).alias("late"),
        F.sum(F.when((F.col("month") <= F.add_months(end, -TREND_MONTHS)) & (F.col("month") > F.add_months(end, -2 * TREND_MONTHS)), F.col("y"))).alias("early"),
    )
    tenure = (F.months_between(end, F.col("first")) + 1).cast("int")
    adi = tenure / F.col("n")
    cv2 = F.when((F.col("n") >= 2) & (F.col("m") != 0), F.col("v") / (F.col("m") * F.col("m")))
    late_months = F.least(tenure, F.lit(TREND_MONTHS))
    early_months = F.least(F.greatest(tenure - TREND_MONTHS, F.lit(0)), F.lit(TREND_MONTHS))
    decline = F.when(F.coalesce("early", F.lit(0.0)) > 0, (F.coalesce("late", F.lit(0.0)) / late_months) / (F.col("early") / early_months))
    made = facts.select("key", adi.alias("adi"), cv2.alias("cv2"), F.col("n").alias("n_nonzero_months"), tenure.alias("tenure_months"), decline.alias("decline_ratio"))
    made = made.withColumn("category", category(F.col("adi"), F.col("cv2"), F.col("n_nonzero_months")))
    classed = ~F.col("category").isin("No Data", "Insufficient Data to Classify")
    return made.withColumn("near_threshold", classed & near_threshold(F.col("adi"), F.col("cv2")))


def route(items: DataFrame) -> DataFrame:
    """items with route, block_reason, qualifying_months and threshold.

    items has category, n_nonzero_months, n_train_months, decline_ratio and the flags is_retired,
    is_active, is_channel_mismatch. Gates are asked in order; the first that applies decides.
    """
    c = F.col
    fitted = c("category").isin("Smooth", "Erratic")
    blocked = (
        F.when(c("is_retired"), "retired").when(~c("is_active"), "inactive").when(c("is_channel_mismatch"), "channel_mismatch")
        .when(c("category") == "No Data", "no_history").when(c("category") == "Insufficient Data to Classify", "unclassified")
        .when(fitted & (c("n_train_months") < MIN_TRAIN), "short_history")
        .when(~fitted & (c("n_nonzero_months") < MIN_OCCURRENCES), "few_occurrences")
    )
    declining = F.coalesce(c("decline_ratio") < 1, F.lit(False))
    way = F.when(blocked.isNotNull(), "blocked").when(fitted, "regression").when(declining, "naive_3").otherwise("naive_12")
    structural = blocked.isin("retired", "inactive", "channel_mismatch")
    by_calendar = fitted & ~F.coalesce(structural, F.lit(False))
    months = F.when(F.coalesce(structural, F.lit(False)), F.lit(None)).when(by_calendar, c("n_train_months")).otherwise(c("n_nonzero_months"))
    unclassed = c("category").isin("No Data", "Insufficient Data to Classify")
    least = F.when(F.coalesce(structural, F.lit(False)), F.lit(None)).when(unclassed, MIN_MONTHS).when(fitted, MIN_TRAIN).otherwise(MIN_OCCURRENCES)
    return items.select("*", way.alias("route"), F.coalesce(blocked, F.lit("")).alias("block_reason"), months.cast("long").alias("qualifying_months"), least.cast("int").alias("threshold"))
