"""Product families: codes that replace each other, pooled for a forecast and split back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import connected_components

WINDOW_MONTHS, MIN_MONTHS = 6, 3


def resolve(successors: DataFrame) -> DataFrame:
    """(family, code, is_current, changeover) from rows (old, new, changeover).

    A family is a connected component; its key is the least old code; its current codes are members
    that no row replaces; its changeover is the earliest. Rows with a null or equal code are left out.
    """
    edges = successors.where("old is not null and new is not null and old <> new")
    members = connected_components(edges.select(F.col("old").alias("a"), F.col("new").alias("b")))
    olds = edges.groupBy(F.col("old").alias("node")).agg(F.min("changeover").alias("changeover"))
    joined = members.join(edges.select(F.col("old").alias("node")).distinct().withColumn("is_old", F.lit(True)), "node", "left").join(olds, "node", "left")
    w = Window.partitionBy("component")
    return joined.select(
        F.min(F.when(F.col("is_old"), F.col("node"))).over(w).alias("family"), F.col("node").alias("code"),
        F.col("is_old").isNull().alias("is_current"), F.min("changeover").over(w).alias("changeover"),
    )


def pool(series: DataFrame, members: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """(key, month, units): member codes summed under their family, all others as they are.

    active: codes of which a family needs a current one; families without it are not pooled.
    """
    usable = members
    if active is not None:
        alive = members.where("is_current").join(active.select("code").distinct(), "code", "left_semi").select("family").distinct()
        usable = members.join(alive, "family", "left_semi")
    named = series.join(usable.select(F.col("code").alias("key"), "family"), "key", "left")
    return named.groupBy(F.coalesce("family", "key").alias("key"), "month").agg(F.sum("units").alias("units"))


def split_ratios(series: DataFrame, members: DataFrame, cutoff: str | None = None) -> DataFrame:
    """(family, code, ratio, method) of the current codes, from months up to the cutoff.

    A code's share of the family's last six months with sales after the changeover; equal shares if
    some code sold in fewer than three such months or nothing was sold; 1 for a single code.
    """
    current = members.where("is_current")
    sold = series.join(current, F.col("key") == F.col("code")).where(F.col("changeover").isNull() | (F.col("month") >= F.col("changeover")))
    if cutoff:
        sold = sold.where(F.col("month") <= F.to_date(F.lit(cutoff)))
    recent = F.dense_rank().over(Window.partitionBy("family").orderBy(F.col("month").desc())) <= WINDOW_MONTHS
    sold = sold.select("family", "code", "month", "units", recent.alias("recent"))
    facts = sold.groupBy("family", "code").agg(F.countDistinct(F.when(F.col("units") > 0, F.col("month"))).alias("months"), F.sum(F.when(F.col("recent"), F.col("units"))).alias("total"))
    full = current.select("family", "code").join(facts, ["family", "code"], "left").fillna({"months": 0, "total": 0.0})
    w = Window.partitionBy("family")
    whole, thin, n = F.sum("total").over(w), F.min("months").over(w), F.count("*").over(w)
    observed = (thin >= MIN_MONTHS) & (whole > 0)
    return full.select(
        "family", "code",
        F.when(n == 1, 1.0).when(observed, F.col("total") / F.nullif(whole, F.lit(0.0))).otherwise(1.0 / n).alias("ratio"),
        F.when(n == 1, "single").when(observed, "observed").otherwise("equal").alias("method"),
    )


def two_ratios(series: DataFrame, members: DataFrame, train_end: str) -> DataFrame:
    """Ratios for scoring (months up to train_end) beside those for the future (all months)."""
    test = split_ratios(series, members, train_end).select("family", "code", F.col("ratio").alias("test_ratio"), F.col("method").alias("test_method"))
    ahead = split_ratios(series, members).select("family", "code", F.col("ratio").alias("forward_ratio"), F.col("method").alias("forward_method"))
    return test.join(ahead, ["family", "code"], "full_outer").withColumn("ratio_delta", F.col("forward_ratio") - F.col("test_ratio"))


def split_forecast(forecast: DataFrame, ratios: DataFrame, value: str = "predicted") -> DataFrame:
    """Forecasts of families (key) as rows of their codes; other keys as they are."""
    joined = forecast.join(ratios.select(F.col("family").alias("key"), "code", "ratio"), "key", "left")
    return joined.withColumn(value, F.col(value) * F.coalesce("ratio", F.lit(1.0))).withColumn("item", F.coalesce("code", "key")).drop("code", "ratio")
