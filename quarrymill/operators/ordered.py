"""Ranks and medians over whole tables, without an order of all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_checkpoints


def ordered_counts(df: DataFrame, value: Column, weight: Column | None = None) -> DataFrame:
    """(value, n, before) of each distinct value that is not null: its rows, and the rows of lesser values.

    weight: how many rows a row stands for.
    Values are dealt out by range and counted on within their range; one row a range gives what lies
    before it. The ranges are checkpointed, so that both readings see the same ones.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(value.alias("value"), (F.lit(1) if weight is None else weight).cast("long").alias("weight")).where("value is not null").groupBy("value").agg(F.sum("weight").alias("n"))
    ranged = counts.repartitionByRange(parts, "value").withColumn("_p", F.spark_partition_id()).checkpoint()
    upto = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_p").agg(F.sum("n").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"))  # a row a range
    inner = F.sum("n").over(Window.partitionBy("_p").orderBy("value").rowsBetween(Window.unboundedPreceding, -1))
    return ranged.join(F.broadcast(starts), "_p").select("value", "n", (F.col("_start") + F.coalesce(inner, F.lit(0))).alias("before"))


def exact_medians(df: DataFrame, values: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by, the median of each named column): the mean of the two middle values; null without values.

    All columns and groups go through one count, one deal by range and one checkpoint. `by` is for a
    short list of groups, such as origins; without it there is one row.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, "which"]
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("which"), v.cast("double").alias("value")) for k, v in enumerate(values.values())))).alias("e")
    counts = df.select(*by, each).select(*by, "e.which", "e.value").where("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange(parts, *keys, "value").withColumn("_p", F.spark_partition_id()).checkpoint()
    ranges = ranged.groupBy(*keys, "_p").agg(F.sum("n").alias("_n"))  # a row a range, column and group
    column = Window.partitionBy(*keys)
    upto = column.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*keys, "_p", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"), F.sum("_n").over(column).alias("_total"))
    inner = F.sum("n").over(Window.partitionBy(*keys, "_p").orderBy("value").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn("inner", F.coalesce(inner, F.lit(0))).join(F.broadcast(starts), [*keys, "_p"])
    before, last = F.col("_start") + F.col("inner"), F.col("_total") - 1
    inside = lambda k: (before <= k) & (k < before + F.col("n"))
    at = lambda k, which: F.max(F.when((F.col("which") == which) & inside(k), F.col("value")))
    return placed.groupBy(*by).agg(*(((at(F.floor(last / 2), k) + at(F.ceil(last / 2), k)) / 2).alias(name) for k, name in enumerate(values)))


def exact_median(df: DataFrame, value: Column, name: str) -> DataFrame:
    return exact_medians(df, {name: value})
