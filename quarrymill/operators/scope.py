"""What is in scope of a forecast: active items, channels, enough history, families and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_items(rows: DataFrame, seen: DataFrame, since: str, key: str = "key", month: str = "month") -> DataFrame:
    """Rows whose item has a row in `seen` since a month."""
    alive = seen.where(F.col(month) >= F.lit(since).cast("date")).select(key).distinct()
    return rows.join(alive, key, "left_semi")


def without_channel(rows: DataFrame, channel: str, excluded: str) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded); a null channel is kept."""
    own = F.trim(F.coalesce(F.col(channel), F.lit(""))) == excluded
    return rows.where(~own), rows.where(own)


def forecastable(series: DataFrame, train_end: str, least: int = 24) -> DataFrame:
    """Series with rows in at least `least` different months up to train_end."""
    end = F.lit(train_end).cast("date")
    enough = series.where(F.col("month") <= end).groupBy("key").agg(F.count_distinct("month").alias("m")).where(F.col("m") >= least)
    return series.join(enough.select("key"), "key", "left_semi")


def family_map(master: DataFrame, code: str, family: str, order: str) -> DataFrame:
    """(code, family): the first row of each trimmed code, blank families as 'Unknown'."""
    named = master.select(F.trim(code).alias("code"), F.coalesce(F.nullif(F.trim(family), F.lit("")), F.lit("Unknown")).alias("family"), F.col(order).alias("_o"))
    return named.where("code <> ''").groupBy("code").agg(F.min_by("family", "_o").alias("family"))


def tag_family(rows: DataFrame, families: DataFrame, code: str) -> DataFrame:
    """rows with the column family; codes without one are 'Unknown'."""
    joined = rows.join(families.select(F.col("code").alias("_code"), "family"), F.trim(F.col(code)) == F.col("_code"), "left").drop("_code")
    return joined.withColumn("family", F.coalesce("family", F.lit("Unknown")))


def unmatched(rows: DataFrame, families: DataFrame, code: str) -> DataFrame:
    """(code): the codes of rows that the map does not have."""
    return rows.select(F.trim(F.col(code)).alias("code")).distinct().join(families.select("code"), "code", "left_anti")


def first_region(rows: DataFrame, key: str, region: str, order: str) -> DataFrame:
    """(key, region): of each item's rows with a region, the first in order."""
    return rows.where(F.col(region).isNotNull()).groupBy(key).agg(F.min_by(region, order).alias("region"))


def request_chunks(first: Column, last: Column, months: int = 15) -> Column:
    """array<struct<start, end>>: the months from first to last in pieces of at most `months`."""
    starts = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr(f"interval {months} month"))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.last_day(F.add_months(s, months - 1)), F.last_day(last)).alias("end")))
