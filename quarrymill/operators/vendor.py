"""Vendor reports: nested JSON to rows, week planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.parsing import amount


def flatten_report(reports: DataFrame, total: str, items: str, measures: dict[str, str]) -> DataFrame:
    """(market, item, start, end, measures) from rows (market, json).

    total: an object or a list of objects that becomes item 'ALL'; items: a list of objects with asin.
    Measures are numbers or {amount, currencyCode}.
    """

    def objects(path: str) -> Column:
        text = F.get_json_object("json", path)
        listed = F.when(F.left(F.trim(text), F.lit(1)) == "[", text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
        return F.transform(F.coalesce(F.from_json(listed, "array<variant>"), F.array().cast("array<variant>")), lambda v: F.to_json(v))

    both = F.concat(
        F.transform(objects(f"$.{total}"), lambda j: F.struct(F.lit(True).alias("whole"), j.alias("j"))),
        F.transform(objects(f"$.{items}"), lambda j: F.struct(F.lit(False).alias("whole"), j.alias("j"))),
    )
    rows = reports.select("market", F.explode(both).alias("r"))
    j = F.col("r.j")
    return rows.select(
        "market", F.when(F.col("r.whole"), "ALL").otherwise(F.get_json_object(j, "$.asin")).alias("item"),
        F.try_to_date(F.left(F.get_json_object(j, "$.startDate"), F.lit(10))).alias("start"), F.try_to_date(F.left(F.get_json_object(j, "$.endDate"), F.lit(10))).alias("end"),
        *(amount(j, f"$.{path}").alias(name) for name, path in measures.items()),
    )


def flatten_forecast(reports: DataFrame) -> DataFrame:
    """(market, item, version, start, end, weeks_ahead, mean, p80, p90); an entry's own generation date wins."""
    entries = F.from_json(F.get_json_object("json", "$.forecastByAsin"), "array<struct<asin:string,startDate:string,endDate:string,forecastGenerationDate:string,meanForecastUnits:double,p80ForecastUnits:double,p90ForecastUnits:double>>")
    rows = reports.select("market", F.get_json_object("json", "$.forecastGenerationDate").alias("top"), F.explode(entries).alias("e"))
    day = lambda c: F.try_to_date(F.left(c, F.lit(10)))
    version, start = day(F.coalesce(F.col("e.forecastGenerationDate"), F.col("top"))), day(F.col("e.startDate"))
    return rows.select(
        "market", F.col("e.asin").alias("item"), version.alias("version"), start.alias("start"), day(F.col("e.endDate")).alias("end"),
        F.floor(F.datediff(start, version) / 7).cast("int").alias("weeks_ahead"), F.col("e.meanForecastUnits").alias("mean"), F.col("e.p80ForecastUnits").alias("p80"), F.col("e.p90ForecastUnits").alias("p90"),
    )


def week_windows(weeks: DataFrame, most: int = 7) -> DataFrame:
    """(market, first_week, last_week, weeks): runs of neighbouring Saturdays, cut to `most` weeks."""
    w = Window.partitionBy("market").orderBy("week_end")
    new = F.coalesce(F.datediff("week_end", F.lag("week_end").over(w)) != 7, F.lit(True))
    runs = weeks.distinct().withColumn("new", new).withColumn("run", F.sum(F.col("new").cast("int")).over(w))
    part = F.floor((F.row_number().over(Window.partitionBy("market", "run").orderBy("week_end")) - 1) / most)
    return runs.withColumn("part", part).groupBy("market", "run", "part").agg(F.min("week_end").alias("first_week"), F.max("week_end").alias("last_week"), F.count("*").alias("weeks")).drop("run", "part")


def weeks_to_fetch(stored: DataFrame, newest: str, lookback: int = 6) -> DataFrame:
    """(market, week_end) of the last `lookback` published weeks that a market has not stored."""
    saturdays = F.sequence(F.date_sub(F.to_date(F.lit(newest)), 7 * (lookback - 1)), F.to_date(F.lit(newest)), F.expr("interval 7 day"))
    asked = stored.select("market").distinct().select("market", F.explode(saturdays).alias("week_end"))
    return asked.join(stored.select("market", "week_end").distinct(), ["market", "week_end"], "left_anti")
