"""Quality checks of periodic reports. Rows: (market, item, kind, start, end, currency, measures).

item 'ALL' is the market's own total; MONTH and WEEK rows overlap and are never summed together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.dates import month_start


def missing_totals(rows: DataFrame) -> DataFrame:
    """(market, kind, start) of loaded periods without an ALL row."""
    periods = rows.select("market", "kind", "start").distinct()
    return periods.join(rows.where("item = 'ALL'").select("market", "kind", "start"), ["market", "kind", "start"], "left_anti")


def totals_against_items(rows: DataFrame, measure: str, tolerance: float = 0.0) -> DataFrame:
    """(market, kind, start, total, items) of periods whose items do not add up to the ALL row."""
    value = F.col(measure)
    g = rows.groupBy("market", "kind", "start").agg(F.sum(F.when(F.col("item") == "ALL", value)).alias("total"), F.sum(F.when(F.col("item") != "ALL", value)).alias("items"))
    return g.where(F.abs(F.col("total") - F.coalesce("items", F.lit(0.0))) > tolerance)


def weeks_against_months(rows: DataFrame, measure: str) -> DataFrame:
    """(market, start, month_value, week_value, weeks) of ALL rows: a week belongs to its Saturday's month.

    The range condition "week ends inside the month" is an equality of month starts.
    """
    total = rows.where("item = 'ALL'")
    months = total.where("kind = 'MONTH'").select("market", "start", F.col(measure).alias("month_value"))
    weeks = total.where("kind = 'WEEK'").groupBy("market", month_start(F.col("end")).alias("start")).agg(F.sum(measure).alias("week_value"), F.count("*").alias("weeks"))
    return months.join(weeks, ["market", "start"], "left").select("market", "start", "month_value", "week_value", F.coalesce("weeks", F.lit(0)).alias("weeks"))


def null_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls, rows)."""
    counts = rows.agg(F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot("rows", list(columns), "column", "nulls").select("column", "nulls", "rows")


def month_coverage(rows: DataFrame) -> DataFrame:
    """(market, months, first_month, last_month, gaps) of the MONTH rows."""
    m = rows.where("kind = 'MONTH'")
    g = m.groupBy("market").agg(F.countDistinct("start").alias("months"), F.min("start").alias("first_month"), F.max("start").alias("last_month"))
    return g.withColumn("gaps", (F.months_between("last_month", "first_month") + 1).cast("long") - F.col("months"))


def freshness(rows: DataFrame, today: str, most_days: int) -> DataFrame:
    """(market, last_end, age) of markets whose newest period is older than most_days."""
    g = rows.groupBy("market").agg(F.max("end").alias("last_end"))
    return g.withColumn("age", F.datediff(F.to_date(F.lit(today)), "last_end")).where(F.col("age") > most_days)


def currencies(rows: DataFrame) -> DataFrame:
    """(market, currencies) of markets with several, as one sorted text."""
    g = rows.where("currency is not null").groupBy("market").agg(F.array_sort(F.collect_set("currency")).alias("c"))
    return g.where(F.size("c") > 1).select("market", F.array_join("c", " | ").alias("currencies"))


def unmapped(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key) != "ALL").select(key).distinct().join(known, key, "left_anti")


def month_completeness(monthly: DataFrame, *, min_seasonal: float = 0.60, min_items: float = 0.70, min_cover: float = 0.75, baseline: int = 6) -> DataFrame:
    """Is each month's data complete? monthly: (item, month, qty, txns), one row an item and month.

    Transactions against the same month a year before, by the growth of the 12 months before; items
    against the median of the six months before; and of the items seen in at least five of those six,
    the share that is seen. Months too early for the first figure count as complete. Months are those
    with data; their table, a row a month, is ordered in one task.
    """
    by_month = monthly.groupBy("month").agg(F.count_distinct("item").alias("items"), F.sum("txns").alias("txns"), F.sum("qty").alias("qty"))
    w = Window.orderBy("month")
    frame = lambda a, b: w.rowsBetween(a, b)
    full = lambda c, a, b: F.when(F.count("*").over(frame(a, b)) == b - a + 1, F.sum(c).over(frame(a, b)))
    last_year = F.lag("txns", 12).over(w)
    m = by_month.select(
        "*", F.row_number().over(w).alias("i"), F.try_divide("txns", F.nullif(last_year, F.lit(0))).alias("yoy"),
        F.try_divide(full("txns", -12, -1), F.nullif(full("txns", -24, -13), F.lit(0))).alias("level"),
        F.when(F.count("*").over(frame(-baseline, -1)) == baseline, F.percentile("items", F.lit(0.5)).over(frame(-baseline, -1))).alias("usual_items"),
    )
    # an item is a regular of the months after it was seen in five of six
    seen = monthly.select("item", "month").distinct().join(m.select("month", "i"), "month")
    ahead = seen.select("item", F.explode(F.sequence(F.col("i") + 1, F.col("i") + baseline)).alias("i")).groupBy("item", "i").count().where(F.col("count") >= baseline - 1)
    regular = ahead.join(seen.select("item", "i", F.lit(1).alias("here")), ["item", "i"], "left").groupBy("i").agg(F.count("*").alias("n_regulars"), F.count("here").alias("n_here"))
    j = m.join(regular, "i", "left")
    early = F.col("i") <= baseline
    seasonal = F.try_divide("yoy", F.nullif("level", F.lit(0.0)))
    item_ratio = F.try_divide("items", F.nullif("usual_items", F.lit(0.0)))
    cover = F.when(~early, F.try_divide("n_here", "n_regulars"))
    bad = [F.coalesce(x < y, F.lit(False)) for x, y in ((seasonal, min_seasonal), (item_ratio, min_items), (cover, min_cover))]
    return j.select(
        "month", "items", "txns", "qty", seasonal.alias("seasonal_ratio"), item_ratio.alias("item_ratio"), cover.alias("regular_cover"),
        F.when(seasonal.isNull(), True).otherwise(~(bad[0] | bad[1] | bad[2])).alias("is_complete"),
    )


def channel_mismatch(rows: DataFrame, channel: str, anchor: str, share: float = 0.90, most_other: float = 60, least_total: float = 300) -> DataFrame:
    """(item, total, other) of items that one channel takes almost alone in the 12 months to the anchor."""
    end = F.to_date(F.lit(anchor))
    late = rows.where((F.col("month") <= end) & (F.col("month") > F.add_months(end, -12)))
    own = F.coalesce("channel", F.lit("")) == channel
    g = late.groupBy("item").agg(F.sum("qty").alias("total"), F.sum(F.when(~own, F.col("qty")).otherwise(0.0)).alias("other"))
    return g.where((F.col("total") >= least_total) & (F.col("other") < most_other) & ((F.col("total") - F.col("other")) >= share * F.col("total")))


def forecast_is_valid(weekly: DataFrame, weeks: int = 48) -> DataFrame:
    """(key, version, rows, contiguous, negative, unordered, is_valid) of weekly (key, version, week_end, mean, p70, p80, p90).

    contiguous: `weeks` weeks, one after the other, each once. negative: rows with any of the four values
    below 0. unordered: rows that have all three percentiles but not p70 <= p80 <= p90.
    """
    day = F.col("week_end")
    below = [F.coalesce(F.col(c) < 0, F.lit(False)) for c in ("mean", "p70", "p80", "p90")]
    disorder = (F.col("p70") > F.col("p80")) | (F.col("p80") > F.col("p90"))
    complete = F.col("p70").isNotNull() & F.col("p80").isNotNull() & F.col("p90").isNotNull()
    g = weekly.groupBy("key", "version").agg(
        F.count("*").alias("rows"), F.count_distinct("week_end").alias("n"), F.datediff(F.max(day), F.min(day)).alias("span"),
        F.count_if(below[0] | below[1] | below[2] | below[3]).alias("negative"), F.count_if(complete & disorder).alias("unordered"),
    )
    g = g.withColumn("contiguous", (F.col("n") == weeks) & (F.col("rows") == weeks) & (F.col("span") == 7 * (weeks - 1)))
    return g.select("key", "version", "rows", "contiguous", "negative", "unordered", (F.col("contiguous") & (F.col("negative") == 0) & (F.col("unordered") == 0)).alias("is_valid"))


def ambiguous_values(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, values) of keys with several values, as one sorted text."""
    g = rows.where(F.col(value).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("v"))
    return g.where(F.size("v") > 1).select(key, F.size("v").alias("n"), F.array_join("v", " | ").alias("values"))


def snapshot_side(weeks: DataFrame, days: DataFrame) -> DataFrame:
    """(compared, first_day, last_day): is a week's stock that of its first or of its last day?

    weeks: (item, start, end, stock), days: (item, day, stock).
    """
    day = lambda on, name: days.select("item", F.col("day").alias(on), F.col("stock").alias(name))
    j = weeks.join(day("start", "first"), ["item", "start"]).join(day("end", "last"), ["item", "end"])
    return j.agg(F.count("*").alias("compared"), F.count_if(F.col("stock") == F.col("first")).alias("first_day"), F.count_if(F.col("stock") == F.col("last")).alias("last_day"))
