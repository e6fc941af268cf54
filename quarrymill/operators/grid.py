"""Dense monthly grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.dates import month_start


def monthly_series(df: DataFrame, key: str, when: str, value: str) -> DataFrame:
    """(key, month, units): sums by calendar month."""
    return df.groupBy(F.col(key).alias("key"), month_start(F.col(when)).alias("month")).agg(F.sum(F.col(value).cast("double")).alias("units"))


def dense_grid(series: DataFrame, *, before_first: str = "drop", empty: float | None = 0.0, carry: Sequence[str] = ()) -> DataFrame:
    """(key, month, units, i, n): every month to the last month of the table.

    before_first: 'drop' starts a key at its first month, 'null' shows the months before it as null.
    empty: the value of a month without a row after the first (None keeps it null). i counts from 1.
    carry: further columns of series, null in a month without a row.
    """
    bounds = series.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    keys = series.groupBy("key").agg(F.min("month").alias("first"))
    months = keys.crossJoin(F.broadcast(bounds)).select("key", "first", F.explode(F.expr(f"sequence({'lo' if before_first == 'null' else 'first'}, hi, interval 1 month)")).alias("month"))  # bounds is one row
    units = F.coalesce("units", F.lit(empty)) if empty is not None else F.col("units")
    w = Window.partitionBy("key").orderBy("month")
    return months.join(series, ["key", "month"], "left").select(
        "key", "month", F.when(F.col("month") >= F.col("first"), units).alias("units"),
        *carry, F.row_number().over(w).alias("i"), F.count("*").over(Window.partitionBy("key")).alias("n"),
    )


def last_known(value: Column, key: str = "key", month: str = "month", within: int = 3) -> Column:
    """The latest value that is not null among the last `within` months of a dense grid."""
    w = Window.partitionBy(key).orderBy(month).rowsBetween(1 - within, 0)
    return F.last(value, ignorenulls=True).over(w)


def trailing_mean(value: Column, months: int) -> Column:
    """Sum over the last `months` rows of the grid divided by `months`, zeros and absent rows included."""
    w = Window.partitionBy("key").orderBy("month").rowsBetween(1 - months, 0)
    return F.sum(value).over(w) / months


def autocorrelation(grid: DataFrame, lags: tuple[int, ...] = (1, 2, 3, 6, 12)) -> DataFrame:
    """(key, acf_k ...): biased autocorrelations of the grid; null for a constant series."""
    whole, order = Window.partitionBy("key"), Window.partitionBy("key").orderBy("month")
    centred = grid.withColumn("d", F.col("units") - F.avg("units").over(whole))
    for k in lags:
        centred = centred.withColumn(f"d{k}", F.lag("d", k).over(order))
    total = F.sum(F.col("d") * F.col("d"))
    return centred.groupBy("key").agg(*(F.try_divide(F.coalesce(F.sum(F.col("d") * F.col(f"d{k}")), F.lit(0.0)), F.nullif(total, F.lit(0.0))).alias(f"acf_{k}") for k in lags))


def trend(grid: DataFrame, recent: int = 6, least: int = 12) -> DataFrame:
    """(key, slope, recent_slope, divergence) of series with at least `least` months."""
    late = F.col("i") > F.col("n") - recent
    out = grid.where(F.col("n") >= least).groupBy("key").agg(
        F.regr_slope("units", "i").alias("slope"),
        F.regr_slope(F.when(late, F.col("units")), F.when(late, F.col("i"))).alias("recent_slope"),
    )
    return out.withColumn("divergence", F.col("recent_slope") - F.col("slope"))


def zero_rates(grid: DataFrame, share: float = 0.1) -> DataFrame:
    """(key, zero_rate, near_zero_rate): months at 0, and at most `share` of the median positive month."""
    level = F.median(F.when(F.col("units") > 0, F.col("units"))).over(Window.partitionBy("key"))
    marked = grid.withColumn("level", level)
    near = F.col("units") <= F.coalesce(F.col("level") * share, F.lit(0.0))
    return marked.groupBy("key").agg(F.avg((F.col("units") == 0).cast("double")).alias("zero_rate"), F.avg(near.cast("double")).alias("near_zero_rate"))


def tile_features(grid: DataFrame, width: int = 12) -> DataFrame:
    """(key, lumpiness, stability): sample variance of whole tiles' sample variances, and of their means; null below two tiles."""
    whole = F.floor(F.col("n") / width)
    tiles = grid.groupBy("key", F.floor((F.col("i") - 1) / width).alias("tile"), whole.alias("tiles")).agg(F.var_samp("units").alias("v"), F.avg("units").alias("m"))
    inside = (F.col("tile") < F.col("tiles")) & (F.col("tiles") >= 2)
    return tiles.groupBy("key").agg(F.var_samp(F.when(inside, F.col("v"))).alias("lumpiness"), F.var_samp(F.when(inside, F.col("m"))).alias("stability"))
