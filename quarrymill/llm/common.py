"""Small pieces that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_base, use_checkpoints

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_base(spark)}/{uuid.uuid4().hex}"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that df does not have."""
    while base in df.columns:
        base = f"{base}_"
    return base


def rows_with(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows of df whose id is (left_anti: is not) in the one column of ids."""
    name = fresh(df, "_id")
    return df.join(ids.toDF(name).distinct(), F.col(id_col) == F.col(name), how)


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*cols: Column) -> Column:
    """A number in [0, 1) that depends only on the given values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def first_rows(df: DataFrame, n: int, order: str, ties: Sequence[str] = ()) -> DataFrame:
    """The n first rows by a column of 64-bit hashes, then by ties.

    Counts by the first 12 bits of the hashes tell the range that holds the n-th row; only the rows
    up to its end are sorted, whatever number of partitions df has. df is read twice.
    """
    top = F.shiftright(F.col(order), 52)
    seen, last = 0, None
    for last, count in sorted(tuple(r) for r in df.groupBy(top.alias("top")).count().collect()):  # 4,096 rows at most
        seen += count
        if seen >= n:
            break
    few = df.where(F.lit(False) if last is None else top <= last)
    return few.orderBy(order, *ties).limit(n)


def ranged_neighbours(df: DataFrame, key: str, carry: list[str], parts: int) -> DataFrame:
    """Each row of (key, *carry) with the row before it in descending order of key (prev_*) and
    the key after it (next_key); the order is a ring. Rows are sorted by range, so no task sees
    more than its range; only one row a range meets in the small table of the borders.
    """
    use_checkpoints(df.sparkSession)
    cols = [key, *carry]
    ranged = df.select(*cols).repartitionByRange(parts, F.col(key).desc()).withColumn("_p", F.spark_partition_id()).checkpoint()
    w = Window.partitionBy("_p").orderBy(F.col(key).desc())
    inner = ranged.select("*", F.lag(F.struct(*cols)).over(w).alias("_prev"), F.lead(key).over(w).alias("_next"))
    edge = ranged.groupBy("_p").agg(F.max_by(F.struct(*cols), key).alias("_top"), F.min_by(F.struct(*cols), key).alias("_end"))
    ring = Window.orderBy("_p")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = edge.select(
        "_p",
        F.coalesce(F.lag("_end").over(ring), F.last("_end").over(whole)).alias("_before"),
        F.coalesce(F.lead(f"_top.{key}").over(ring), F.first(f"_top.{key}").over(whole)).alias("_after"),
    )
    out = inner.join(F.broadcast(edge), "_p")  # one row a partition
    prev = F.coalesce("_prev", "_before")
    return out.select(
        *cols,
        F.coalesce("_next", "_after").alias("next_key"),
        prev[key].alias("prev_key"),
        *(prev[c].alias(f"prev_{c}") for c in carry),
    )
