"""Upserts and versioned stores, as joins; the caller writes the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merged rows with the column action: insert, update, keep (source equal or absent).

    A row is an update only if some other column differs, nulls being equal to nulls. Nothing is
    deleted. Both sides hold a key once; see duplicate_keys.
    """
    values = [c for c in target.columns if c not in keys]
    s = source.select(*(F.col(c).alias(f"_{c}") for c in target.columns), F.lit(True).alias("_in"))
    t = target.withColumn("_old", F.lit(True))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = t.join(s, on, "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    action = F.when(F.col("_old").isNull(), "insert").when(F.col("_in").isNull() | same, "keep").otherwise("update")
    new = F.col("_in").isNotNull()
    return joined.select(*(F.when(new, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns), action.alias("action"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def combine(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows without identical copies, keys whose copies differ)."""
    distinct = df.distinct()
    return distinct, duplicate_keys(distinct, keys)


def version_changes(stored: DataFrame, loaded: DataFrame, version: Sequence[str]) -> DataFrame:
    """(version columns, status) of each loaded version: new, unchanged or replaced.

    Contents are compared as sets of rows, nulls being equal to nulls: every different row knows which
    side has it, so neither side is collected, and a version is what its rows say together.
    """
    columns = loaded.columns
    both = loaded.select(*columns, F.lit(True).alias("_new"), F.lit(False).alias("_old")).unionByName(stored.select(*columns, F.lit(False).alias("_new"), F.lit(True).alias("_old")))
    rows = both.groupBy(*columns).agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    found = rows.groupBy(*version).agg(F.max("_new").alias("loaded"), F.max("_old").alias("known"), F.min(F.col("_new") == F.col("_old")).alias("same"))
    status = F.when(~F.col("known"), "new").when(F.col("same"), "unchanged").otherwise("replaced")
    return found.where("loaded").select(*version, status.alias("status"))


def replace_by_key(stored: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """stored without the key groups that loaded has, and loaded; missing columns become null."""
    kept = stored.join(loaded.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(loaded, allowMissingColumns=True)


def latest(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each partition that is last in order."""
    w = Window.partitionBy(*partition).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def numbered_versions(df: DataFrame, partition: Sequence[str], version: str) -> DataFrame:
    """df with version_no (dense, oldest is 1) and is_latest."""
    by = Window.partitionBy(*partition)
    return df.select("*", F.dense_rank().over(by.orderBy(version)).alias("version_no"), (F.col(version) == F.max(version).over(by)).alias("is_latest"))


def not_stored(new: DataFrame, stored: DataFrame, key: str, done: str) -> DataFrame:
    """Rows of new whose key has no stored row where `done` is not null."""
    return new.join(stored.where(F.col(done).isNotNull()).select(key).distinct(), key, "left_anti")


def already_delivered(first_month: str, stored: DataFrame, month: str) -> DataFrame:
    """One row (delivered): is the batch's first month not after the newest stored one?"""
    return stored.agg(F.coalesce(F.lit(first_month) <= F.max(month), F.lit(False)).alias("delivered"))


def fill_column(stored: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """stored with `columns` taken from updates where these have a value; nothing else changes.

    updates holds a key once; keys that are not stored are passed over.
    """
    new = updates.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = stored.join(new, F.col(key) == F.col("_key"), "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in stored.columns))


def split_keys(rows: DataFrame, key: str, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """(rows whose trimmed key has `width` characters, the keys of the others)."""
    trimmed = rows.withColumn(key, F.trim(F.col(key).cast("string")))
    fits = F.coalesce(F.length(key) == width, F.lit(False))
    return trimmed.where(fits), trimmed.where(~fits).select(key)
