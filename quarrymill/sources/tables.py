"""Readers and writers of the engine's own tables and of exports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrymill.functions.parsing import clean_text


class MissingColumns(ValueError):
    """A source lacks columns that it must have."""


def require(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{name}: missing {', '.join(missing)}")
    return df


def read_export(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """A CSV export with a header, all text; rows without any value are dropped."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return require(df, required, path).dropna("all")


def newest_file(spark: SparkSession, folder: str, tokens: Sequence[str], suffixes: Sequence[str]) -> DataFrame:
    """One row (path): the newest file whose name has all tokens and one of the suffixes; lock files do not count."""
    files = spark.read.format("binaryFile").load(folder).select("path", "modificationTime")
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    ok = ~name.startswith("~$") & name.rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$")
    for t in tokens:
        ok = ok & name.contains(t.lower())
    return files.where(ok).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def load_reviews(parts: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """The union of sources, by (source, kind), with uid = source:kind:review_id.

    A part has review_id, position and any other columns; a row without an id is named by position.
    """
    out = None
    for (source, kind), df in parts.items():
        key = F.coalesce(F.nullif(clean_text(F.col("review_id")), F.lit("")), F.concat(F.lit("row"), F.col("position").cast("string")))
        df = df.withColumns({"source": F.lit(source), "kind": F.lit(kind), "uid": F.concat_ws(":", F.lit(source), F.lit(kind), key)})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_checkpoint(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, the last of each uid; torn lines are skipped. A record has seq, uid, ok and its fields."""
    lines = spark.read.text(path)
    parsed = lines.select(F.from_json("value", schema).alias("r")).select("r.*").where("uid is not null")
    w = Window.partitionBy("uid").orderBy(F.col("seq").desc())
    return parsed.withColumn("_r", F.row_number().over(w)).where("_r = 1 and ok").drop("_r")


def save_snapshot(frames: dict[str, DataFrame], folder: str, manifest: dict) -> None:
    """Each frame as Parquet below the folder, and a manifest with their schemas as JSON."""
    spark = next(iter(frames.values())).sparkSession
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    text = json.dumps(manifest | {"schemas": {k: v.schema.jsonValue() for k, v in frames.items()}})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/manifest")


def load_snapshot(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict]:
    """The frames, read with the schemas of the manifest, and the manifest."""
    manifest = json.loads("\n".join(r[0] for r in spark.read.text(f"{folder}/manifest").collect()))
    schemas = manifest.pop("schemas")
    return {k: spark.read.schema(StructType.fromJson(v)).parquet(f"{folder}/{k}") for k, v in schemas.items()}, manifest


def write_by_market(df: DataFrame, path: str, market: str = "market") -> bool:
    """Partitions of a market are replaced; an empty table replaces nothing and gives False."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(market).parquet(path)
    return True


def content_version(df: DataFrame) -> DataFrame:
    """One row (version): a digest of the table's rows that does not depend on their order."""
    row = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns)))
    return df.agg(F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string")), 256).alias("version"))


def reload_table(df: DataFrame, path: str) -> int:
    """Replace a table and count its rows by a new read; another count than was written is an error."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    found = df.sparkSession.read.parquet(path).count()
    if found != written.get["rows"]:
        raise RuntimeError(f"{path}: {written.get['rows']} rows written, {found} found")
    return found
