"""Loaders that keep what they can read and say what they could not: good rows, a quarantine, and counts that add up."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from quarrymill.functions.parsing import clean_text

RAW = "_raw"


@dataclass
class Loaded:
    """good: rows that pass, each key once; quarantine: (file, reason, raw); counts: filled by the first action on judged."""

    judged: DataFrame
    good: DataFrame
    quarantine: DataFrame
    counts: Observation


def read_permissive(spark: SparkSession, path: str, schema: str, kind: str = "csv", **options: object) -> DataFrame:
    """Rows of 'csv' (with a header), 'json' (a record a line) or 'json_array' files, with their file, place and raw text where they do not fit the schema.

    place orders the rows of a file as they stand in it. Each record of an array is judged for itself;
    an array is one value, so a file of them is a batch of bounded size. A file that is no array is one
    malformed row.
    """
    fields = StructType.fromDDL(schema).add(RAW, StringType())
    if kind == "json_array":
        whole = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
        is_array = F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False))
        each = F.transform(F.try_variant_get("v", "$", "array<variant>"), lambda e: F.to_json(e))
        lines = whole.select("file", F.posexplode(F.when(is_array, each).otherwise(F.array("value"))).alias("place", "line"))
        read = F.from_json("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}).alias("r")
        return lines.select("file", F.col("place").cast("long").alias("place"), read).select("r.*", "file", "place")
    if kind == "json":
        lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))
        return lines.select("file", "place", F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}).alias("r")).select("r.*", "file", "place")
    header = options.pop("header", True)
    reader = spark.read.schema(fields).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
    reader = reader.option("header", header).option("escape", '"').option("enforceSchema", not header).options(**options)
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))


def judge(rows: DataFrame, keys: Sequence[str], required: Sequence[str], error: str | None = None, counted: dict[str, Column] | None = None) -> Loaded:
    """rows (with file, place, _raw) split by the first reason that holds.

    malformed: the line does not fit the schema. missing <column>: a required value is null, blank or
    written as nan, nat or none. error: the named column holds something. duplicate: the key was there before, in order
    of file and place; only rows that pass the other rules count. counted: further sums over all rows.
    """
    blank = lambda c: F.coalesce(clean_text(F.col(c)), F.lit("")) == ""
    # a reader parses the columns that are asked for: this asks for all, so that no value that does not fit stays unseen
    read = F.xxhash64(*(c for c in rows.columns if c not in (RAW, "file", "place"))) >= F.lit(-(1 << 63))
    reason = F.when(F.col(RAW).isNotNull() & read, "malformed")
    for c in required:
        reason = reason.when(blank(c), f"missing {c}")
    if error:
        reason = reason.when(~blank(error), "error")
    own = rows.withColumn("reason", reason)
    first = F.row_number().over(Window.partitionBy(F.col("reason").isNull(), *keys, F.when(F.col("reason").isNotNull(), F.col("place"))).orderBy("file", "place"))
    judged = own.withColumn("reason", F.when(F.col("reason").isNotNull(), F.col("reason")).when(first > 1, "duplicate"))
    counts = Observation()
    measures = {"rows": F.count(F.lit(1)), "good": F.count_if(F.col("reason").isNull()), "quarantined": F.count_if(F.col("reason").isNotNull()), **(counted or {})}
    judged = judged.observe(counts, *(m.alias(k) for k, m in measures.items()))
    plain = [c for c in rows.columns if c not in (RAW, "file", "place")]
    line = F.coalesce(RAW, F.to_json(F.struct(*plain)))
    return Loaded(judged, judged.where("reason is null").select(*plain), judged.where("reason is not null").select("file", "reason", line.alias("raw")), counts)


def load_export(spark: SparkSession, path: str, schema: str, keys: Sequence[str], required: Sequence[str], *, kind: str = "csv", error: str | None = None, grain: str | None = None, currency: str | None = None, **options: object) -> Loaded:
    """A tolerant load of one export or a folder of them; counts also has rows without a grain's value, and of each currency's."""
    rows = read_permissive(spark, path, schema, kind, **options)
    counted = {}
    if grain:
        counted |= {"grains": F.size(F.collect_set(grain)), "without_grain": F.count_if(F.col(grain).isNull())}
    if currency:
        counted |= {"currencies": F.array_join(F.array_sort(F.collect_set(currency)), ","), "without_currency": F.count_if(F.col(currency).isNull())}
    return judge(rows, keys, required, error, counted)


def code_map(spark: SparkSession, path: str, columns: dict[str, str], keys: Sequence[str]) -> Loaded:
    """A map of codes: columns (in the file: here), trimmed, blank and 'nan' or 'none' as null, keys in upper case."""
    read = spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    absent = [c for c in columns if c not in read.columns]
    if absent:
        raise ValueError(f"{path}: missing {', '.join(absent)}")
    value = lambda c, to: F.nullif(F.upper(clean_text(F.col(f"`{c}`"))) if to in keys else clean_text(F.col(f"`{c}`")), F.lit("")).alias(to)
    rows = read.select(*(value(c, to) for c, to in columns.items()), F.lit(None).cast("string").alias(RAW), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))
    return judge(rows, keys, keys)
