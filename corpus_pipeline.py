"""A corpus pipeline over `documents`: rules, near duplicates, secrets, mixing, packing.

Each stage is a function of (spark, docs, sf_dir) to a DataFrame, which is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import mixing, near_duplicates, packing, quality_rules, secrets
from quarrymill.llm.common import rows_with, shared_folder


#: Rows of an Arrow batch. Spark's default of 10,000 whole texts is some 30 MB, which an executor holds several times over.
BATCH_ROWS = "1000"


def _bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of BATCH_ROWS, or fewer where the session says so; results do not depend on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= int(BATCH_ROWS):
        spark.conf.set(key, BATCH_ROWS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go; rows without a text have no words and go with them."""
    _bounded_batches(spark)
    return quality_rules.kept_rows(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays, the least id.

    Rows that repeat an id are one document, which stays or goes; rows without an id stay.
    """
    _bounded_batches(spark)
    return rows_with(docs, near_duplicates.near_duplicates(docs).where("not kept").select("doc_id"), how="left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars follows the text."""
    _bounded_batches(spark)
    clean = secrets.redact_documents(docs, path_col="source")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is repeated as often as the mix takes it; those it doesn't take go."""
    _bounded_batches(spark)
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024, as their pieces."""
    _bounded_batches(spark)
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Suffix arrays, forests, random rounding and tokens are no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark)
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.mode("overwrite").parquet(f"{folder}/{name}")
        spark.catalog.clearCache()
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
