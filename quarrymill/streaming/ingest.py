"""Periodic reports as streams: late weeks are dropped, restated rows are upserted when they changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarrymill.operators.upsert import latest, merge
from quarrymill.session import use_checkpoints


def on_time_weeks(events: DataFrame, when: str, lookback_weeks: int = 6) -> DataFrame:
    """Weekly counts and sums (column value) of a stream; weeks behind the lookback are dropped."""
    w = F.window(F.col(when), "7 days", "7 days", "3 days")  # weeks start on Sunday
    g = events.withWatermark(when, f"{7 * lookback_weeks} days").groupBy(w, "event_type").agg(F.count("*").alias("rows"), F.sum("value").alias("value"))
    return g.select(F.to_date("window.start").alias("week_start"), "event_type", "rows", "value")


def upsert_stream(source: DataFrame, path: str, keys: Sequence[str], order: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Each micro-batch merged into the Parquet table at path, whose partitions are buckets of the keys.

    Only the buckets that a batch touches are read and written; their rows are checkpointed before they
    replace those that they come from. A batch that is run again merges to the same table.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        use_checkpoints(spark)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = latest(batch, keys, [order]).withColumn("bucket", bucket).checkpoint()
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        try:
            stored = spark.read.schema(new.schema).parquet(path).where(F.col("bucket").isin(touched))
        except AnalysisException as e:  # the first batch makes the table
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = new.limit(0)
        merged = merge(stored.select(*new.columns), new, keys).drop("action").checkpoint()
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
