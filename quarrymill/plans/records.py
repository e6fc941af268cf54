"""Queries on readers and writers of the engine's own files: checkpoints, snapshots, exports, forecasts, reloads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import dates, text
from quarrymill.operators import reviews as ops
from quarrymill.operators import upsert, vendor
from quarrymill.session import shared_base, table
from quarrymill.sources import tables

from .bindings import REVIEWS, reviews
from .registry import query


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


@query("""WITH e AS (SELECT event_id AS seq, 'u' || user_id AS uid, event_type <> 'error' AS ok, round(value, 2) AS value, event_id % 31 = 7 AS torn FROM events),
l AS (SELECT uid, max(seq) AS seq FROM e WHERE NOT torn GROUP BY 1) SELECT l.uid, l.seq, e.value FROM l JOIN e ON e.seq = l.seq AND NOT e.torn WHERE e.ok""")
def checkpoint_records(spark: SparkSession, d: str) -> DataFrame:
    """Events as checkpoint lines, some of them torn; the last readable line of each user, if it is good."""
    e = table(spark, d, "events").select(F.col("event_id").alias("seq"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid"), (F.col("event_type") != "error").alias("ok"), F.round("value", 2).alias("value"))
    line = F.to_json(F.struct("seq", "uid", "ok", "value"))
    folder = _folder(spark, "checkpoint")
    e.select(F.when(F.col("seq") % 31 == 7, F.left(line, F.length(line) - 9)).otherwise(line).alias("value")).write.text(folder)
    return tables.read_checkpoint(spark, folder, "seq long, uid string, ok boolean, value double").select("uid", "seq", "value")


@query("""SELECT 'sales' AS name, count(*) AS "rows", CAST(sum(l_quantity) AS DOUBLE) AS total, 'UK' AS pool FROM lineitem UNION ALL SELECT 'stock', count(*), round(sum(p_size), 2), 'UK' FROM part""")
def snapshot_frames(spark: SparkSession, d: str) -> DataFrame:
    """Two tables written as a snapshot with a manifest, and what is read of it."""
    folder = _folder(spark, "snapshot")
    tables.save_snapshot({"sales": table(spark, d, "lineitem").select("l_partkey", "l_quantity"), "stock": table(spark, d, "part").select("p_partkey", "p_size")}, folder, {"pool": "UK"})
    frames, manifest = tables.load_snapshot(spark, folder)
    counted = [f.agg(F.lit(n).alias("name"), F.count("*").alias("rows"), F.sum(c).cast("double").alias("total"), F.lit(manifest["pool"]).alias("pool")) for n, f, c in (("sales", frames["sales"], "l_quantity"), ("stock", frames["stock"], "p_size"))]
    return counted[0].unionByName(counted[1])


@query("""WITH r AS (SELECT source, CASE WHEN doc_id % 2 = 0 THEN 'product' ELSE 'service' END AS kind, doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN ' nan ' ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents WHERE source IN (SELECT min(source) FROM documents UNION SELECT max(source) FROM documents))
SELECT CASE WHEN source = (SELECT min(source) FROM documents) THEN 'first' ELSE 'last' END || ':' || kind || ':' || CASE WHEN id IS NULL OR id = ' nan ' THEN 'row' || doc_id ELSE id END AS uid, kind FROM r""")
def review_uids(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the first and the last source as four exports of reviews, in one table with ids of their own."""
    docs = table(spark, d, "documents")
    ends = docs.agg(F.min("source").alias("lo"), F.max("source").alias("hi"))  # one row
    k = F.col("doc_id")
    rows = docs.join(F.broadcast(ends), F.col("source").isin(F.col("lo"), F.col("hi"))).select(k.alias("position"), F.when(k % 7 != 0, F.when(k % 11 == 0, " nan ").otherwise(k.cast("string"))).alias("review_id"), (F.col("source") == F.col("lo")).alias("is_first"))
    even = F.col("position") % 2 == 0
    parts = {(s, kind): rows.where((F.col("is_first") == (s == "first")) & (even if kind == "product" else ~even)) for s in ("first", "last") for kind in ("product", "service")}
    return tables.load_reviews(parts).select("uid", "kind")


@query("""WITH f AS (SELECT 'M' || (l_suppkey % 5) AS market, 'P' || (l_partkey % 50) AS item, CAST(date_trunc('week', l_shipdate) AS DATE) - 1 AS start, CAST(sum(l_quantity) AS DOUBLE) AS mean FROM lineitem GROUP BY 1, 2, 3)
SELECT market, item, strftime(start, '%Y-%m-%d') AS start, CAST(floor((start - DATE '1995-01-01') / 7) AS INTEGER) AS weeks_ahead, mean, mean + 2 AS p90 FROM f""")
def vendor_forecast_rows(spark: SparkSession, d: str) -> DataFrame:
    """Weekly units as nested forecast reports of each market, flattened again."""
    start = F.date_sub(F.date_trunc("week", "l_shipdate").cast("date"), 1)
    f = table(spark, d, "lineitem").groupBy(F.concat(F.lit("M"), (F.col("l_suppkey") % 5).cast("string")).alias("market"), F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string")).alias("item"), start.alias("start")).agg(F.sum("l_quantity").cast("double").alias("mean"))
    entry = F.struct(F.col("item").alias("asin"), F.concat(F.col("start").cast("string"), F.lit("T00:00:00Z")).alias("startDate"), F.date_add("start", 6).cast("string").alias("endDate"), F.col("mean").alias("meanForecastUnits"), (F.col("mean") + 1).alias("p80ForecastUnits"), (F.col("mean") + 2).alias("p90ForecastUnits"))
    reports = f.groupBy("market", "item").agg(F.to_json(F.struct(F.lit("1995-01-01").alias("forecastGenerationDate"), F.collect_list(entry).alias("forecastByAsin"))).alias("json"))
    return vendor.flatten_forecast(reports).select("market", "item", F.date_format("start", "yyyy-MM-dd").alias("start"), "weeks_ahead", "mean", "p90")


@query("""SELECT left('user ' || user_id % 9 || ' failed on ' || event_type || ' with ' || repeat('x', 130), 120) AS reason, count(*) AS "rows" FROM events WHERE event_type = 'error' GROUP BY 1""")
def failure_reasons(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.lit("user "), (F.col("user_id") % 9).cast("string"), F.lit(" failed on "), "event_type", F.lit(" with "), F.repeat(F.lit("x"), F.lit(130)))
    return ops.failure_reasons(table(spark, d, "events").withColumn("error", F.when(F.col("event_type") == "error", said)), "error")


@query(f"""WITH {REVIEWS}, e AS (SELECT source, max(day) AS e FROM reviews GROUP BY 1), w AS (SELECT source, m, CAST(e - to_months(m) AS DATE) + 1 AS s, e FROM e, (SELECT unnest([1, 3, 6]) AS m)),
c AS (SELECT w.source, m, count(*) AS n FROM w JOIN reviews r ON r.source = w.source AND r.day BETWEEN s AND w.e GROUP BY ALL)
SELECT source, CAST(m AS INTEGER) AS months, source || ': ' || n || ' reviews in ' || m || ' months are too few for action items' AS title FROM c WHERE n < 100""")
def skipped_windows(spark: SparkSession, d: str) -> DataFrame:
    """A sentence for each window that has too few reviews."""
    return ops.placeholder(ops.windows(reviews(spark, d), (1, 3, 6), 100)).select("source", "months", "title")


@query("""WITH n AS (SELECT max(strftime(o_orderdate, '%Y-%m')) AS newest FROM orders)
SELECT '1998-01' <= newest AS delivered, (SELECT count(*) FROM lineitem) AS "rows" FROM n""")
def delivered_and_reloaded(spark: SparkSession, d: str) -> DataFrame:
    """Is a batch from January 1998 delivered already, and how many rows does a reloaded table have?"""
    found = tables.reload_table(table(spark, d, "lineitem").select("l_orderkey", "l_quantity"), _folder(spark, "reload"))
    stored = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return upsert.already_delivered("1998-01", stored, "month").withColumn("rows", F.lit(found).cast("long"))


@query("""SELECT 'M' || (l_suppkey % 5) AS market, count(*) AS "rows" FROM lineitem GROUP BY 1""")
def rows_by_market(spark: SparkSession, d: str) -> DataFrame:
    """Lines written by market; an empty write after it replaces nothing."""
    line = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("M"), (F.col("l_suppkey") % 5).cast("string")).alias("market"))
    folder = _folder(spark, "markets")
    tables.write_by_market(line, folder)
    tables.write_by_market(line.where("false"), folder)
    return spark.read.parquet(folder).groupBy("market").agg(F.count("*").alias("rows"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(extract('millisecond' FROM ts) % 1000 AS VARCHAR), 3, '0') || 'Z' AS instant, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events""")
def iso_instants(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    written = F.concat(F.lit("  "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" "))
    return e.select("event_id", dates.iso_instant(written).alias("instant"), dates.iso_instant(F.when(F.col("event_id") % 5 == 0, "soon").otherwise(written), with_time=False).alias("day"))


@query("""SELECT doc_id, CASE WHEN length(t) <= 60 THEN t ELSE rtrim(CASE WHEN substring(t, 58, 1) = ' ' OR position(' ' IN left(t, 57)) = 0 THEN left(t, 57) ELSE regexp_replace(left(t, 57), ' [^ ]*$', '') END, ' ,;:-') || '...' END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '[^A-Za-z,;:-]+', ' ', 'g')) AS t FROM documents)""")
def shortened_titles(spark: SparkSession, d: str) -> DataFrame:
    plain = F.trim(F.regexp_replace("text", "[^A-Za-z,;:-]+", " "))
    return table(spark, d, "documents").select("doc_id", text.shorten(plain, 60).alias("short"))
