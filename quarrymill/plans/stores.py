"""Queries on loads that sort their rows, stores with whole versions, and lateral lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.session import shared_base, table
from quarrymill.sources import tolerant
from quarrymill.sources.versions import VersionedTable, append_batch, replace_groups

from .registry import query


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


@query("""WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS k FROM lineitem),
f AS (SELECT k FROM l UNION ALL SELECT k FROM l WHERE k % 29 = 0),
o AS (SELECT k, CASE WHEN k % 17 = 0 THEN 'malformed' WHEN k % 19 = 0 THEN 'missing id' WHEN k % 23 = 0 THEN 'error' WHEN row_number() OVER (PARTITION BY k) > 1 THEN 'duplicate' ELSE 'good' END AS outcome FROM f)
SELECT outcome, count(*) AS "rows" FROM o GROUP BY 1""")
def loaded_export(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a table as a text export with broken rows, loaded: rows by outcome."""
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    line = table(spark, d, "lineitem").select(k.alias("k"), F.concat(F.lit("M"), (F.col("l_suppkey") % 5).cast("string")).alias("market"), F.col("l_quantity").cast("int").cast("string").alias("units"))
    shown = F.concat_ws(",", F.when(F.col("k") % 19 == 0, " nan").otherwise(F.col("k").cast("string")), F.col("market"), F.when(F.col("k") % 17 == 0, "many").otherwise(F.col("units")), F.when(F.col("k") % 23 == 0, "timeout").otherwise(""))
    twice = line.withColumn("copy", F.explode(F.when(F.col("k") % 29 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    folder = _folder(spark, "export")
    twice.select(shown.alias("value")).write.text(folder)
    rows = tolerant.read_permissive(spark, folder, "id string, market string, units int, error string", header=False)
    load = tolerant.judge(rows, ["id"], ["id"], "error")
    return load.judged.groupBy(F.coalesce("reason", F.lit("good")).alias("outcome")).agg(F.count("*").alias("rows"))


@query("""WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p, CAST(sum(o_totalprice) AS DOUBLE) AS v, count(*) AS n FROM orders GROUP BY 1, 2),
b AS (SELECT y, p, v, n, 'first' AS run FROM a WHERE y % 2 = 0 OR p NOT LIKE '1%' UNION ALL SELECT y, p, 0.0, n, 'second' FROM a WHERE y % 2 = 1)
SELECT y, p, round(v, 2) AS v, n, run FROM b WHERE NOT (run = 'first' AND y IN (SELECT y FROM b WHERE run = 'second'))""")
def stored_runs(spark: SparkSession, d: str) -> DataFrame:
    """A store of yearly totals: a first run, then one whose years take the place of theirs; read as its newest version."""
    o = table(spark, d, "orders")
    totals = o.groupBy(F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p")).agg(F.sum("o_totalprice").cast("double").alias("v"), F.count("*").alias("n"))
    store = VersionedTable(spark, _folder(spark, "store"))
    append_batch(store, totals.where("y % 2 = 0 or p not like '1%'"), "run", "first")
    replace_groups(store, totals.where("y % 2 = 1").withColumns({"v": F.lit(0.0), "run": F.lit("second")}), ["y"])
    return store.read().select("y", "p", F.round("v", 2).alias("v"), "n", "run")


@query("""SELECT p_partkey AS part, l.l_orderkey AS orderkey, l.l_quantity AS quantity, s.days, s.lines FROM part
LEFT JOIN LATERAL (SELECT l_orderkey, l_quantity FROM lineitem WHERE l_partkey = p_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC LIMIT 1) l ON TRUE
LEFT JOIN LATERAL (SELECT count(DISTINCT l_shipdate) AS days, count(*) AS lines FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 25) s ON TRUE""")
def last_line_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """For each part its last line, and a count of larger ones, by lateral lookups.

    The outer column is compared for equality only, which Spark plans as a join; a range would be a nested loop.
    """
    part, line = table(spark, d, "part").select("p_partkey"), table(spark, d, "lineitem")
    own = line.where(F.col("l_partkey") == F.col("p_partkey").outer())
    last = own.orderBy(F.desc("l_shipdate"), F.desc("l_orderkey"), F.desc("l_linenumber")).limit(1).select("l_orderkey", "l_quantity")
    larger = own.where("l_quantity > 25").select(F.count_distinct("l_shipdate").alias("days"), F.count("*").alias("lines"))
    found = part.lateralJoin(last, how="left").lateralJoin(larger, how="left")
    return found.select(F.col("p_partkey").alias("part"), F.col("l_orderkey").alias("orderkey"), F.col("l_quantity").alias("quantity"), "days", "lines")
