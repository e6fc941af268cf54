"""Queries on what is in scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators import scope
from quarrymill.session import table

from .bindings import ANCHOR, SALES, sales
from .registry import query


@query(f"""WITH {SALES}, a AS (SELECT * FROM sales WHERE key IN (SELECT key FROM sales WHERE month >= DATE '2001-06-01')), f AS (SELECT * FROM a WHERE key IN (SELECT key FROM a WHERE month <= DATE '{ANCHOR}' GROUP BY 1 HAVING count(DISTINCT month) >= 24))
SELECT 'all' AS stage, count(DISTINCT key) AS items, sum(units) AS units FROM sales UNION ALL SELECT 'active', count(DISTINCT key), sum(units) FROM a UNION ALL SELECT 'forecastable', count(DISTINCT key), sum(units) FROM f""")
def scope_funnel(spark: SparkSession, d: str) -> DataFrame:
    s = sales(spark, d)
    a = scope.active_items(s, s, "2001-06-01")
    out = None
    for name, df in (("all", s), ("active", a), ("forecastable", scope.forecastable(a, ANCHOR))):
        row = df.agg(F.count_distinct("key").alias("items"), F.sum("units").alias("units")).withColumn("stage", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS ch FROM orders JOIN customer ON o_custkey = c_custkey) SELECT CASE WHEN ch = 'BUILDING' THEN 'excluded' ELSE 'kept' END AS side, count(*) AS "rows" FROM r GROUP BY 1""")
def channel_split(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("ch"))
    kept, out = scope.without_channel(table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")), "ch", "BUILDING")
    return kept.select(F.lit("kept").alias("side")).unionByName(out.select(F.lit("excluded").alias("side"))).groupBy("side").agg(F.count("*").alias("rows"))


@query("""WITH m AS (SELECT CAST(p_partkey % 50 AS VARCHAR) AS code, arg_min(CASE WHEN p_size % 5 = 0 THEN 'Unknown' ELSE p_brand END, p_partkey) AS family FROM part GROUP BY 1)
SELECT coalesce(family, 'Unknown') AS family, count(*) AS "rows", count(*) FILTER (code IS NULL) AS unmatched FROM lineitem LEFT JOIN m ON code = CAST(l_partkey % 60 AS VARCHAR) GROUP BY 1""")
def family_tags(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.concat(F.lit(" "), (F.col("p_partkey") % 50).cast("string"), F.lit(" ")).alias("c"), F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.col("p_brand")).alias("f"), "p_partkey")
    m = scope.family_map(p, "c", "f", "p_partkey")
    rows = table(spark, d, "lineitem").select((F.col("l_partkey") % 60).cast("string").alias("code"))
    tagged = scope.tag_family(rows, m, "code")
    missing = scope.unmatched(rows, m, "code").withColumn("u", F.lit(1))
    return tagged.join(missing, "code", "left").groupBy("family").agg(F.count("*").alias("rows"), F.count("u").alias("unmatched"))


@query("""SELECT l_partkey AS key, arg_min(n_name, (l_orderkey, l_linenumber)) AS region FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_linenumber <> 1 GROUP BY 1""")
def first_regions(spark: SparkSession, d: str) -> DataFrame:
    """The nation of each part's first line by order and number; of lines alike in both, the one that the table has first."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", F.struct("l_orderkey", "l_linenumber", "_metadata.file_path", "_metadata.row_index").alias("o"))
    rows = lines.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    named = rows.select(F.col("l_partkey").alias("key"), F.when(F.col("l_linenumber") != 1, F.col("n_name")).alias("region"), "o")
    return scope.first_region(named, "key", "region", "o")


@query("""WITH b AS (SELECT o_custkey AS k, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders GROUP BY 1), s AS (SELECT k, z, CAST(unnest(generate_series(a, CAST(date_trunc('month', z) AS DATE), INTERVAL 15 MONTH)) AS DATE) AS s FROM b)
SELECT k, strftime(s, '%Y-%m-%d') AS start, strftime(least(last_day(CAST(s + INTERVAL 14 MONTH AS DATE)), last_day(z)), '%Y-%m-%d') AS "end" FROM s""")
def request_chunks(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("z"))
    c = b.select("k", F.explode(scope.request_chunks(F.col("a"), F.col("z"))).alias("c"))
    return c.select("k", F.date_format("c.start", "yyyy-MM-dd").alias("start"), F.date_format("c.end", "yyyy-MM-dd").alias("end"))
