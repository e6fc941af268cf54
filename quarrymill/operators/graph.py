"""Connected components of a table of edges."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import use_checkpoints

HUBS = 1024
TASK_ROWS = 100_000  # narrow rows that a task may well hold
LEAST_TASKS = 12


def few_tasks(rows: DataFrame, n: int, per: int = TASK_ROWS) -> DataFrame:
    """rows, n of them at most, in one task for every `per` and LEAST_TASKS at least, where a shuffle makes more.

    Tasks follow the rows instead of spark.sql.shuffle.partitions, which is set for the widest table.
    """
    return rows.coalesce(max(LEAST_TASKS, math.ceil(n / per)))


def large_keys(rows: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """(key) that more than one in HUBS of the rows have: fewer than HUBS keys, whatever the table is. total: their number, if known."""
    total = rows.count() if total is None else total
    return few_tasks(rows.groupBy(key).count(), total).where(F.col("count") * HUBS > total).select(key).checkpoint()


def join_large(rows: DataFrame, values: DataFrame, key: str, large: DataFrame) -> DataFrame:
    """rows joined with values, which have a row a key; large: keys (large_keys) that rows have very often.

    Rows of those keys stay where they lie and meet the values of fewer than HUBS keys, which are
    broadcast; only the others are shuffled, of which no key has more than one row in HUBS.
    """
    few = values.join(F.broadcast(large), key, "left_semi")
    hot = rows.join(F.broadcast(few), key)
    return hot.unionByName(rows.join(F.broadcast(large), key, "left_anti").join(values, key))


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) to (node, component): the least node that each one reaches.

    Rounds of pointer jumping and hooking: every node's label becomes the label of its label, then
    the least among its own and its neighbours', and so does that of the node that it had as label,
    until none changes; a chain in any order takes some log(nodes) rounds. Aggregates combine before
    they shuffle, and joins keep hubs and large components out of the shuffle, so neither is a hot group.
    Labels are checkpointed, so a lost executor costs one round. Every step has as many tasks as its
    rows ask for: a round of a small graph is many short stages. Edges with a null end, or to the
    same node, are left out.
    """
    use_checkpoints(edges.sparkSession)
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a")).where("node != to").distinct().checkpoint()
    n = both.count()
    both = few_tasks(both, n)
    hubs = large_keys(both, "to", n)
    labels = few_tasks(both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("component")), n).checkpoint()
    nodes = labels.count()
    none = F.lit(None).cast(labels.schema["node"].dataType)
    least = F.min("component").alias("component"), F.max("old").alias("old")
    while nodes:
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        further = few_tasks(join_large(labels, jump, "component", large_keys(labels, "component", nodes)), nodes).select("node", F.col("further").alias("component"), F.col("component").alias("old")).checkpoint()
        told = few_tasks(join_large(both, further.select(F.col("node").alias("to"), "component"), "to", hubs), n).select("node", "component", none.alias("old"))
        own = few_tasks(told.unionByName(further).groupBy("node").agg(*least), nodes)
        also = F.struct(F.col("old").alias("node"), "component", none.alias("old"))
        new = few_tasks(own.select(F.inline(F.array(F.struct("node", "component", "old"), also))).groupBy("node").agg(*least), nodes)
        new = new.select("node", "component", (F.col("component") != F.col("old")).alias("changed")).checkpoint()
        labels = new.drop("changed")
        if new.where("changed").isEmpty():
            break
    return labels
