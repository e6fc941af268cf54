"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Every document of a source asks for the same number of copies, target / source size. The whole
copies are given; what is left is a mass of words between 0 and the document's size. The pivotal
method pairs two such masses and moves mass from one to the other, in a random direction whose
odds keep both expectations, until one of them is 0 or full. A block of documents is folded this
way into its decisions and one residual; residuals of blocks are folded again, level by level,
until one is left for each source. The words of a source are kept by every step, so a source
misses its target by less than the size of one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import use_checkpoints
from .common import fresh, n_words, unit

BLOCK = 256
SEED = 20_240_601


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0), max_copies: float = 3.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target): the weights go round the sources
    by code point, null last; shares of the total are cut at max_copies * source_size and the
    excess is shared again by weight. The table has a row a source, whatever the corpus holds.

    In order of cap / weight, the first k sources are at their caps, where k is the least for
    which the level (total - caps so far) / (weights left) is below the next cap / weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    t = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).alias("w"),
        (F.col("source_size") * F.lit(float(max_copies))).alias("cap"),
    )
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    t = t.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("caps"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("left"),
    )
    t = t.withColumn("level", (F.col("total") - F.col("caps")) / F.col("left"))
    free = F.col("level") <= F.col("cap") / F.col("w")
    t = t.withColumn("at", F.min(F.when(free, F.struct(F.col("cap") / F.col("w"), F.col("level").alias("l")))).over(every))
    level = F.col("at")["l"]
    return t.select("source", "source_size", F.least(F.col("cap"), F.coalesce(level * F.col("w"), F.col("cap"))).alias("target"))


def _fold(items: Column, seed: int, level: int, kind: str) -> Column:
    """array<struct<id, cap, mass>> to struct(done array<struct<id, full>>, rest struct<id, cap, mass>)."""
    done = f"array<struct<id:{kind},full:boolean>>"
    rest = f"struct<id:{kind},cap:double,mass:double>"

    def step(acc: Column, x: Column) -> Column:
        a, cap_a, m_a = acc["rest"]["id"], acc["rest"]["cap"], acc["rest"]["mass"]
        up = F.least(cap_a - m_a, x["mass"])
        down = F.least(m_a, x["cap"] - x["mass"])
        rise = unit(F.lit(seed), F.lit(level), a, x["id"]) * (up + down) < down
        new_a = F.when(rise, m_a + up).otherwise(m_a - down)
        new_x = F.when(rise, x["mass"] - up).otherwise(x["mass"] + down)
        # the pair's integral member: where x gave or took all, x; otherwise a
        x_done = F.when(rise, x["mass"] <= cap_a - m_a).otherwise(x["cap"] - x["mass"] <= m_a)
        x_full = ~rise
        a_full = rise
        return F.struct(
            F.concat(acc["done"], F.array(F.when(x_done, F.struct(x["id"].alias("id"), x_full.alias("full"))).otherwise(F.struct(a.alias("id"), a_full.alias("full"))))).cast(done).alias("done"),
            F.when(x_done, F.struct(a.alias("id"), cap_a.alias("cap"), new_a.alias("mass")))
            .otherwise(F.struct(x["id"].alias("id"), x["cap"].alias("cap"), new_x.alias("mass"))).cast(rest).alias("rest"),
        )

    start = F.struct(F.array().cast(done).alias("done"), items[0].cast(rest).alias("rest"))
    return F.aggregate(F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def pivotal_round(df: DataFrame, group: str, cap: str, mass: str, *, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(id, group, cap, mass) to (id, full): full says that the mass became the cap, else it became 0.

    Ids are unique and of any type that has an order; 0 < mass < cap is asked for. Blocks are dealt by a hash of the id, at most about `block` rows
    each, so a group that holds most rows is many blocks; level after level the residuals are
    folded in blocks that are `block` times fewer, and each level's tables are checkpointed.
    """
    use_checkpoints(df.sparkSession)
    kind = df.schema["id"].dataType.simpleString()
    left = df.select("id", F.col(group).alias("g"), F.col(cap).cast("double").alias("cap"), F.col(mass).cast("double").alias("mass"))
    most = left.groupBy("g").count().agg(F.max("count")).first()[0] or 0
    blocks, level, out = -(-most // block), 0, []
    while True:
        blocks = max(1, blocks)
        own = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "id"), F.lit(blocks)).cast("int")
        items = F.sort_array(F.collect_list(F.struct("id", "cap", "mass")))
        folded = left.groupBy("g", own.alias("b")).agg(items.alias("x")).select("g", _fold(F.col("x"), seed, level, kind).alias("f")).checkpoint()
        out.append(folded.select(F.explode("f.done").alias("d")).select("d.id", "d.full"))
        left = folded.select("g", "f.rest.id", "f.rest.cap", "f.rest.mass")
        if blocks == 1:
            break
        blocks, level = -(-blocks // block), level + 1
    out.append(left.select("id", (unit(F.lit(seed), F.lit(-1), "id") * F.col("cap") < F.col("mass")).alias("full")))
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result


def _numbered(key: Column) -> Column:
    """key and a number from 1, which rows of equal keys share out; they are interchangeable."""
    return F.struct(key.alias("key"), F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0))).alias("n"))


def mixed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Every row of docs as often as mix_sources (options: its own) takes it, with all its columns.

    Rows meet their numbers of copies by id, source and size, so repeated and null ids keep their
    own; texts are shuffled once.
    """
    key, number, times = (fresh(docs, c) for c in ("_key", "_n", "_times"))
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    taken = mix.select(_numbered(F.struct("doc_id", "source", "size")).alias("r"), "copies").select(F.col("r.key").alias("_mix_key"), F.col("r.n").alias("_mix_n"), F.col("copies").alias("_mix_copies"))
    own = F.struct(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    rows = docs.withColumn(key, own).withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0))))
    # the numbers are compared as a difference, so rows stay where the window put them
    joined = rows.join(taken, (F.col(key) == F.col("_mix_key")) & (F.col(number) - F.col("_mix_n") == 0))
    return joined.where("_mix_copies > 0").withColumn(times, F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = (1.0, 2.0, 3.0), max_copies: float = 3.0, block: int = BLOCK, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Number of copies of each document in the mix: (doc_id, size, source_size, target, copies, taken).

    size is the number of words; taken = copies * size. Documents without words have no mass: they
    get the whole copies only. A null source is a source of its own, after all others. Ids may be of
    any type, and null; rows that repeat an id are documents of their own. An empty table gives an
    empty table. Other columns are not read. The same rows and seed give the same copies. Sources
    are ranked in one task, a row a source.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    use_checkpoints(docs.sparkSession)
    sized = sized.withColumn("row", _numbered(F.struct("doc_id", "source", "size"))).checkpoint()
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_copies)
    asked = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0)
    whole = F.floor(asked + F.lit(1e-12)).cast("int")
    # one row a source: as many rows as the mix has sources, which Spark may broadcast or shuffle
    targets = targets.withColumnRenamed("source", "_source")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "row", "doc_id", "source", "size", "source_size", "target", whole.alias("whole"), F.greatest(asked - whole, F.lit(0.0)).alias("part")
    )
    parts = rows.where((F.col("size") > 0) & (F.col("part") > 1e-12)).select(
        F.col("row").alias("id"), "source", F.col("size").cast("double").alias("cap"), (F.col("part") * F.col("size")).alias("mass")
    )
    full = pivotal_round(parts, "source", "cap", "mass", block=block, seed=seed)
    copies = F.col("whole") + F.coalesce(F.col("full").cast("int"), F.lit(0))
    return rows.join(full, F.col("row") == F.col("id"), "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )
