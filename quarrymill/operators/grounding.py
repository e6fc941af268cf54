"""Grounded validation: is every reply well formed, and does every figure in it come from its summary?

Summaries and replies are JSON documents of any shape. They are read as VARIANT and walked level by
level, so a figure is found wherever a summary has it. Rows are (reply, summary, json) and (summary,
json); what is compared with an item is one row a summary: its figures, its percentages and its areas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.text import figures, identifiers, single_spaced, words_found
from quarrymill.session import use_checkpoints

#: Items a reply has, the fields of an item and the most characters of each.
ITEMS = 3
FIELDS = {"title": 200, "description": 1000, "rationale": 1500, "related_area": 100, "evidence": 1000, "evidence_strength": 20}
#: Where figures, wording and names of fields are looked for.
FIGURES_IN = ("description", "rationale", "evidence")
WORDING_IN = ("title", "description", "rationale", "evidence")
#: Strengths, the weak one, and first words that claim too much for it.
STRENGTHS, EARLY = ("strong", "moderate", "early signal"), "early signal"
STRONG_VERBS = ("fix", "overhaul", "resolve", "eliminate", "stop", "eradicate")
#: Wording that counts of reviews do not support.
BANNED = ("significant", "significantly", "statistically", "meaningful", r"not\s+random", r"random\s+variation")
#: The area that every summary has, sections whose names are areas, reviews below which one is small.
OVERALL, SECTIONS, SMALL = "overall", ("product_by_sector_group", "service_by_aspect", "product_by_region"), 30


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _part(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def _is_number(v: Column) -> Column:
    return _kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def _text(v: Column) -> Column:
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def document_leaves(documents: DataFrame) -> DataFrame:
    """documents (id, v variant) to (id, key, leaf): every value that is no object or list, with the nearest key above it.

    A level of the documents is a pass over what is nested in the one before; there are as many as the
    deepest document has.
    """
    spark = documents.sparkSession
    use_checkpoints(spark)
    level, leaves = documents.select("id", F.lit("").alias("key"), F.col("v").alias("leaf")), None
    while True:
        level = level.withColumn("nested", _kind(F.col("leaf")).rlike("^(OBJECT|ARRAY)<")).checkpoint()
        plain = level.where("not nested").select("id", "key", "leaf")
        leaves = plain if leaves is None else leaves.unionByName(plain)
        inner = level.where("nested")
        if inner.isEmpty():
            return leaves
        inside = spark.tvf.variant_explode(F.col("leaf").outer()).toDF("_pos", "_key", "_value")
        level = inner.lateralJoin(inside).select("id", F.coalesce("_key", "key").alias("key"), F.col("_value").alias("leaf"))


def known_figures(summaries: DataFrame) -> DataFrame:
    """summaries (id, v) to (id, figures, percentages): its numbers, and those in its texts, to one decimal.

    Percentages are numbers under keys that end in _pct, and figures of texts with a percent sign.
    """
    leaves = document_leaves(summaries)
    number = F.when(_is_number(F.col("leaf")), F.array(F.struct(F.try_variant_get("leaf", "$", "double").alias("value"), F.col("key").endswith("_pct").alias("percent"))))
    told = F.transform(figures(_text(F.col("leaf"))), lambda f: F.struct(f["value"].alias("value"), f["percent"].alias("percent")))
    rows = leaves.select("id", F.explode(F.coalesce(number, told)).alias("f")).select("id", F.bround("f.value", 1).alias("value"), "f.percent")
    found = rows.groupBy("id").agg(F.collect_set("value").alias("figures"), F.collect_set(F.when(F.col("percent"), F.col("value"))).alias("percentages"))
    empty = F.array().cast("array<double>")
    return summaries.select("id").join(found, "id", "left").select("id", *(F.coalesce(c, empty).alias(c) for c in ("figures", "percentages")))


def known_areas(summaries: DataFrame) -> DataFrame:
    """summaries (id, v) to (id, areas map<lower case, name>, small array<lower case>, threshold).

    Of names that differ in case only, the last in the order of the sections is the area's.
    """
    spark = summaries.sparkSession
    parts = summaries.select("id", F.explode(F.array(*(F.struct(F.lit(i).alias("section"), _part(F.col("v"), s).alias("list")) for i, s in enumerate(SECTIONS)))).alias("s")).select("id", "s.section", F.col("s.list").alias("list"))
    entries = parts.where(_kind(F.col("list")).startswith("ARRAY")).lateralJoin(spark.tvf.variant_explode(F.col("list").outer()).toDF("_pos", "_key", "_value"))
    named = entries.select("id", "section", "_pos", _text(_part(F.col("_value"), "name")).alias("name"), F.coalesce(F.try_variant_get("_value", "$.small_sample", "boolean"), F.lit(False)).alias("small")).where("name is not null")
    one = named.groupBy("id", F.lower("name").alias("low")).agg(F.max_by("name", F.struct("section", "_pos")).alias("name"), F.max("small").alias("small"))
    found = one.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("low", "name"))).alias("areas"), F.collect_list(F.when(F.col("small"), F.col("low"))).alias("small"))
    overall = F.create_map(F.lit(OVERALL), F.lit(OVERALL))
    threshold = F.coalesce(F.try_variant_get("v", "$.small_sample_threshold_reviews", "int"), F.lit(SMALL))
    own = F.coalesce("areas", F.create_map().cast("map<string,string>"))
    named = F.when(F.map_contains_key(own, OVERALL), own).otherwise(F.map_concat(overall, F.map_filter(own, lambda k, _: k != OVERALL)))
    return summaries.select("id", threshold.alias("threshold")).join(found, "id", "left").select("id", "threshold", named.alias("areas"), F.coalesce("small", F.array().cast("array<string>")).alias("small"))


def _supported(f: Column, known: Column, percentages: Column) -> Column:
    """Is a figure among the known ones, or a whole percentage one of them rounded?"""
    value = F.bround(f["value"], 1)
    as_percent = F.array_contains(percentages, value) | ((value == F.floor(value)) & F.exists(percentages, lambda p: F.floor(p + 0.5) == value))
    return F.when(f["percent"], as_percent).otherwise(F.array_contains(known, value))


def _found(rule: str, when: Column, detail: Column | None = None) -> Column:
    return F.when(when, F.struct(F.lit(rule).alias("rule"), (F.lit("") if detail is None else detail).cast("string").alias("detail")))


def check_replies(replies: DataFrame, summaries: DataFrame, items: int = ITEMS) -> tuple[DataFrame, DataFrame]:
    """(problems, clean items) of replies (reply, summary, json) against summaries (summary, json).

    problems: (reply, item, rule, detail), item 0 where the reply as a whole is meant; a reply without
    a list of exactly `items` items has that problem alone. Ranks are compared where no item has another
    problem. clean: (reply, rank, the fields), single-spaced, areas as the summary spells them, of the
    replies without a problem. A text that is no JSON has no items; a summary that is missing, or no JSON,
    supports no figure and names no area but the overall one. Repeated ids of replies are not allowed for.
    """
    spark = replies.sparkSession
    use_checkpoints(spark)
    documents = summaries.select(F.col("summary").alias("id"), F.try_parse_json("json").alias("v")).checkpoint()
    known = known_figures(documents).join(known_areas(documents), "id").checkpoint()
    read = replies.select("reply", "summary", _part(F.try_parse_json("json"), "items").alias("items"))
    listed = F.coalesce(_kind(F.col("items")).startswith("ARRAY"), F.lit(False))
    read = read.withColumn("listed", listed)
    size = F.when(F.col("listed"), F.size(F.try_variant_get("items", "$", "array<variant>"))).otherwise(-1)
    read = read.withColumn("size", size).checkpoint()
    whole = read.where((F.col("size") != items)).select("reply", F.lit(0).alias("item"), F.when(F.col("size") < 0, "no_list_of_items").otherwise("item_count").alias("rule"), F.when(F.col("size") >= 0, F.col("size").cast("string")).otherwise("").alias("detail"))

    each = read.where(F.col("size") == items).lateralJoin(spark.tvf.variant_explode(F.col("items").outer()).toDF("_pos", "_key", "v"))
    each = each.join(known, F.col("summary") == F.col("id"), "left")
    none = F.array().cast("array<double>")
    given = each.select(
        "reply", (F.col("_pos") + 1).alias("item"), _kind(F.col("v")).startswith("OBJECT").alias("is_object"), (_kind(_part(F.col("v"), "rank")) == "BIGINT").alias("ranked"), F.try_variant_get("v", "$.rank", "bigint").alias("rank"),
        *(single_spaced(_text(_part(F.col("v"), f))).alias(f) for f in FIELDS), F.coalesce("figures", none).alias("figures"), F.coalesce("percentages", none).alias("percentages"),
        F.coalesce("areas", F.create_map(F.lit(OVERALL), F.lit(OVERALL))).alias("areas"), F.coalesce("small", F.array().cast("array<string>")).alias("small"), F.coalesce("threshold", F.lit(SMALL)).alias("threshold"),
    )

    usable = {f: F.coalesce((F.col(f) != "") & (F.length(f) <= most), F.lit(False)) for f, most in FIELDS.items()}
    tests = [_found("no_whole_rank", ~F.coalesce(F.col("ranked"), F.lit(False)))]
    for f, most in FIELDS.items():
        tests.append(_found(f"no_{f}", F.coalesce(F.col(f) == "", F.lit(True))))
        tests.append(_found(f"long_{f}", F.length(f) > most, F.length(f)))
        if f in FIGURES_IN:
            bad = F.filter(figures(F.col(f)), lambda x: ~_supported(x, F.col("figures"), F.col("percentages")))
            tests.append(_found(f"unsupported_figure_in_{f}", usable[f] & (F.size(bad) > 0), F.array_join(F.transform(bad, lambda x: x["written"]), ", ")))
        if f in WORDING_IN:
            said = F.array_distinct(F.transform(words_found(F.col(f), list(BANNED)), single_spaced))
            tests.append(_found(f"banned_wording_in_{f}", usable[f] & (F.size(said) > 0), F.array_join(said, ", ")))
            tests.append(_found(f"field_name_in_{f}", usable[f] & (F.size(identifiers(F.col(f))) > 0), F.array_join(identifiers(F.col(f)), ", ")))
    area, strength = F.try_element_at("areas", F.lower("related_area")), F.lower("evidence_strength")
    named = F.when(usable["related_area"], F.coalesce(area, F.col("related_area")))
    rated = usable["evidence_strength"] & strength.isin(*STRENGTHS)
    verb = F.lower(F.regexp_extract(F.when(usable["title"], F.col("title")).otherwise(""), r"(?U)[^\W\d_]+", 0))
    tests += [
        _found("unknown_area", usable["related_area"] & area.isNull(), F.col("related_area")),
        _found("unknown_strength", usable["evidence_strength"] & ~strength.isin(*STRENGTHS), F.col("evidence_strength")),
        _found("strong_verb_for_early_signal", rated & (strength == EARLY) & verb.isin(*STRONG_VERBS), verb),
        _found("strength_of_small_area", rated & (strength != EARLY) & F.coalesce(F.array_contains("small", F.lower(named)), F.lit(False)), F.concat_ws(", ", named, "threshold")),
    ]
    problem = F.when(F.col("is_object"), F.filter(F.array(*tests), lambda p: p.isNotNull())).otherwise(F.array(F.struct(F.lit("no_object").alias("rule"), F.lit("").alias("detail"))))
    judged = given.select("reply", "item", "rank", *(F.col(f) for f in FIELDS if f not in ("related_area", "evidence_strength")), named.alias("related_area"), strength.alias("evidence_strength"), problem.alias("problems")).checkpoint()

    found = judged.select("reply", "item", F.explode("problems").alias("p")).select("reply", "item", "p.rule", "p.detail")
    ranks = judged.groupBy("reply").agg(F.max(F.size("problems")).alias("worst"), F.array_sort(F.collect_list("rank")).alias("ranks")).where("worst = 0")
    right = F.array(*(F.lit(i).cast("long") for i in range(1, items + 1)))
    odd = ranks.where(F.col("ranks") != right).select("reply", F.lit(0).alias("item"), F.lit("ranks").alias("rule"), F.array_join(F.col("ranks").cast("array<string>"), ", ").alias("detail"))
    clean = judged.join(ranks.where(F.col("ranks") == right).select("reply"), "reply", "left_semi").select("reply", "rank", *FIELDS)
    return whole.unionByName(found).unionByName(odd), clean
