"""Review analytics. Rows: (uid, source, kind, sentiment, rating, area, product, themes, day, text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import excerpt, single_spaced, theme_key


def tally(rows: DataFrame, *by: str, small: int = 10) -> DataFrame:
    """(by, reviews, negatives, negative_share, small_sample)."""
    g = rows.groupBy(*by).agg(F.count("*").alias("reviews"), F.count_if(F.col("sentiment") == "negative").alias("negatives"))
    return g.select("*", (F.col("negatives") / F.col("reviews")).alias("negative_share"), (F.col("reviews") < small).alias("small_sample"))


def summary(rows: DataFrame, *by: str) -> DataFrame:
    """Counts and shares of each sentiment, mean and spread of ratings."""
    g = rows.groupBy(*by).agg(
        F.count("*").alias("reviews"), *(F.count_if(F.col("sentiment") == s).alias(s) for s in ("positive", "neutral", "negative")),
        F.avg("rating").alias("avg_rating"), *(F.count_if(F.col("rating") == k).alias(f"rating_{k}") for k in range(1, 6)),
    )
    return g.withColumn("positive_share", F.col("positive") / F.col("reviews"))


def source_differences(rows: DataFrame, left: str, right: str) -> DataFrame:
    """(kind, sentiment, left_share, right_share, difference) between two sources."""
    shares = rows.groupBy("kind", "source", "sentiment").agg(F.count("*").alias("n"))
    shares = shares.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("kind", "source")))
    p = shares.groupBy("kind", "sentiment").pivot("source", [left, right]).agg(F.first("share"))
    a, b = F.coalesce(F.col(f"`{left}`"), F.lit(0.0)), F.coalesce(F.col(f"`{right}`"), F.lit(0.0))
    return p.select("kind", "sentiment", a.alias("left_share"), b.alias("right_share"), (a - b).alias("difference"))


def negative_themes(rows: DataFrame, most: int = 15) -> DataFrame:
    """(key, spelling, reviews): themes of negative reviews, one count a review and key.

    Spellings with the same stems are one theme, shown as the most frequent, of equal ones the first
    in the alphabet. The `most` largest are returned; ties by key.
    """
    said = rows.where("sentiment = 'negative'").select("uid", F.explode("themes").alias("theme")).select("uid", "theme", theme_key(F.col("theme")).alias("key")).where("key <> ''")
    spelled = said.distinct().groupBy("key", "theme").agg(F.count("*").alias("n"))
    best = spelled.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("n"), "theme"))["theme"].alias("spelling"))
    counts = said.select("uid", "key").distinct().groupBy("key").agg(F.count("*").alias("reviews"))
    return counts.join(best, "key").orderBy(F.desc("reviews"), "key").limit(most)


def worst_products(rows: DataFrame, least: int = 3, most: int = 10) -> DataFrame:
    """The `most` products with most negatives, at least `least`."""
    t = tally(rows.where("product is not null"), "product").where(F.col("negatives") >= least)
    return t.orderBy(F.desc("negatives"), F.desc("reviews"), "product").limit(most)


def windows(rows: DataFrame, months: tuple[int, ...], least: int) -> DataFrame:
    """(source, months, start, end, reviews, recent_start, is_used): windows that end at a source's newest day."""
    ends = rows.groupBy("source").agg(F.max("day").alias("end"))
    w = ends.select("source", "end", F.explode(F.array(*map(F.lit, months))).alias("months")).withColumn("start", F.date_add(F.expr("add_months(end, -months)"), 1))
    counted = w.join(rows.select("source", "day"), "source").where("day between start and end").groupBy("source", "months", "start", "end").agg(F.count("*").alias("reviews"))
    return counted.select("*", F.date_sub("end", F.expr("cast(greatest(1, floor((datediff(end, start) + 1) / 3)) as int) - 1")).alias("recent_start"), (F.col("reviews") >= least).alias("is_used"))


def area_trend(rows: DataFrame, recent_start: Column, least: int = 5) -> DataFrame:
    """(area, earlier, recent, earlier_negatives, recent_negatives, change) of negative shares."""
    recent = F.col("day") >= recent_start
    bad = F.col("sentiment") == "negative"
    g = rows.groupBy("area").agg(
        F.count_if(~recent).alias("earlier"), F.count_if(recent).alias("recent"), F.count_if(~recent & bad).alias("earlier_negatives"), F.count_if(recent & bad).alias("recent_negatives")
    )
    change = F.try_divide("recent_negatives", F.nullif("recent", F.lit(0))) - F.try_divide("earlier_negatives", F.nullif("earlier", F.lit(0)))
    return g.where(F.col("earlier") + F.col("recent") >= least).withColumn("change", change)


def excerpts(rows: DataFrame, most: int, size: int) -> DataFrame:
    """(place, area, uid, excerpt): negative reviews, the most confident first, taken in turn from the areas.

    rows: (uid, sentiment, confidence, area, text). Areas come in order of their best confidence, then
    of their names; a text that several reviews have, but for case and spaces, is quoted once, from
    the most confident of them, then from the least uid. Unknown confidence is 0; reviews without a
    text are left out. Only the `most` first of each area meet in one order.
    """
    sure = F.coalesce("confidence", F.lit(0.0))
    said = rows.where("sentiment = 'negative'").select("uid", "area", "text", sure.alias("sure"), F.lower(single_spaced(F.col("text"))).alias("key")).where("key <> ''")
    order = F.struct((-F.col("sure")).alias("sure"), F.col("uid").alias("uid"))
    once = said.groupBy("key").agg(F.min_by(F.struct("uid", "area", "text", "sure"), order).alias("r")).select("r.*")
    depth = F.row_number().over(Window.partitionBy("area").orderBy(F.desc("sure"), "uid"))
    inside = once.withColumn("depth", depth).where(F.col("depth") <= most)
    best = once.groupBy("area").agg(F.max("sure").alias("best")).withColumnRenamed("area", "_area")
    turn = [F.col("depth"), F.desc("best"), F.col("area")]
    ranked = inside.join(best, F.col("area").eqNullSafe(F.col("_area"))).orderBy(*turn).limit(most)
    return ranked.select(F.row_number().over(Window.orderBy(*turn)).alias("place"), "area", "uid", excerpt(F.col("text"), size).alias("excerpt"))


def overall(rows: DataFrame) -> DataFrame:
    """One row of sentiment shares in percent."""
    share = lambda s: F.round(100 * F.try_divide(F.count_if(F.col("sentiment") == s), F.count("*")), 1).alias(s)
    return rows.agg(F.count("*").alias("reviews"), share("positive"), share("neutral"), share("negative"))


def failure_reasons(rows: DataFrame, error: str) -> DataFrame:
    """(reason, rows), most frequent first, of the first 120 characters of an error."""
    return rows.where(F.col(error).isNotNull()).groupBy(F.left(F.col(error), F.lit(120)).alias("reason")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "reason")


def in_scope(rows: DataFrame, scopes: DataFrame) -> DataFrame:
    """rows by scope (name, source, kind), where a null source or kind takes any.

    A row asks with each of the four keys that a scope may have, so the join is one on equality
    whatever the number of scopes.
    """
    asked = F.array(*(F.struct(a.alias("_source"), b.alias("_kind")) for a in (F.col("source"), F.lit(None)) for b in (F.col("kind"), F.lit(None))))
    keyed = rows.withColumn("_key", F.explode(F.array_distinct(asked))).withColumn("_ask", F.to_json("_key"))
    s = scopes.select("name", F.to_json(F.struct(F.col("source").alias("_source"), F.col("kind").alias("_kind"))).alias("_ask"))
    return keyed.join(s, "_ask").drop("_ask", "_key")


def latest_generation(items: DataFrame, by: tuple[str, ...], generated: str, aliases: dict[str, str]) -> DataFrame:
    """The items of the newest generation of each group, and again under the aliases of their scope."""
    newest = F.max(generated).over(Window.partitionBy(*by))
    own = items.withColumn("_n", newest).where(F.col(generated) == F.col("_n")).drop("_n")
    out = own
    for name, alias in aliases.items():
        out = out.unionByName(own.where(F.col("scope") == name).withColumn("scope", F.lit(alias)))
    return out


def placeholder(windows: DataFrame) -> DataFrame:
    """windows that are not used, with a sentence that says why."""
    text = F.format_string("%s: %d reviews in %d months are too few for action items", "source", "reviews", "months")
    return windows.where("not is_used").withColumn("title", text)


#: What the rows of a scope are counted by, in one pass: section, and its columns.
SECTIONS = {
    "sentiment": (), "by_review_type_and_source": ("kind", "source"), "by_group": ("kind", "area"), "by_group_and_source": ("kind", "area", "source"), "monthly_negative": ("month",), "by_product": ("kind", "product"),
}


def scoped(rows: DataFrame) -> DataFrame:
    """rows once for all sources and once for their own (column scope), with month, and recent: in the last third of the scope's days."""
    each = rows.withColumn("scope", F.explode(F.array(F.lit("All"), "source"))).withColumn("month", F.date_format("day", "yyyy-MM"))
    span = each.groupBy("scope").agg(F.min("day").alias("start"), F.max("day").alias("end"))  # a row a scope
    third = F.greatest(F.lit(1), F.floor((F.datediff("end", "start") + 1) / 3)).cast("int")
    return each.join(span.withColumn("recent_start", F.date_add(F.date_sub("end", third), 1)), "scope").withColumn("recent", F.col("day") >= F.col("recent_start"))


def section_tallies(rows: DataFrame) -> DataFrame:
    """(scope, section, kind, area, source, month, product, reviews, positive, neutral, negatives, recent_reviews, recent_negatives).

    All sections of all scopes come of one pass with grouping sets; columns that a section does not have are null.
    """
    columns = ["scope", "kind", "area", "source", "month", "product"]
    sets = [["scope", *c] for c in SECTIONS.values()]
    given = scoped(rows).na.fill("unknown", ["kind", "area", "source"])
    bad = F.col("sentiment") == "negative"
    g = given.groupingSets([[F.col(c) for c in own] for own in sets], *columns).agg(
        F.grouping_id(*columns).alias("id"), F.count("*").alias("reviews"), *(F.count_if(F.col("sentiment") == x).alias(n) for x, n in (("positive", "positive"), ("neutral", "neutral"), ("negative", "negatives"))),
        F.count_if("recent").alias("recent_reviews"), F.count_if(F.col("recent") & bad).alias("recent_negatives"),
    )
    bits = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c != "scope" and c not in own) for name, own in SECTIONS.items()}
    section = F.coalesce(*(F.when(F.col("id") == b, name) for name, b in bits.items()))
    return g.select("scope", section.alias("section"), *columns[1:], "reviews", "positive", "neutral", "negatives", "recent_reviews", "recent_negatives")


def document(rows: DataFrame, small: int = 30, few: int = 5, products: int = 10, least: int = 3, themes: int = 15) -> DataFrame:
    """(scope, json): all sections of a scope's reviews as one JSON document.

    Every entry has reviews, negatives, their share in percent, and small_sample (fewer than `small`
    reviews); groups and types also their last third against the rest, few_mentions where both have fewer
    than `few` negatives. Groups come by negatives, then reviews, then name. At most `products` products
    with `least` negatives or more, and `themes` themes, are listed.
    """
    pct = lambda n, m: F.round(100 * F.try_divide(n, F.nullif(m, F.lit(0).cast("long"))), 1)
    part = lambda n, m: F.struct(n.alias("reviews"), m.alias("negatives"), pct(m, n).alias("negative_share_pct"), (n < small).alias("small_sample"))
    n, m, rn, rm = (F.col(c) for c in ("reviews", "negatives", "recent_reviews", "recent_negatives"))
    trend = F.struct(part(rn, rm).alias("recent"), part(n - rn, m - rm).alias("earlier"), (m < few).alias("few_mentions")).alias("trend")
    own = [n.alias("reviews"), m.alias("negatives"), pct(m, n).alias("negative_share_pct"), (n < small).alias("small_sample")]
    t = section_tallies(rows).withColumn("place", F.row_number().over(Window.partitionBy("scope", "section", "kind").orderBy(F.desc("negatives"), F.desc("reviews"), "area", "product")))

    def listed(section: str, entry: Column, order: Sequence[Column], where: Column | None = None) -> Column:
        """array of the entries of a section, in order."""
        chosen = (F.col("section") == section) & (F.lit(True) if where is None else where)
        return F.transform(F.array_sort(F.collect_list(F.when(chosen, F.struct(F.struct(*order).alias("o"), entry.alias("e"))))), lambda x: x["e"])

    named = lambda c: F.struct(F.col(c).alias("name"), *own, trend)
    by_size = [-m, -n, F.col("area"), F.col("product")]
    of = lambda kind: F.col("kind") == kind
    whole = lambda c: F.max(F.when(F.col("section") == "sentiment", F.col(c)))
    sums = t.groupBy("scope").agg(
        F.struct(*(whole(c).alias(c) for c in ("reviews", "positive", "neutral", "negatives")), pct(whole("negatives"), whole("reviews")).alias("negative_share_pct")).alias("sentiment"),
        listed("by_review_type_and_source", F.struct("kind", "source", *own, trend), [F.col("kind"), F.col("source")]).alias("by_review_type_and_source"),
        listed("by_group", named("area"), by_size, of("product")).alias("product_by_sector_group"), listed("by_group", named("area"), by_size, of("service")).alias("service_by_aspect"),
        listed("by_group_and_source", F.struct("kind", F.col("area").alias("name"), "source", *own), [F.col("kind"), F.col("area"), F.col("source")]).alias("groups_by_source"),
        listed("monthly_negative", F.struct("month", *own), [F.col("month")]).alias("monthly_negative"),
        listed("by_product", F.struct(F.col("product").alias("name"), *own), by_size, of("product") & F.col("product").isNotNull() & (m >= least) & (F.col("place") <= products + 1)).alias("p"),
    )

    every = scoped(rows)
    said = every.where("sentiment = 'negative'").select("scope", "uid", F.explode("themes").alias("theme")).withColumn("key", theme_key(F.col("theme"))).where("key <> ''")
    spelled = said.distinct().groupBy("scope", "key", "theme").agg(F.count("*").alias("k"))
    label = spelled.groupBy("scope", "key").agg(F.min(F.struct((-F.col("k")).alias("k"), "theme"))["theme"].alias("theme"))
    counted = said.select("scope", "uid", "key").distinct().groupBy("scope", "key").agg(F.count("*").alias("count")).join(label, ["scope", "key"])
    top = counted.withColumn("r", F.row_number().over(Window.partitionBy("scope").orderBy(F.desc("count"), "key"))).where(F.col("r") <= themes)
    told = top.groupBy("scope").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "theme", "count"))), lambda x: F.struct(x["theme"].alias("theme"), x["count"].alias("count"))).alias("top_negative_themes"))
    window = every.groupBy("scope").agg(F.struct(F.min("start").cast("string").alias("start"), F.max("end").cast("string").alias("end"), F.max("recent_start").cast("string").alias("recent_start"), F.count("*").alias("reviews"), F.count_if("recent").alias("recent_reviews")).alias("window"))
    sections = ["by_review_type_and_source", "product_by_sector_group", "service_by_aspect", "groups_by_source", "monthly_negative"]
    whole_document = F.struct("window", "scope", F.lit(small).alias("small_sample_threshold_reviews"), "sentiment", *sections, F.slice("p", 1, products).alias("products_most_negative"), F.coalesce("top_negative_themes", F.array().cast("array<struct<theme:string,count:bigint>>")).alias("top_negative_themes"))
    return sums.join(window, "scope").join(told, "scope", "left").select("scope", F.to_json(whole_document, {"ignoreNullFields": "false"}).alias("json"))
