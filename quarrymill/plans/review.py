"""Queries on reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import parsing, text
from quarrymill.operators import grounding, upsert
from quarrymill.operators import reviews as ops
from quarrymill.session import table

from .bindings import REVIEWS, reviews
from .registry import query

R6 = lambda c: F.round(c, 6)


@query(f"""WITH {REVIEWS} SELECT source, kind, count(*) AS reviews, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'negative') AS negative, round(avg(rating), 6) AS avg_rating,
count(*) FILTER (rating = 1) AS rating_1, count(*) FILTER (rating = 2) AS rating_2, count(*) FILTER (rating = 3) AS rating_3, count(*) FILTER (rating = 4) AS rating_4, count(*) FILTER (rating = 5) AS rating_5, round(count(*) FILTER (sentiment = 'positive') / count(*), 6) AS positive_share FROM reviews GROUP BY 1, 2""")
def review_summary(spark: SparkSession, d: str) -> DataFrame:
    s = ops.summary(reviews(spark, d), "source", "kind")
    return s.withColumns({"avg_rating": R6("avg_rating"), "positive_share": R6("positive_share")})


@query(f"""WITH {REVIEWS} SELECT area, source, count(*) AS reviews, count(*) FILTER (sentiment = 'negative') AS negatives, round(count(*) FILTER (sentiment = 'negative') / count(*), 6) AS negative_share, count(*) < 10 AS small_sample FROM reviews GROUP BY 1, 2""")
def review_tally(spark: SparkSession, d: str) -> DataFrame:
    return ops.tally(reviews(spark, d), "area", "source").withColumn("negative_share", R6("negative_share"))


@query(f"""WITH {REVIEWS}, s AS (SELECT kind, source, sentiment, count(*) AS n FROM reviews GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY kind, source) AS share FROM s)
SELECT kind, sentiment, round(coalesce(max(share) FILTER (source = 'shop'), 0), 6) AS left_share, round(coalesce(max(share) FILTER (source = 'market'), 0), 6) AS right_share, round(coalesce(max(share) FILTER (source = 'shop'), 0) - coalesce(max(share) FILTER (source = 'market'), 0), 6) AS difference FROM p GROUP BY 1, 2""")
def review_source_differences(spark: SparkSession, d: str) -> DataFrame:
    x = ops.source_differences(reviews(spark, d), "shop", "market")
    return x.select("kind", "sentiment", *(R6(c).alias(c) for c in ("left_share", "right_share", "difference")))


@query(f"""WITH {REVIEWS}, t AS (SELECT uid, unnest(themes) AS theme FROM reviews WHERE sentiment = 'negative'),
k AS (SELECT *, CASE WHEN theme LIKE 'Price%' THEN array_to_string(list_sort(['price', CASE WHEN theme LIKE '%es' THEN 'es' ELSE lower(split_part(theme, ' ', 2)) END]), ' ') WHEN theme LIKE '%deliver%' THEN 'delivery late' ELSE split_part(theme, ' ', 2) || ' size' END AS key FROM t),
sp AS (SELECT key, theme, count(DISTINCT uid) AS n FROM k GROUP BY 1, 2), b AS (SELECT key, theme AS spelling, row_number() OVER (PARTITION BY key ORDER BY n DESC, theme) AS r FROM sp), c AS (SELECT key, count(DISTINCT uid) AS reviews FROM k GROUP BY 1)
SELECT c.key, spelling, reviews FROM c JOIN b ON b.key = c.key AND r = 1 ORDER BY reviews DESC, c.key LIMIT 15""")
def negative_themes(spark: SparkSession, d: str) -> DataFrame:
    return ops.negative_themes(reviews(spark, d))


@query(f"""WITH {REVIEWS} SELECT product, count(*) AS reviews, count(*) FILTER (sentiment = 'negative') AS negatives, round(count(*) FILTER (sentiment = 'negative') / count(*), 6) AS negative_share, count(*) < 10 AS small_sample FROM reviews GROUP BY 1 HAVING count(*) FILTER (sentiment = 'negative') >= 3 ORDER BY negatives DESC, reviews DESC, product LIMIT 10""")
def worst_products(spark: SparkSession, d: str) -> DataFrame:
    return ops.worst_products(reviews(spark, d)).withColumn("negative_share", R6("negative_share"))


@query(f"""WITH {REVIEWS}, e AS (SELECT source, max(day) AS e FROM reviews GROUP BY 1), w AS (SELECT source, m, CAST(e - to_months(m) AS DATE) + 1 AS s, e FROM e, (SELECT unnest([3, 6]) AS m)), c AS (SELECT w.source, m, s, w.e, count(*) AS n FROM w JOIN reviews r ON r.source = w.source AND r.day BETWEEN s AND w.e GROUP BY ALL)
SELECT source, CAST(m AS INTEGER) AS months, strftime(s, '%Y-%m-%d') AS start, strftime(e, '%Y-%m-%d') AS "end", n AS reviews, strftime(e - CAST(greatest(1, (e - s + 1) // 3) - 1 AS INTEGER), '%Y-%m-%d') AS recent_start, n >= 20 AS is_used FROM c""")
def review_windows(spark: SparkSession, d: str) -> DataFrame:
    w = ops.windows(reviews(spark, d), (3, 6), 20)
    return w.select("source", "months", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("start", "end", "recent_start")), "reviews", "is_used")


@query(f"""WITH {REVIEWS}, g AS (SELECT area, count(*) FILTER (day < DATE '2024-09-01') AS a, count(*) FILTER (day >= DATE '2024-09-01') AS b, count(*) FILTER (day < DATE '2024-09-01' AND sentiment = 'negative') AS x, count(*) FILTER (day >= DATE '2024-09-01' AND sentiment = 'negative') AS y FROM reviews GROUP BY 1)
SELECT area, a AS earlier, b AS recent, x AS earlier_negatives, y AS recent_negatives, round(y / nullif(b, 0) - x / nullif(a, 0), 6) AS change FROM g WHERE a + b >= 5""")
def area_trend(spark: SparkSession, d: str) -> DataFrame:
    return ops.area_trend(reviews(spark, d), F.lit("2024-09-01").cast("date")).withColumn("change", R6("change"))


#: White space runs as one space, as Unicode has them.
_SPACED = r"trim(regexp_replace({}, '[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"


@query(rf"""WITH {REVIEWS}, b AS (SELECT uid, area, coalesce(confidence, 0) AS sure, {_SPACED.format('text')} AS spaced FROM reviews WHERE sentiment = 'negative' AND text IS NOT NULL),
o AS (SELECT * FROM b WHERE spaced <> '' QUALIFY row_number() OVER (PARTITION BY lower(spaced) ORDER BY sure DESC, uid) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY sure DESC, uid) AS depth, max(sure) OVER (PARTITION BY area) AS best FROM o),
p AS (SELECT CAST(row_number() OVER (ORDER BY depth, best DESC, area) AS INTEGER) AS place, area, uid,
  regexp_replace(regexp_replace(spaced, '[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+(\.[\p{{L}}\p{{N}}_-]+)+', '[email removed]', 'g'), '\+?\d[\d ()-]{{7,}}\d', '[number removed]', 'g') AS t FROM r)
SELECT place, area, uid, CASE WHEN length(t) <= 160 THEN t ELSE rtrim(CASE WHEN substring(t, 158, 1) = ' ' OR position(' ' IN left(t, 157)) = 0 THEN left(t, 157) ELSE regexp_replace(left(t, 157), ' [^ ]*$', '') END, ' ,;:-') || '...' END AS excerpt
FROM p WHERE place <= 40""")
def review_excerpts(spark: SparkSession, d: str) -> DataFrame:
    return ops.excerpts(reviews(spark, d), 40, 160)


@query("""WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) SELECT conv_id, turn AS last_turn, role, length(text) AS size FROM c WHERE r = 1""")
def last_turns(spark: SparkSession, d: str) -> DataFrame:
    c = upsert.latest(table(spark, d, "conversations"), ["conv_id"], ["turn"])
    return c.select("conv_id", F.col("turn").alias("last_turn"), "role", F.length("text").cast("long").alias("size"))


_MONTHS = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"


@query(rf"""WITH t AS (SELECT doc_id, text, replace(regexp_replace(coalesce(text, ''), '[À-ÖØ-öø-ʯͰ-῿぀-ヿ㐀-鿿가-힣]', 'x', 'g'), '%', '% ') AS a FROM documents),
p AS (SELECT doc_id, text, a, regexp_replace(a, '\b\d{{4}}-\d{{1,2}}(?:-\d{{1,2}})?\b|\b\d{{1,2}}[/.]\d{{1,2}}[/.]\d{{2,4}}\b|\b\d{{1,2}}(?:st|nd|rd|th)?\s+(?:of\s+)?{_MONTHS}\b\.?(?:,?\s+\d{{4}})?|\b{_MONTHS}\.?\s+\d{{1,2}}(?:st|nd|rd|th)?\b(?:,?\s+\d{{4}})?|\b(?:19|20)\d{{2}}\b|\b\d+\s*(?:months?|years?|weeks?|days?)\b', ' ', 'gi') AS b FROM t),
f AS (SELECT doc_id, text, a, regexp_extract_all(b, '(?i)(?:^|[^\w.])((?:\d{{1,3}}(?:,\d{{3}})+|\d+(?:\.\d+)?)\b(?:\s*(?:%|per\s?cent\b))?)', 1) AS f FROM p)
SELECT doc_id, length({_SPACED.format("coalesce(text, '')")}) AS spaced, len(f) AS numbers, len(list_filter(f, lambda x: regexp_matches(x, '(?i)(%|cent)$'))) AS percentages,
  round(coalesce(list_sum(list_transform(f, lambda x: least(CAST(replace(regexp_extract(x, '[\d,.]+'), ',', '') AS DOUBLE), 1e6))), 0), 3) AS total,
  len(list_distinct(list_filter(regexp_extract_all(a, '\w+'), lambda x: regexp_full_match(x, '[a-z][a-z0-9]*(?:_[a-z0-9]+)+')))) AS names FROM f""")
def text_measures(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    found = table(spark, d, "documents").select("doc_id", text.single_spaced(t).alias("spaced"), text.figures(t).alias("f"), text.identifiers(t).alias("names"))
    total = F.aggregate("f", F.lit(0.0), lambda a, x: a + F.least(x["value"], F.lit(1e6)))
    return found.select("doc_id", F.length("spaced").cast("long").alias("spaced"), F.size("f").cast("long").alias("numbers"), F.size(F.filter("f", lambda x: x["percent"])).cast("long").alias("percentages"), F.round(total, 3).alias("total"), F.size("names").cast("long").alias("names"))


@query("""SELECT p_partkey AS k, left(regexp_replace(regexp_replace(regexp_replace(translate(lower(trim(p_type)), '- ', '__'), '[^a-z0-9_]+', '', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), 40) AS slug, CAST(round_even(p_retailprice, 1) AS DOUBLE) AS price FROM part""")
def label_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), parsing.slug(F.col("p_type")).alias("slug"), F.bround("p_retailprice", 1).alias("price"))


def summary_documents(spark: SparkSession, d: str) -> DataFrame:
    """(summary, json): a source's reviews as the nested document that replies are held against."""
    r = reviews(spark, d)
    entry = F.struct(F.col("name"), "reviews", "negatives", F.round(100 * F.col("negative_share"), 1).alias("negative_share_pct"), "small_sample")
    areas = ops.tally(r, "source", "area", small=30).withColumn("name", F.initcap("area")).groupBy("source").agg(F.sort_array(F.collect_list(entry)).alias("areas"))
    whole = r.groupBy("source").agg(F.count("*").alias("reviews"), F.count_if(F.col("sentiment") == "negative").alias("negatives"), F.min("day").alias("start"), F.max("day").alias("end"))
    share = F.round(100 * F.col("negatives") / F.col("reviews"), 1).alias("negative_share_pct")
    window = F.struct(F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"), F.concat(F.lit("reviews of the last 12 months: "), F.col("reviews").cast("string")).alias("label"))
    document = F.struct(window.alias("window"), F.lit(30).alias("small_sample_threshold_reviews"), F.struct("reviews", "negatives", share).alias("sentiment"), F.col("areas").alias("product_by_sector_group"))
    return whole.join(areas, "source").select(F.col("source").alias("summary"), F.to_json(document).alias("json"))


#: What is planted in a reply, by its document's id: the fields that a kind changes in the first item, as JSON.
PLANTED = {
    1: '"rank": "1"', 2: '"rank": 1.5', 3: '"rationale": null', 4: '"evidence": "  "', 5: '"title": "TOOLONG200"', 6: '"description": "About 987654 people wrote in May 2024."', 7: '"title": "A significant change"', 8: '"evidence": "small_sample holds here."',
    9: '"related_area": "Nowhere"', 10: '"evidence_strength": "weak"', 11: '"title": "Fix it now", "evidence_strength": "Early  Signal"', 12: '"rank": 2', 13: '"rank": true', 14: '"description": "TOOLONG1000"', 15: '"rationale": "This is not  random, SHARE% of it."',
    16: '"evidence": "REVIEWS% of them."', 17: '"rationale": "Over 12 months to 2024-12-30, ROUNDED% of REVIEWS reviews, 3rd May 2024."', 18: '"related_area": "SMALLEST"', 19: '"title": 5', 20: '"evidence_strength": "STRONG"', 21: '"related_area": "OVERALL"',
}


def planted_replies(spark: SparkSession, d: str) -> DataFrame:
    """(reply, summary, json): a reply of three items for every review; most have one fault, by the review's number."""
    r = reviews(spark, d).select(F.col("uid").alias("reply"), F.col("source").alias("summary"), F.substring("uid", 2, 20).cast("long").alias("k"))
    tallies = ops.tally(reviews(spark, d), "source", "area", small=30)
    least = tallies.groupBy(F.col("source").alias("_s")).agg(F.min_by(F.initcap("area"), F.struct("reviews", "area")).alias("smallest"), F.sum("reviews").alias("n"), F.round(100 * F.sum("negatives") / F.sum("reviews"), 1).alias("share"))
    r = r.join(least, F.col("summary") == F.col("_s"))
    kind = F.col("k") % 26

    fields = F.create_map(*(F.lit(x) for k, v in PLANTED.items() for x in (k, v)))
    changed = F.coalesce(F.try_element_at(fields, kind.cast("int")), F.lit('"rank": 1'))
    names = ("title", "description", "rationale", "related_area", "evidence", "evidence_strength")
    plain = {"title": '"Review the reports"', "description": '"They name it in REVIEWS reviews."', "rationale": '"That is SHARE% of them."', "related_area": '"overall"', "evidence": '"REVIEWS reviews in the window."', "evidence_strength": '"moderate"'}

    def document(rank: int, extra: Column) -> Column:
        v = F.try_parse_json(F.concat(F.lit("{"), extra, F.lit("}")))
        given = lambda f: F.to_json(F.try_variant_get(v, f"$.{f}", "variant"))
        has = lambda f: extra.contains(f'"{f}":')
        parts = [F.concat(F.lit(f'"{f}": '), F.when(has(f), F.coalesce(given(f), F.lit("null"))).otherwise(F.lit(plain[f]))) for f in names]
        rank_part = F.concat(F.lit('"rank": '), F.when(has("rank"), given("rank")).otherwise(F.lit(str(rank))))
        return F.concat(F.lit("{"), F.array_join(F.array(*parts, rank_part), ", "), F.lit("}"))

    items = F.concat(document(1, changed), F.lit(", "), document(2, F.lit('"rank": 2')), F.lit(", "), document(3, F.lit('"rank": 3')))
    json = F.when(kind == 22, '{"answer": []}').when(kind == 23, F.concat(F.lit('{"items": ['), document(1, F.lit('"rank": 1')), F.lit(', 7, "x"]}'))).when(kind == 24, F.concat(F.lit('{"items": ['), document(1, F.lit('"rank": 1')), F.lit("]}"))).when(kind == 25, "no json")
    json = json.otherwise(F.concat(F.lit('{"items": ['), items, F.lit("]}")))
    for word, value in (("TOOLONG1000", F.repeat(F.lit("word "), F.lit(210))), ("TOOLONG200", F.repeat(F.lit("word "), F.lit(50))), ("REVIEWS", F.col("n").cast("string")), ("SHARE", F.col("share").cast("string")), ("ROUNDED", F.floor(F.col("share") + 0.5).cast("string")), ("SMALLEST", F.col("smallest"))):
        json = F.replace(json, F.lit(word), value)
    return r.select("reply", "summary", json.alias("json"))


@query()
def grounded_replies(spark: SparkSession, d: str) -> DataFrame:
    """Every broken rule of a reply a review, each against its source's summary."""
    return grounding.check_replies(planted_replies(spark, d), summary_documents(spark, d))[0]


@query()
def accepted_items(spark: SparkSession, d: str) -> DataFrame:
    """The items of replies that break no rule."""
    return grounding.check_replies(planted_replies(spark, d), summary_documents(spark, d))[1]


@query(f"""WITH {REVIEWS}, e AS (SELECT 'All' AS scope, * FROM reviews UNION ALL SELECT source, * FROM reviews), b AS (SELECT scope, min(day) AS s, max(day) AS t FROM e GROUP BY 1),
x AS (SELECT e.*, strftime(day, '%Y-%m') AS month, day > t - CAST(greatest(1, (t - s + 1) // 3) AS INTEGER) AS recent FROM e JOIN b ON b.scope = e.scope)
SELECT scope, CASE WHEN grouping(month) = 0 THEN 'monthly_negative' WHEN grouping(product) = 0 THEN 'by_product' WHEN grouping(area) = 0 AND grouping(source) = 0 THEN 'by_group_and_source' WHEN grouping(area) = 0 THEN 'by_group' WHEN grouping(kind) = 0 THEN 'by_review_type_and_source' ELSE 'sentiment' END AS section,
  kind, area, source, month, product, count(*) AS reviews, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'negative') AS negatives, count(*) FILTER (recent) AS recent_reviews, count(*) FILTER (recent AND sentiment = 'negative') AS recent_negatives
FROM x GROUP BY GROUPING SETS ((scope), (scope, kind, source), (scope, kind, area), (scope, kind, area, source), (scope, month), (scope, kind, product))""")
def scope_sections(spark: SparkSession, d: str) -> DataFrame:
    """Counts of every section of every scope's summary, from one pass."""
    return ops.section_tallies(reviews(spark, d))


@query()
def scope_summaries(spark: SparkSession, d: str) -> DataFrame:
    """The whole summary document of each scope."""
    return ops.document(reviews(spark, d))
