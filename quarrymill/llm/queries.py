"""The registered queries of the corpus operators: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontamination, fingerprints, language_id, mixing, near_duplicates, packing, periodic_runs, quality_model, quality_rules, secrets, suffix_dedup, token_counts
from .common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~quality_model.held_out()).select("doc_id", "quality")
    machine = quality_model.train(docs, labels, meta_cols=["n_chars"])
    scored = quality_model.score_quality(docs, machine, meta_cols=["n_chars"])
    return scored.select("doc_id", quality_model.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), added_tokens=True)


def op3_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op4_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.repetition_rules(table(spark, sf_dir, "documents"))


def op5_fused_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train_text(table(spark, sf_dir, "documents"))
    return language_id.identify_languages(table(spark, sf_dir, "pages"), model)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), path_col="source")
    return found.select("doc_id", "start", F.length("value").alias("length"), "kind", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def op8_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), share=(85, 100))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = periodic_runs.strongest_run(F.col("runs"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.with_damage(table(spark, sf_dir, "conversations"))
    found = conversations.repair_conversations(damaged, copies_col="copies")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.encode("repaired", "UTF-8"), 256).alias("repaired_sha256"))


_OPERATORS = (
    op1_factorisation_machine, op2_sum_of_squares_packing, op3_transducer_token_counts, op4_suffix_array_repetition, op5_fused_language, op6_suffix_array_dedup,
    op7_forest_secret_scan, op8_bottom_k_near_duplicates, op9_order_minhash, op10_mix_sources, op11_periodic_runs, op12_benchmark_decontamination, op13_conversation_repair,
)
QUERIES = {f.__name__: f for f in _OPERATORS}

_NEAR = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c ON c.doc_id = s.doc_id"""

_LEAKS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
i AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM k),
g AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM i),
j AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM g)),
h AS (SELECT DISTINCT doc_id, i, j.k, item_id FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM j) j JOIN g ON g.k = j.k AND g.g = j.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id"""

#: DuckDB SQL where it can express the query. The others hold numbers of a fitted model, of a
#: tokenizer, of seeded hashes or of suffix arrays; tests/llm compares them with brute force.
ORACLES: dict[str, str] = {"op8_bottom_k_near_duplicates": _NEAR, "op12_benchmark_decontamination": _LEAKS}
