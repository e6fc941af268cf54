import pytest
from corpus import SCHEMA, frame

from quarrymill.llm import fingerprints, language_id, mixing, near_duplicates, packing, quality_model, quality_rules, secrets, suffix_dedup, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


def operators(spark):
    bpe, piece = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return {
        "quality": lambda d: quality_model.score_quality(d, quality_model.FactorisationMachine(len(quality_model.STATS))),
        "packing": lambda d: packing.pack_documents(d, bpe),
        "tokens": lambda d: token_counts.count_tokens(d, piece),
        "rules": quality_rules.repetition_rules,
        "language": lambda d: language_id.identify_languages(d.selectExpr("doc_id as page_id", "source as url", "text as html"), language_id.train_text(d)),
        "removal": suffix_dedup.remove_repeats,
        "secrets": secrets.scan_secrets,
        "near": near_duplicates.near_duplicates,
        "edits": fingerprints.compare_edits,
        "mixing": mixing.mix_sources,
    }


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for name, f in operators(spark).items():
        assert f(empty).count() == 0, name


def test_only_null_and_empty_texts(spark):
    docs = frame(spark, [None, "", None, " "])
    for name, f in operators(spark).items():
        out = f(docs)
        n = out.select("doc_id").distinct().count() if name == "packing" else out.count()
        assert n == (0 if name == "secrets" else 4), name


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    import corpus_pipeline as p

    docs = frame(spark)
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if name == "packing":
            assert docs.agg({"length": "sum"}).first()[0] > 0
            continue
        assert docs.columns == before.columns
        if name in ("quality_rules", "near_duplicates"):
            assert docs.count() < before.count()
        if name == "secrets":
            assert docs.count() == before.count() and docs.where("text like '%AKIA%'").count() == 0 and docs.where("text like '%[secret]%'").count() > 0
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "mixing":
            assert docs.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3


def test_registered_queries_name_all_thirteen():
    from quarrymill.llm.queries import QUERIES

    assert sorted(int(x.split("_")[0][2:]) for x in QUERIES) == list(range(1, 14))
