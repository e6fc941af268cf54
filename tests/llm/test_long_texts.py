"""Texts beyond a block of 2 MB, and hot sources, through every operator."""

import random

import pytest
from corpus import words

from quarrymill.llm import fingerprints, language_id, mixing, near_duplicates, packing, quality_model, quality_rules, secrets, token_counts
from quarrymill.llm.arrays import BLOCK_BYTES

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def long():
    rng = random.Random(1)
    text = " ".join(f"w{rng.randint(0, 40_000)}{rng.choice(['', ',', '.', 'é'])}" for _ in range(330_000))
    assert len(text.encode()) > BLOCK_BYTES
    return text + ' token = "' + "0a1b2c3d" * 5 + '" end'


def rows(spark, long):
    other = long[:1_000] + " changed " + long[1_000:]
    return spark.createDataFrame([(1, long, "en", "a"), (2, "short text", "de", "a"), (3, other, "en", "b"), (4, None, None, None)], "doc_id long, text string, lang string, source string")


def test_counts_and_ids_of_long_texts(spark, long):
    import sentencepiece
    from tokenizers import Tokenizer

    docs = rows(spark, long)
    sp = sentencepiece.SentencePieceProcessor(model_file=(piece := public_tokenizers.path("piece_bpe_32k.model")))
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, piece).collect()}[1] == len(sp.encode(long))
    bpe = public_tokenizers.path("byte_bpe_50k.json")
    pieces = [p for p in packing.pack_documents(docs, bpe).collect() if p.doc_id == 1]
    n = len(Tokenizer.from_file(bpe).encode(long, add_special_tokens=False).ids) + 1
    assert sum(p.length for p in pieces) == n and all(p.doc_tokens == n for p in pieces)


def test_rules_sets_and_mixes_of_long_texts(spark, long):
    docs, n = rows(spark, long), len(words(long))
    by = lambda df: {r.doc_id: r for r in df.collect()}
    assert by(quality_rules.repetition_rules(docs))[1].n_words == n
    near = by(near_duplicates.near_duplicates(docs))
    low = words(long.lower())
    assert near[1].n_shingles == len({tuple(low[i : i + 5]) for i in range(len(low) - 4)}) and near[3].component_id == 1
    assert by(mixing.mix_sources(docs))[1].size == n
    prints = by(fingerprints.compare_edits(docs))
    assert prints[1].n_chars == len(long) and len(prints) == 4
    assert 0 <= by(quality_model.score_quality(docs, quality_model.FactorisationMachine(len(quality_model.STATS))))[1].score <= 1
    pages = docs.selectExpr("doc_id as page_id", "source as url", "text as html")
    assert {r.page_id: r.lang for r in language_id.identify_languages(pages, language_id.train_text(docs)).collect()}[1] == "en"


def test_secrets_at_the_end_of_long_texts(spark, long):
    clean = {r.doc_id: r.text for r in secrets.redact_documents(rows(spark, long), path_col="source").collect()}
    assert clean[2] == "short text" and clean[4] is None
    found = [r for r in secrets.find_candidates(rows(spark, long).where("doc_id = 1")).collect() if r.kind == "assigned"]
    assert [(r.value, r.start) for r in found] == [("0a1b2c3d" * 5, long.index("0a1b2c3d"))]
