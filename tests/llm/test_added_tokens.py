import zlib

import corpus_pipeline
import numpy as np
import pytest
from corpus import frame

from quarrymill.llm import packing, queries

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_ids_are_those_of_the_unchanged_library(spark, tmp_path):
    from tokenizers import Tokenizer

    model, end = public_tokenizers.path("byte_bpe_50k.json"), "<|endoftext|>"
    library = Tokenizer.from_file(model)
    values = [f"a {end} b", end, f"{end}{end}", f"x  {end}\n\n {end}  y's", "", None, "plain text", "ends with <|endo", "ftext|> begins", f"<|endo{end}ftext|>", f"é日{end}ﬁ 'll", f"'{end}s  "] * 2
    want = [library.encode(v or "", add_special_tokens=False).ids for v in values]
    assert want[0] == [64, 220, 50256, 275]
    texts = [(v or "").encode() for v in values]
    ids, counts = packing.Encoder(model, added_tokens=True).block(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]

    docs = frame(spark, values)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op2_sum_of_squares_packing(spark, str(tmp_path)).collect() + corpus_pipeline.packing_stage(spark, docs, "").collect():
        own = np.array([*want[r.doc_id], 0], "<u4")
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
