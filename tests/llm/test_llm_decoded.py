"""The last stage of the pipeline decodes what it encodes."""

from __future__ import annotations

import hashlib

import pytest
from test_llm_operators import DOCS

import corpus_pipeline
from martloom.llm import common


def test_pipeline_decodes_what_it_encodes(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(common.vocabulary_path())
    docs = spark.createDataFrame([(1, "Hello World, it's NOT 1234!"), (2, "l'été\tsoﬁ 漢字"), (3, None), (4, "")], DOCS)
    _, stage = corpus_pipeline.STAGES[-1]
    rows = stage(spark, docs, "").collect()
    assert len(rows) == 4
    for r in rows:
        text = library.decode(r["ids"], skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
