"""Labelled samples of tables with repeated ids."""

from __future__ import annotations

import zlib

from test_llm_operators import DOCS

from martloom.llm import common


def test_sample_has_one_row_of_each_labelled_id(spark):
    hot = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5)
    docs = [(hot, f"text {i}") for i in range(40)] + [(hot, None)] + [(i, "x") for i in range(200, 260)]
    labels = [(i, 1) for i in {hot, *range(200, 260)}] + [(hot, 0)]
    documents = spark.createDataFrame(docs, DOCS)
    sample = lambda most: common.labelled_sample(
        documents, spark.createDataFrame(labels, "doc_id bigint, toxic int"), "toxic", most
    ).collect()
    rows = sample(1000)
    assert len(rows) == len({r["doc_id"] for r in rows})
    assert [r["label"] for r in rows if r["doc_id"] == hot] == [1]
    assert len(sample(10)) == 10
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sample(500)))
