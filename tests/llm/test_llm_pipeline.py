"""The corpus pipeline against brute force, stage by stage, over the smallest test tables."""

from __future__ import annotations

import hashlib
import pathlib
import re

import pytest
from test_llm_operators import slow_components, slow_dropped, slow_fingerprint, slow_statistics, words

import corpus_pipeline
from martloom.llm import common, quality

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).is_dir(), reason="no test tables")


def passes(text, rules):
    """The fixed rules and the learned list, on statistics counted here."""
    n, chars, symbols, duplicates, repeated = slow_statistics(text)
    if n < 10 or 100 * repeated > 20 * n:
        return False
    lines = [x for x in text.split("\n") if words(x)]
    values = {
        "words": n,
        "mean_word": chars / n,
        "symbols_per_word": symbols / n,
        "duplicate_line_share": duplicates / len(lines),
        "repeat_share": repeated / n,
        "capital_share": len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text)) / chars,
    }
    held = lambda c: (values[c.ratio] > c.threshold) == c.above
    return not any(all(map(held, rule)) for rule in rules)


def without(text, gone):
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)


def test_pipeline_rows(spark):
    documents = common.read_table(spark, FOLDER, "documents")
    rules = quality.fit(documents, common.read_table(spark, FOLDER, "labels"))
    docs = {r["doc_id"]: r["text"] for r in documents.collect()}
    docs = {i: t for i, t in docs.items() if passes(t, rules)}
    dropped = slow_dropped(list(docs.items()))
    docs = {i: without(t, dropped[(i, t)]) for i, t in docs.items()}
    docs = {i: t for i, t in docs.items() if words(t)}
    prints = {i: slow_fingerprint(t, 3) for i, t in docs.items()}
    group = slow_components(prints.values(), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i in sorted(docs):
        first.setdefault(group[prints[i]], i)
    docs = {i: docs[i] for i in first.values()}
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: cut.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t))
    windows = {}
    for r in common.read_table(spark, FOLDER, "benchmark").collect():
        w = low(r["text"])
        for k in range(max(len(w) - 9, 1)):
            windows.setdefault(len(w[k : k + 10]), set()).add(tuple(w[k : k + 10]))

    def clean(text):
        w = low(text)
        return not any(tuple(w[k : k + n]) in known for n, known in windows.items() for k in range(len(w) - n + 1))

    docs = {i: t for i, t in docs.items() if clean(t)}
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(common.vocabulary_path())
    want = {}
    for i, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in rows} == want
    assert len(rows) == len(want) > 50


def test_stages_keep_the_columns_of_documents(spark):
    docs = common.read_table(spark, FOLDER, "documents").limit(30)
    none = docs.filter("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, FOLDER).columns == docs.columns, name
        assert stage(spark, none, FOLDER).count() == 0, name
