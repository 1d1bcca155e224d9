"""Mixing by hash thresholds against a sort of all documents, and against SQL."""

from __future__ import annotations

import hashlib
import pathlib
import re
from collections import Counter, defaultdict

import pytest
from compare import spark_bag, sql_bag

from martloom.llm import mixing, registry

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, source string, size string, key int, whole int, row string"


def slow_targets(sizes, weights, repeats):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(repeats * sizes[s] for s in full)
        free = sum(weight[s] for s in sizes if s not in full)
        level = left / free if free else 0.0
        more = {s for s in sizes if s not in full and weight[s] * level > repeats * sizes[s]}
        if not more:
            return {s: float(repeats * sizes[s]) if s in full else weight[s] * level for s in sizes}
        full |= more


def slow_mix(rows, weights=(5, 2, 1), repeats=3):
    """Rows (doc_id, text, source) to a bag of (doc_id, source, size, taken), by sorting."""
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += count(text)
    goal = slow_targets(sizes, weights, repeats)
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        name = ("?" if doc_id is None else str(doc_id)) + ("?" if text is None else ":") + (text or "")
        by_source[source].append((int(hashlib.md5(name.encode()).hexdigest()[:15], 16), count(text), doc_id))
    out = Counter()
    for source, docs in by_source.items():
        whole = int(goal[source] // sizes[source]) if sizes[source] else 0
        budget, used = goal[source] - whole * sizes[source], 0
        for _, size, doc_id in sorted(docs, key=lambda d: d[0]):
            once_more = budget > 0 and size > 0 and used <= budget and 2 * (budget - used) >= size
            # the first document that does not fit ends it
            out[doc_id, source, size, size * (whole + once_more)] += 1
            used += size
    return out, goal


def mixed(spark, rows, **options):
    table = spark.createDataFrame([(*r, "a", 1, 2, "b") for r in rows], SCHEMA)
    found = mixing.mixed(table, **options).collect()
    return Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in found), found


def documents():
    rows = [(i, "w " * (i * 7919 % 400), f"s{i % 23}" if i % 3 else "hot") for i in range(3000)]
    rows += [(5, "same text again", "equal")] * 700 + [(None, "é ü", None), (None, None, None), (1, "", "hot")]
    rows += [(9000, "word " * 50_000, "long"), (9001, " \t\n", "blank"), (9002, None, "blank"), (9003, "one", "é")]
    return rows


def test_against_a_sort_of_all_documents(spark):
    rows = documents()
    found, table = mixed(spark, rows)
    want, goal = slow_mix(rows)
    assert found == want
    taken, largest = Counter(), Counter()
    for row in table:
        assert row["taken"] <= 3 * row["size"]
        assert row["target"] == pytest.approx(goal[row["source"]], rel=1e-12)
        taken[row["source"]] += row["taken"]
        largest[row["source"]] = max(largest[row["source"]], row["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6 for s in goal)


def test_other_weights_and_nested_budgets(spark):
    rows = [(i, "w " * (i % 97 + 1), f"s{i % 4}") for i in range(800)]
    assert mixed(spark, rows, weights=(1, 9), repeats=2)[0] == slow_mix(rows, (1, 9), 2)[0]
    tables = [mixed(spark, rows, share=share)[1] for share in (0.2, 0.5, 0.9)]
    taken = [{r["doc_id"]: r["taken"] for r in t} for t in tables]
    assert all(small[d] <= large[d] for small, large in zip(taken, taken[1:], strict=False) for d in small)


def test_empty_table_and_reruns(spark):
    assert mixed(spark, [])[0] == Counter()
    assert mixed(spark, [(1, None, None)])[0] == {(1, None, 0, 0): 1}
    table = spark.createDataFrame([(*r, "a", 1, 2, "b") for r in documents()], SCHEMA)
    assert spark_bag(mixing.mixed(table)) == spark_bag(mixing.mixed(table.repartition(7)))


@pytest.mark.skipif(not pathlib.Path(FOLDER).is_dir(), reason="no test tables")
def test_registered_query_matches_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    name = "op12_mix_weights"
    assert spark_bag(registry.QUERIES[name](spark, FOLDER)) == sql_bag(connection, registry.ORACLE_SQL[name])
