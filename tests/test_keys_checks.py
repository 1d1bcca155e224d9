"""Surrogate keys and constraint checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martloom.operators.checks import (
    ConstraintError,
    foreign_key_violations,
    primary_key_violations,
    require_foreign_keys,
    require_primary_key,
)
from martloom.operators.keys import ordered_key, surrogate_key


@pytest.mark.parametrize("buckets", [1, 7, 4096])
@pytest.mark.parametrize("count", [0, 1, 1000])
def test_keys_run_from_one_without_gap(spark, buckets, count):
    df = spark.range(count).select(F.concat(F.lit("n"), "id").alias("name"))
    keys = [r["key"] for r in surrogate_key(df, "key", ["name"], buckets).collect()]
    assert sorted(keys) == list(range(1, count + 1))


def test_null_is_a_key_of_its_own(spark):
    df = spark.createDataFrame([("a",), (None,)], "name string")
    assert surrogate_key(df, "key", ["name"], 8).count() == 2


def test_ordered_key_follows_the_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    assert sorted(map(tuple, ordered_key(df, "key", ["name"]).collect())) == [
        (1, "a"), (2, "b"), (3, "c"),
    ]


def test_primary_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "row_id int")
    got = {(r["row_id"], r["row_count"]) for r in primary_key_violations(df, ["row_id"]).collect()}
    assert got == {(1, 2), (None, 1)}
    with pytest.raises(ConstraintError, match="core_raw"):
        require_primary_key(df, "core_raw")


def test_foreign_key_violations_skip_null(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "date_id int")
    parent = spark.createDataFrame([(1,), (2,)], "date_id int")
    assert [r["date_id"] for r in foreign_key_violations(child, "date_id", parent).collect()] == [5]
    with pytest.raises(ConstraintError, match="dim_order.date_id"):
        require_foreign_keys({"dim_order": child, "dim_date": parent})
