"""Every registered query against SQL on another engine, over the test tables."""

from __future__ import annotations

import os
import pathlib

import pytest
from compare import spark_bag, sql_bag

import __spark_entry__ as contract
from martloom.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for file in pathlib.Path(FOLDER).glob("*.parquet"):
        made.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return made


def test_every_query_of_the_warehouse_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert spark_bag(contract.queries()[name](spark, FOLDER)) == sql_bag(
        connection, contract.oracle_sql()[name]
    )


def test_entry(spark):
    assert contract.entry(spark).columns == ["year", "category_name", "sum_of_sale"]
