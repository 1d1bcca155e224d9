"""Lines landed as delimited files just as they are."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom import queries
from martloom.schemas import ORDER_LINE_COLUMNS
from martloom.sources import star_schema
from martloom.sources.order_lines_csv import read_raw_csv
from martloom.sources.star_schema import LANDED_GZIP, ORDER_LINE_NAMES, land_csv, land_fields

HEADER = ",".join(header for header, _, _ in ORDER_LINE_COLUMNS)


def test_each_task_writes_and_heads_its_own_files(spark, tmp_path):
    """No task gathers the lines of a file from the others: a file of several tasks' lines
    is several files, each starting with the header, and every line comes back once."""
    fields = (
        spark.range(400)
        .repartition(4)
        .select(*[F.concat(F.lit(f"{name}-"), F.col("id").cast("string")).alias(name) for name in ORDER_LINE_NAMES])
    )
    land_fields(fields, str(tmp_path / "landing"), files=2)
    written = [p for p in (tmp_path / "landing").rglob("part-*") if p.stat().st_size]
    assert all(Path(p).read_text().split("\n", 1)[0] == HEADER for p in written)
    assert len(written) > 2
    back = read_raw_csv(spark, str(tmp_path / "landing"))
    assert sorted(r["order_id"] for r in back.collect()) == sorted(f"order_id-{i}" for i in range(400))


def test_a_gzip_landing_reads_back_whole(spark, tmp_path):
    """The refreshes land gzip files: each is one task's lines, and all come back as they were."""
    lines = (
        spark.range(300)
        .repartition(3)
        .select(*[F.concat(F.lit(f"{name}, \"x\" "), F.col("id").cast("string")).alias(name) for name in ORDER_LINE_NAMES])
    )
    lines = lines.withColumn("order_date", F.to_date(F.lit("2020-03-04"))).withColumn(
        "ship_date", F.to_date(F.lit("2020-03-05"))
    )
    land_csv(lines, str(tmp_path / "landing"), "gzip")
    written = [p.name for p in (tmp_path / "landing").glob("part-*")]
    assert written and all(name.endswith(".csv.gz") for name in written)
    back = read_raw_csv(spark, str(tmp_path / "landing"), LANDED_GZIP)
    assert sorted(r["order_id"] for r in back.collect()) == sorted(f'order_id, "x" {i}' for i in range(300))


def _table_lines(spark, count=300):
    lines = spark.range(count).repartition(3).select(
        *[F.concat(F.lit(f"{name} "), F.col("id").cast("string")).alias(name) for name in ORDER_LINE_NAMES]
    )
    day = F.to_date(F.lit("2020-03-04"))
    return lines.withColumns({"order_date": day, "ship_date": day})


def test_gzip_fields_read_back_whole(spark, tmp_path):
    """Quotes and line breaks of the caller come through a compressed landing as they were."""
    fields = _table_lines(spark).withColumn("order_date", F.lit("3/4/2020")).withColumn("ship_date", F.lit("3/5/2020"))
    fields = fields.withColumn("product_name", F.concat(F.lit('"'), "product_name", F.lit('\n""x"", y"')))
    land_fields(fields, str(tmp_path / "landing"), files=2, compression="gzip")
    written = [p for p in (tmp_path / "landing").rglob("part-*")]
    assert written and all(p.name.endswith(".gz") for p in written)
    back = read_raw_csv(spark, str(tmp_path / "landing"))
    names = sorted(r["product_name"] for r in back.select("product_name").collect())
    assert names == sorted(f'product_name {i}\n"x", y' for i in range(300))


def test_a_gzip_file_ends_after_so_many_lines(spark, tmp_path, monkeypatch):
    """A compressed file is one task, so it does not grow with the task that writes it."""
    monkeypatch.setattr(star_schema, "GZIP_LINES", 40)
    land_csv(_table_lines(spark), str(tmp_path / "landing"), "gzip")
    assert len(list((tmp_path / "landing").glob("*.csv.gz"))) >= 300 // 40
    back = read_raw_csv(spark, str(tmp_path / "landing"), LANDED_GZIP)
    assert sorted(r["order_id"] for r in back.collect()) == sorted(f"order_id {i}" for i in range(300))


@pytest.fixture
def star(spark, tmp_path):
    """A few orders with two lines each, two lines of no order and one of no part."""
    folder = tmp_path / "star"
    tables = {
        "region": "VALUES (0, 'ASIA') t(r_regionkey, r_name)",
        "nation": "VALUES (0, 'CHINA', 0) t(n_nationkey, n_name, n_regionkey)",
        "customer": "VALUES (1L, 'Ann', 0, 'BUILDING'), (21L, 'Bob', 0, 'BUILDING')"
        " t(c_custkey, c_name, c_nationkey, c_mktsegment)",
        "part": "VALUES (1L, 'bolt', 'Brand#1', 'ECONOMY', 10.0D), (50L, 'ring', 'Brand#2', 'LARGE', 20.0D)"
        " t(p_partkey, p_name, p_brand, p_type, p_retailprice)",
        "orders": "SELECT id AS o_orderkey, IF(id % 2 = 0, 1L, 21L) AS o_custkey, '1-URGENT' AS o_orderpriority,"
        " timestamp'1998-02-06 10:00:00' AS o_orderdate FROM range(12)",
        "lineitem": "SELECT id % 13 AS l_orderkey, IF(id = 24, 7L, IF(id % 3 = 0, 1L, 50L)) AS l_partkey,"
        " double(id % 5 + 1) AS l_quantity, 0.05D AS l_discount, 0.02D AS l_tax,"
        " timestamp'1998-02-09 00:00:00' AS l_shipdate FROM range(0, 26, 1, 1)",
    }
    for name, rows in tables.items():
        text = rows if rows.startswith("SELECT") else f"SELECT * FROM {rows}"
        spark.sql(text).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("variant", star_schema.VARIANTS)
def test_whole_lines_are_the_same_lines(spark, star, variant):
    usual = star_schema.order_lines(spark, star, variant).collect()
    whole = star_schema.order_lines(spark, star, variant, whole=True).collect()
    assert sorted(usual) == sorted(whole)
    # two of 26 lines have no order, and one has no part
    assert len(whole) == (2 if variant == "repeated" else 1) * 23


def test_whole_lines_are_not_shuffled_with_their_orders_columns(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = star_schema.order_lines(spark, star, whole=True)
        text = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # line items meet parts below the join with orders, whose columns come from its other side
    joins = [line for line in text.split("\n") if "SortMergeJoin" in line]
    assert "l_orderkey" in joins[0] and any("l_partkey" in join for join in joins[1:])


def test_landings_join_the_tables_once_and_leave_no_files_of_an_earlier_day(spark, star, tmp_path, monkeypatch):
    joins = []
    monkeypatch.setattr(
        queries, "joined_lines", lambda *a, **k: joins.append(a) or star_schema.joined_lines(*a, **k)
    )
    found, root = [], tmp_path / "landing"
    for day in queries._landings(spark, star, str(root), "repeated", "plain"):
        (Path(day) / "READY").write_text("complete")
        found.append(read_raw_csv(spark, day, LANDED_GZIP).count())
    assert found == [46, 23] and len(joins) == 1
    assert [p.name for p in (root / "day-1").glob("[!._]*")] == ["READY"]
    assert list((root / "day-2").glob(LANDED_GZIP))


def test_shuffle_files_go_with_the_query_that_wrote_them(spark, tmp_path):
    """They stayed until the driver collected its garbage."""
    from martloom.sources.staging import shuffles_freed

    def kept() -> int:
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    rows = spark.range(1000).repartition(3)
    before = kept()
    rows.write.parquet(str(tmp_path / "kept"))
    assert kept() > before
    before = kept()
    with shuffles_freed(spark):
        spark.range(1000).repartition(3).write.parquet(str(tmp_path / "freed"))
    deadline = time.time() + 20
    while kept() > before and time.time() < deadline:
        time.sleep(0.2)
    assert kept() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_written_tables_are_compressed_with_zstd(spark, tmp_path):
    from martloom.sources.staging import Staging

    files = Staging(spark).save("some", spark.range(10)).inputFiles()
    assert files and all(file.endswith(".zstd.parquet") for file in files)
