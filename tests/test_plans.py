"""Physical plans: what keeps the jobs fit for large tables."""

from __future__ import annotations

import re

import pytest

from martloom.config import MartConfig
from martloom.operators.keys import surrogate_key
from martloom.plans.marts import mart_sub_category_sales
from martloom.plans.raw import core_raw
from martloom.sources.star_schema import order_lines
from martloom.queries import core_layer

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layer(spark):
    return core_layer(spark, FOLDER)


def test_segment_reaches_the_customer_scan(spark):
    text = plan(core_raw(order_lines(spark, FOLDER), "BUILDING"))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in text


def test_dimension_scan_reads_its_columns_only(spark):
    text = plan(order_lines(spark, FOLDER).select("ship_mode").distinct())
    assert "l_extendedprice" not in text and "p_name" not in text and "c_name" not in text


def test_fact_sums_before_it_joins(layer):
    from martloom.plans.fact import fact_sales

    text = plan(fact_sales(layer.lines, layer.tables(), MartConfig()))
    partial_sums = re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[[^\]]*partial_sum", text)
    assert len(partial_sums) == 1
    # the aggregate stands below every join, so it is printed after them
    assert text.index("partial_sum") > max(m.start() for m in re.finditer("Join", text.split(
        "partial_sum")[0]))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "SinglePartition" not in text


def test_only_bucket_sizes_meet_in_one_task(spark):
    df = spark.range(100).selectExpr("cast(id as string) AS name").distinct()
    text = plan(surrogate_key(df, "key", ["name"], 16))
    assert text.count("SinglePartition") == 1
    single = text[text.index("SinglePartition"):]
    below = single.split("\n")[1]
    assert "HashAggregate(keys=[_bucket" in below


def test_mart_conditions_reach_their_dimensions(layer):
    text = plan(mart_sub_category_sales(layer.tables(), "BUILDING", 1998, "ECONOMY"))
    for condition in (
        "EqualTo(segment_title,BUILDING)", "EqualTo(year,1998)", "EqualTo(category_name,ECONOMY)",
    ):
        assert condition in text
    assert "sum_of_sale" in text and "profit" not in text


def test_no_python_in_any_plan(layer):
    from martloom.plans.fact import fact_sales

    text = plan(fact_sales(layer.lines, layer.tables(), MartConfig()))
    assert "Python" not in text and "Pandas" not in text


def test_no_join_shuffles_unsummed_fact_rows(spark, layer):
    from martloom.plans.marts import mart_sales_by_year

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart in (
            mart_sales_by_year(layer.tables()),
            mart_sub_category_sales(layer.tables(), "BUILDING", 1998, "ECONOMY"),
        ):
            text = plan(mart)
            scan = next(line for line in text.split("\n") if "sum_of_sale" in line and "FileScan" in line)
            depth = len(scan) - len(scan.lstrip(" :+-"))
            above, exchanges = depth, []
            for line in reversed(text[: text.index(scan)].split("\n")):
                at = len(line) - len(line.lstrip(" :+-"))
                if line.strip() and at < above:
                    above = at
                    if "HashAggregate" in line:
                        break
                    if "Exchange hashpartitioning" in line:
                        exchanges.append(line)
            # fact and orders are read in buckets of the order
            assert not exchanges and "Bucketed: true" in scan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_read_once_for_each_grain_and_for_the_fact(spark, layer):
    from martloom.plans.core import GRAINS, build_core
    from martloom.sources.staging import Staging

    staging, readers = Staging(spark), {}

    def save(name, df):
        readers[name] = any("/core_raw-" in file for file in df.inputFiles())
        return staging.save(name, df)

    build_core(layer.lines, layer.config, save)
    assert {name for name, reads in readers.items() if reads} == {*GRAINS, "fact_sales"}
    assert len(readers) == len(GRAINS) + 15


def test_a_year_of_the_grain_is_a_partition_filter(layer):
    text = plan(mart_sub_category_sales(layer.tables(), "BUILDING", 1998, "ECONOMY", layer.grain()))
    assert re.search(r"FileScan.*PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1998\)\]", text)


def test_a_year_of_the_grain_is_few_files(layer):
    files = layer.grain().inputFiles()
    years = {re.search(r"year=(\d+)", file)[1] for file in files}
    assert len(years) > 3 and len(files) <= 2 * len(years)


def test_a_table_is_read_in_buckets_before_and_after_it_is_published(spark, tmp_path, make_lines):
    import uuid

    from martloom.plans.marts import sales_grain
    from martloom.plans.refresh import load_core
    from martloom.sources.tables import Warehouse

    config = MartConfig(order_buckets=4, key_buckets=4)
    place = str(tmp_path / "layers"), config, f"t{uuid.uuid4().hex[:8]}_"
    warehouse = Warehouse(spark, *place)
    warehouse.create_layers()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = [{"row_id": i + 1, "order_id": f"O-{i}", "product_id": f"P-{i % 3}"} for i in range(20)]
        staged = load_core(warehouse, make_lines(*lines))
        warehouse.publish()
        names = ("fact_sales", "dim_order", "dim_date")
        for tables in (staged, {n: warehouse.read_table(n) for n in names}, warehouse.read_load(*names)):
            text = plan(sales_grain(tables))
            scan = next(r for r in text.split("\n") if "FileScan" in r and "sum_of_sale" in r)
            assert "SelectedBucketsCount: 4 out of 4" in scan
            above = text[text.index("SortMergeJoin [order_id") : text.index(scan)]
            assert "Exchange" not in above
            assert sales_grain(tables).agg({"sum_of_sale": "sum"}).first()[0] == 400
        with pytest.raises(ValueError, match="made with 4 buckets"):
            Warehouse(spark, place[0], MartConfig(order_buckets=8), place[2]).write_table(
                "dim_order", staged["dim_order"]
            )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        warehouse.drop_layers()


def test_joins_of_later_readers_are_planned_by_counts(spark, tmp_path):
    import uuid

    from test_csv import ROW, write

    from martloom.plans.dims import shipment_path
    from martloom.plans.refresh import refresh
    from martloom.sources.tables import Warehouse

    config = MartConfig(year=2016, order_buckets=4, key_buckets=4)
    warehouse = Warehouse(spark, str(tmp_path / "layers"), config, f"t{uuid.uuid4().hex[:8]}_")
    warehouse.create_layers()

    def facts(table, column=""):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {warehouse.name_of(table)} {column}").collect()
        return {r[0]: r[1] for r in rows}

    def size_of_join():
        names = ("dim_shipment", "dim_date", "dim_ship_mode")
        joined = shipment_path(*[warehouse.read_table(n) for n in names])
        statistics = joined._jdf.queryExecution().optimizedPlan().stats()
        return int(str(statistics.sizeInBytes())), statistics.rowCount().isDefined()

    try:
        rows = [{**ROW, "Row ID": str(i), "Ship Date": f"11/{i % 28 + 1}/2016", "Order ID": f"O-{i}"} for i in range(200)]
        path = write(tmp_path / "a.csv", rows)
        refresh(warehouse, path, category="Furniture", statistics=False)
        by_files, counted = size_of_join()
        assert "Statistics" not in facts("fact_sales") and not counted
        refresh(warehouse, path, category="Furniture")
        assert facts("fact_sales")["Statistics"].endswith(", 200 rows")
        assert facts("order_lines")["Statistics"].endswith(", 200 rows")
        assert facts("dim_date", "date_id")["distinct_count"] == "28"
        spark.conf.set("spark.sql.cbo.enabled", "true")
        by_counts, counted = size_of_join()
        # 28 shipments by their real number of rows, not by a product of three file sizes
        assert counted and by_counts < 5000 < by_files
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
        warehouse.drop_layers()


def test_strict_lines_are_shuffled_by_ids_and_meet_large_dimensions_as_sums(spark):
    from compare import spark_bag

    from martloom.plans.fact import fact_parents, fact_sales, summed_by_ids, summed_lines

    strict = core_layer(spark, FOLDER, "shared_all", strict=True)
    tables, found = strict.tables(), {}

    def first_sum(text):
        rows = text.split("\n")
        depth = [len(row) - len(row.lstrip(" :+-")) for row in rows]
        at = next(i for i, row in enumerate(rows) if "functions=[partial_sum" in row)
        end = next((i for i in range(at + 1, len(rows)) if depth[i] <= depth[at]), len(rows))
        keys = re.findall(r"([a-z_]+)#\d+", rows[at].split("functions=")[0])
        return set(keys), "\n".join(rows[:at] + rows[end:]), "\n".join(rows[at + 1 : end])

    texts = summed_lines(strict.lines, strict.config)
    for parent, key in fact_parents(tables, strict.config).values():
        texts = texts.join(parent, key)
    found["texts"] = spark_bag(texts.select("order_id", "customer_id", "product_id", "price", "quantity", "sum_of_sale"))
    try:
        # all dimensions are small; some are; none is
        for most, early in ((10 << 20, 15), (3000, None), (-1, 0)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(most))
            text = plan(summed_by_ids(strict.lines, tables))
            keys, above, below = first_sum(text)
            joins = below.count("BroadcastHashJoin")
            assert "SortMergeJoin" not in below and "hashpartitioning" not in below
            assert joins + above.count("BroadcastHashJoin") + above.count("SortMergeJoin") == 15
            if early is None:
                assert 0 < joins < 15
            else:
                assert joins == early
            if joins == 15:
                ids = "shipment_id postal_code_id product_id price customer_id order_id"
                assert keys == set(ids.split())
            sums = summed_by_ids(strict.lines, tables)
            found[most] = spark_bag(sums.select("order_id", "customer_id", "product_id", "price", "quantity", "sum_of_sale"))
        assert all(bag == found["texts"] for bag in found.values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fact_sales(strict.lines, tables, strict.config).count() == summed_by_ids(strict.lines, tables).count()
