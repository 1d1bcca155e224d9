"""Order lines out of a star schema of orders, line items, customers and parts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.schemas import DATE_COLUMNS, ORDER_LINE_COLUMNS
from martloom.sources.staging import shuffles_freed

# How each order-line column is made. The text is valid in Spark SQL and in other ANSI
# engines, so an independent check can start from the same lines. `copy_no` is 0, or
# 0 and 1 where every line is repeated.
PLAIN = {
    "order_id": "'O-' || CAST(o_orderkey AS STRING)",
    "order_date": "CAST(o_orderdate AS DATE)",
    "ship_date": "CAST(l_shipdate AS DATE)",
    "ship_mode": "o_orderpriority",
    "customer_id": "'C-' || CAST(c_custkey AS STRING)",
    "customer_name": "c_name",
    "segment": "c_mktsegment",
    "country": "r_name",
    "city": "'City ' || CAST(c_custkey % 7 AS STRING)",
    "state": "n_name || '-S' || CAST(c_custkey % 3 AS STRING)",
    "postal_code": "CAST(c_nationkey * 100 + (c_custkey % 3) * 10 + c_custkey % 7 AS INT)",
    "region": "n_name",
    "product_id": "'P-' || CAST(p_partkey AS STRING)",
    "category": "p_type",
    "sub_category": "p_type || ' ' || p_brand",
    "product_name": "p_name",
    "sales": (
        "CAST((CAST(l_quantity AS INT) + copy_no) * CAST(p_retailprice AS DECIMAL(8,2))"
        " * (1.00 - CAST(l_discount AS DECIMAL(2,2))) AS DECIMAL(10,2))"
    ),
    "quantity": "CAST(l_quantity AS INT) + copy_no",
    "discount": "CAST(l_discount AS DECIMAL(2,2))",
    "profit": (
        "CAST((CAST(l_quantity AS INT) + copy_no) * CAST(p_retailprice AS DECIMAL(8,2))"
        " * (0.05 - CAST(l_tax AS DECIMAL(2,2))) AS DECIMAL(10,4))"
    ),
}

# Two cities of a state share a postal code.
_SHARED_CODE = {
    "postal_code": (
        "CAST(c_nationkey * 100 + (c_custkey % 3) * 10 + least(c_custkey % 7, 5) AS INT)"
    ),
}

# Every incomplete natural key stands for more than one parent somewhere.
_SHARED_ALL = {
    **_SHARED_CODE,
    "order_id": (
        "'O-' || CAST(o_orderkey - CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS STRING)"
    ),
    "customer_id": (
        "'C-' || CAST(c_custkey - CASE WHEN c_custkey % 20 = 1 THEN 1 ELSE 0 END AS STRING)"
    ),
    "region": "'Region ' || CAST(c_nationkey % 23 AS STRING)",
    "state": (
        "CASE WHEN c_custkey % 3 = 2 THEN 'State ' || CAST(c_nationkey % 12 AS STRING)"
        " ELSE n_name || '-S' || CAST(c_custkey % 3 AS STRING) END"
    ),
    "product_id": (
        "'P-' || CAST(p_partkey - CASE WHEN p_partkey % 50 = 1 THEN 1 ELSE 0 END AS STRING)"
    ),
    "product_name": "CASE WHEN p_partkey % 50 <= 1 THEN 'assorted' ELSE p_name END",
    "sub_category": "CASE WHEN p_brand = 'Brand#1' THEN 'Mixed' ELSE p_type || ' ' || p_brand END",
}

# variant: (overridden columns, copies of each line)
VARIANTS: dict[str, tuple[dict[str, str], int]] = {
    "plain": ({}, 1),
    "shared_code": (_SHARED_CODE, 1),
    "shared_all": (_SHARED_ALL, 1),
    "repeated": ({}, 2),
}

ORDER_LINE_NAMES = tuple(name for _, name, _ in ORDER_LINE_COLUMNS)

# Columns of the tables that order lines are made of, in any variant.
_JOINED = (
    "o_orderkey", "o_orderdate", "o_orderpriority", "c_custkey", "c_name", "c_mktsegment", "c_nationkey",
    "n_name", "r_name", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice",
    "l_quantity", "l_discount", "l_tax", "l_shipdate",
)


def joined_lines(spark: SparkSession, folder: str, whole: bool = False) -> DataFrame:
    """Line items with the columns of their order, customer and part.

    Customers meet orders before line items do, so a filter on a customer column thins
    out both. Orders grow with the data, so the two large tables are merged at any size.
    `whole` says that every line will be used: then line items meet parts first, and are shuffled
    for the second time with the few columns of a part and not with those of an order, which is
    moved once for all of its lines. Lines of an order stand together afterwards, and compress
    better where they are written.
    The line number is taken at the scan: it depends on the files alone.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    places = table("nation").join(table("region"), F.expr("n_regionkey = r_regionkey"))
    buyers = table("customer").join(places, F.expr("c_nationkey = n_nationkey"))
    # days are smaller than moments when they are shuffled
    dated = table("orders").withColumn("o_orderdate", F.expr("CAST(o_orderdate AS DATE)"))
    orders = dated.join(buyers, F.expr("o_custkey = c_custkey"))
    items = table("lineitem").withColumns(
        {"line_no": F.monotonically_increasing_id(), "l_shipdate": F.expr("CAST(l_shipdate AS DATE)")}
    )
    in_order, of_part = F.expr("l_orderkey = o_orderkey"), F.expr("l_partkey = p_partkey")
    if whole:
        wide = items.join(table("part"), of_part).join(orders.hint("merge"), in_order)
    else:
        wide = items.join(orders.hint("merge"), in_order).join(table("part"), of_part)
    return wide.select("line_no", *_JOINED)


def made_lines(joined: DataFrame, variant: str = "plain") -> DataFrame:
    """Order lines out of joined ones, with typed columns and dates."""
    overrides, copies = VARIANTS[variant]
    made = {**PLAIN, **overrides}
    wide = joined
    if copies > 1:
        wide = wide.withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    else:
        wide = wide.withColumn("copy_no", F.lit(0))
    row_id = (F.col("line_no") * copies + F.col("copy_no")).alias("row_id")
    return wide.select(
        row_id, *[F.expr(made[name]).alias(name) for name in ORDER_LINE_NAMES if name != "row_id"]
    )


def order_lines(
    spark: SparkSession, folder: str, variant: str = "plain", whole: bool = False
) -> DataFrame:
    """All order lines with typed columns and dates. `whole`: see `joined_lines`."""
    return made_lines(joined_lines(spark, folder, whole), variant)


def as_text(lines: DataFrame) -> DataFrame:
    """The lines as a file holds them: text in every column, dates as month/day/year."""
    return lines.select(
        *[
            (
                F.date_format(name, "M/d/yyyy") if name in DATE_COLUMNS
                else F.col(name).cast("string")
            ).alias(name)
            for name in ORDER_LINE_NAMES
        ]
    )


# Files of a gzip landing: the reader decompresses them by their name, one task a file, so a file
# ends after so many lines.
LANDED_GZIP = "*.csv.gz"
GZIP_LINES = 500_000


def land_csv(lines: DataFrame, folder: str, compression: str | None = None) -> None:
    """Write the lines as delimited files with the header of the order-line file, compressed
    with `compression` if given (a gzip landing is a fifth of the bytes, every line in it)."""
    text = as_text(lines)
    headed = text.select(
        *[F.col(name).alias(header) for header, name, _ in ORDER_LINE_COLUMNS]
    )
    writer = headed.write.option("header", True).option("quote", '"').option("escape", '"')
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", GZIP_LINES)
    with shuffles_freed(lines.sparkSession):
        writer.csv(folder)


def land_fields(
    fields: DataFrame, folder: str, files: int = 8, compression: str | None = None
) -> None:
    """Write text columns as delimited files just as they are: quotes, where a field has any,
    are the caller's. Each file starts with the header, and is compressed with `compression` if given.

    Lines go to `files` folders by order; each task writes its own file in a folder and
    heads it, so no task gathers a folder's lines from the others."""
    key = F.pmod(F.xxhash64("order_id"), F.lit(files)).cast("int")
    line = F.concat_ws(",", *[F.col(name) for name in ORDER_LINE_NAMES])
    header = ",".join(header for header, _, _ in ORDER_LINE_COLUMNS)
    rows = fields.select(key.alias("file"), F.lit(1).alias("place"), line.alias("line"))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lines of a task, and a header for each folder it writes to."""
        seen: set[int] = set()
        for batch in batches:
            new = sorted(set(pc.unique(batch.column("file")).to_pylist()) - seen)
            if new:
                seen.update(new)
                heads = {"file": new, "place": [0] * len(new), "line": [header] * len(new)}
                yield pa.RecordBatch.from_pydict(heads, batch.schema)
            yield batch

    rows = rows.mapInArrow(headed, "file int, place int, line string")
    rows = rows.sortWithinPartitions("file", "place")
    writer = rows.select("file", "line").write.partitionBy("file")
    if compression:
        writer = writer.option("compression", compression)
    with shuffles_freed(fields.sparkSession):
        writer.text(folder)
