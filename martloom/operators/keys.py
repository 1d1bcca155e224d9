"""Surrogate keys: 1..n over distinct rows, the same in every run over the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def ordered_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Number rows in order. One task sorts all rows, so only for a bounded table such
    as the calendar (all dates from year 1 to 9999 are 3.7 million rows)."""
    number = F.row_number().over(Window.orderBy(*order))
    return df.select(number.cast("bigint").alias(key), *df.columns)


def surrogate_key(df: DataFrame, key: str, natural: list[str], buckets: int) -> DataFrame:
    """Number rows of any count without a task that sees them all.

    Rows are hashed to buckets by their natural key, which is distinct, so buckets are
    even. Each bucket is numbered on its own and shifted by the rows of the buckets
    before it. Only the bucket sizes, at most `buckets` rows, meet in one task.
    """
    bucket = F.pmod(F.xxhash64(*natural), F.lit(buckets)).cast("int")
    rows = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural))
    return (
        rows.withColumn("_place", within)
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_place")).alias(key), *df.columns)
    )
