"""Sizes of equality joins and their sides, worked out before they run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def key_counts(df: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Rows per key. A key that holds much of the table is a few rows before the first shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def join_size(child: DataFrame, parent: DataFrame, keys: list[str], *labels: Column) -> DataFrame:
    """One row on the inner join of `child` and `parent`, from how often each key is on either side:

    child_rows     rows of the child
    joined_rows    rows that the join gives
    unmatched_rows child rows without a parent, which the join loses
    repeated_keys  keys of the child that have several parents
    most_parents   parents of the key that has most of them

    Only distinct keys meet, so no row is repeated to find this out. A key with a NULL has no
    parent, as in a join. Both sides may be empty.
    """
    parents = key_counts(parent, keys, "parents")
    met = key_counts(child, keys, "children").join(parents, keys, "left")
    found = F.coalesce("parents", F.lit(0))
    zero = F.lit(0).cast("long")
    return met.agg(
        *labels,
        F.coalesce(F.sum("children"), zero).alias("child_rows"),
        F.coalesce(F.sum(F.col("children") * found), zero).alias("joined_rows"),
        F.coalesce(F.sum(F.when(found == 0, F.col("children"))), zero).alias("unmatched_rows"),
        F.count_if(found > 1).alias("repeated_keys"),
        F.coalesce(F.max(found), zero).alias("most_parents"),
    )


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark broadcasts a join side by its size: at most
    spark.sql.autoBroadcastJoinThreshold bytes by files or statistics."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most
