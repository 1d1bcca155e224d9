"""Constraints as data checks: each returns the rows that break the rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from martloom.schemas import FOREIGN_KEYS, PRIMARY_KEYS


class ConstraintError(ValueError):
    """A table breaks a declared constraint."""


def primary_key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that are repeated or hold a NULL, with their number of rows."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter((F.col("row_count") > 1) | missing)
    )


def foreign_key_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Distinct non-NULL child values without a parent row.

    Values are made distinct first, so a value that fills a third of the child reaches
    the join as one row.
    """
    values = child.select(column).filter(F.col(column).isNotNull()).distinct()
    known = parent.select(F.col(parent_column or column).alias(column))
    return values.join(known, column, "left_anti")


def require_primary_key(df: DataFrame, table: str) -> None:
    bad = primary_key_violations(df, list(PRIMARY_KEYS[table])).limit(1).collect()
    if bad:
        raise ConstraintError(f"{table}: primary key is repeated or NULL: {bad[0].asDict()}")


def require_foreign_keys(tables: dict[str, DataFrame]) -> None:
    """Check every declared edge whose two tables are given."""
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            bad = foreign_key_violations(tables[child], column, tables[parent]).limit(1).collect()
            if bad:
                raise ConstraintError(f"{child}.{column} has no row in {parent}: {bad[0].asDict()}")


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared key of the given tables with its number of violations."""
    parts = []
    for table, key in PRIMARY_KEYS.items():
        if table in tables:
            parts.append(
                primary_key_violations(tables[table], list(key)).agg(
                    F.lit(f"{table} primary key").alias("constraint_name"),
                    F.count(F.lit(1)).alias("violations"),
                )
            )
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            parts.append(
                foreign_key_violations(tables[child], column, tables[parent]).agg(
                    F.lit(f"{child}.{column} in {parent}").alias("constraint_name"),
                    F.count(F.lit(1)).alias("violations"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def sales_reconciliation(core_raw: DataFrame, fact: DataFrame) -> DataFrame:
    """Totals of the lines and of the fact in one row. They agree under strict keys when
    no line has a NULL key; otherwise the difference is what fan-out added."""
    lines = core_raw.agg(
        F.sum("sales").cast("decimal(38,2)").alias("line_sales"),
        F.sum("quantity").alias("line_quantity"),
    )
    facts = fact.agg(
        F.sum("sum_of_sale").cast("decimal(38,2)").alias("fact_sales"),
        F.sum("quantity").alias("fact_quantity"),
    )
    # one row on each side
    return lines.withColumn("_one", F.lit(1)).join(
        facts.withColumn("_one", F.lit(1)), "_one"
    ).drop("_one")
