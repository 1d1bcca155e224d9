"""Bring a DataFrame to a declared table: columns by name, types and lengths enforced."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.schemas import columns_of

_VARCHAR = re.compile(r"VARCHAR\((\d+)\)")


def require_ansi(spark: SparkSession) -> None:
    """Without ANSI a bad value turns into NULL instead of failing the load."""
    if str(spark.conf.get("spark.sql.ansi.enabled")).lower() != "true":
        raise ValueError("spark.sql.ansi.enabled must be true")


def typed(value: Column, kind: str, name: str) -> Column:
    """Cast under ANSI. Text over its length is an error, unless only blanks are lost."""
    varchar = _VARCHAR.fullmatch(kind)
    if varchar is None:
        return value.cast(kind)
    limit = int(varchar.group(1))
    text = value.cast("string")
    return (
        F.when(text.isNull() | (F.char_length(text) <= limit), text)
        .when(F.char_length(F.rtrim(text)) <= limit, F.substring(text, 1, limit))
        .otherwise(F.raise_error(F.lit(f"{name}: text is longer than {limit} characters")))
    )


def conform(df: DataFrame, table: str, key_type: str = "BIGINT") -> DataFrame:
    """Select the table's columns by name; absent ones are NULL, unknown ones an error."""
    declared = columns_of(table, key_type)
    given = set(df.columns)
    unknown = given - {name for name, _ in declared}
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")

    def column(name: str, kind: str) -> Column:
        if name in given:
            return typed(F.col(name), kind, name).alias(name)
        return F.lit(None).cast("string" if kind.startswith("VARCHAR") else kind).alias(name)

    return df.select(*[column(name, kind) for name, kind in declared])
