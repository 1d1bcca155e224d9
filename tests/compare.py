"""Compare a Spark result with an SQL result: same columns, same rows in any order."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal


def _cell(value: object) -> object:
    return format(value, "f") if isinstance(value, Decimal) else value


def as_bag(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_bag(df) -> tuple[list[str], Counter]:
    return as_bag(df.columns, [tuple(row) for row in df.collect()])


def sql_bag(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    return as_bag([d[0] for d in cursor.description], cursor.fetchall())
