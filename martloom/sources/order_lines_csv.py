"""Delimited order-line files."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.schemas import ORDER_LINE_COLUMNS
from martloom.sources.csv_records import records
from martloom.sources.staging import Staging

_DIALECT = {
    "quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": "false",
    "maxCharsPerColumn": "-1",
}


def _check_headers(headers: list[str]) -> None:
    known = {header for header, _, _ in ORDER_LINE_COLUMNS}
    wrong = [h for h in headers if h not in known or headers.count(h) > 1]
    if wrong:
        raise ValueError(f"the order-line file has an unknown or repeated column: {wrong}")


def read_raw_csv(
    spark: SparkSession, path: str, pattern: str = "*", staging: Staging | None = None
) -> DataFrame:
    """One file or a folder of files as text columns under our names.

    Columns are bound by their header. A field may hold commas, doubled quotes and line breaks,
    which read as \\n however they are written. An empty field is '' and not NULL; an empty line
    is no record. A record with too few or too many fields fails the read, whichever columns are
    used, and so does a blank line, a quoted field that is never closed, or a file of the folder
    whose header differs. Every file is read by as many tasks as it has splits, by the same
    rules at any size; a compressed file has one split. `pattern` narrows the files of a folder
    by name. Pieces of records that cross the splits of a file go to `staging`; the lines are read
    from the files when the table is used.
    """
    header, rest = records(staging or Staging(spark), path, pattern)
    headers = next(csv.reader(io.StringIO(header)))
    _check_headers(headers)
    schema = ", ".join(f"`{name}` STRING" for name in headers)
    # as a generator the parser runs once per record, even for a count of rows
    fields = rest.select(F.inline(F.array(F.from_csv("record", schema, _DIALECT))))
    names = {title: name for title, name, _ in ORDER_LINE_COLUMNS}
    return fields.select(
        *[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(names[h]) for h in headers]
    )
