"""Tables written in buckets of a key, so that joins on that key need no exchange.

Spark reads buckets through the catalog alone, so such a table has a catalog entry from the moment it
is written. The entry owns no files: dropping it leaves them where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Buckets:
    """`count` buckets by the hash of `key`, each sorted by it."""

    key: str
    count: int

    def clause(self) -> str:
        return f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.count} BUCKETS"


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: Buckets, compression: str
) -> DataFrame:
    """Write `df` to `path` in buckets, under the catalog name `name`, and return it as read back.

    Rows go to the task of their bucket first, so a bucket is one file and not one of each task.
    Keys are distinct or spread (orders of a fact): a hot key's rows have been summed before.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets.count, buckets.key)
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(buckets.count, buckets.key)
        .sortBy(buckets.key)
        .option("path", path)
        .option("compression", compression)
        .saveAsTable(name)
    )
    return spark.table(name)
