"""Written intermediate tables in the folder that all executors share.

A written table cuts lineage: its keys stay what they were when it is read again, a lost
executor costs a re-read instead of a rebuild, and its file sizes let Spark decide which
side of a join is small enough to broadcast.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.sources.buckets import Buckets, write_bucketed

# How written tables are compressed: a quarter smaller than by Spark's default, for little more time.
COMPRESSION = "zstd"

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only a local session without the setting
    gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="martloom-")
    return _local_folders[application]


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a location."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_marker(spark: SparkSession, path: str) -> None:
    """Create a file of one line. (Spark passes over empty files.)"""
    system, where = hadoop_path(spark, path)
    stream = system.create(where, True)
    stream.writeBytes("complete\n")
    stream.close()


def delete_files(spark: SparkSession, pattern: str) -> None:
    """Delete the files whose path matches."""
    system, where = hadoop_path(spark, pattern)
    for status in system.globStatus(where) or []:
        system.delete(status.getPath(), False)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within the block, shuffle files go when the query that wrote them ends. Otherwise they stay on
    the executors' disks until the driver happens to collect its garbage. A table that is not written
    must be used once only. Not for threads that run side by side: the setting is the session's."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


class Staging:
    """A new folder per run, deleted when the application ends, or with the block if it is
    used as a context: then the tables saved in it must not be read any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        run = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        self.root = f"{shared_folder(spark)}/martloom/{run}"
        system, where = hadoop_path(spark, self.root)
        system.mkdirs(where)
        system.deleteOnExit(where)
        self._entries: list[str] = []
        atexit.register(self._forget_entries)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self._forget_entries()
        atexit.unregister(self._forget_entries)
        system, where = hadoop_path(self.spark, self.root)
        system.delete(where, True)

    def save(
        self, name: str, df: DataFrame, by: str | None = None, buckets: Buckets | None = None
    ) -> DataFrame:
        """Write to a folder of its own and return the written table.

        With `by`, one folder for each value of that column: readers of some values read their
        folders only. Rows are dealt out by it once more, in parts of a size that Spark chooses, so
        a value is a few files and a value that holds much of the table is many. With
        `buckets`, the table has a catalog entry until the block ends, or the application.
        """
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        if buckets:
            entry = f"martloom_{name}_{uuid.uuid4().hex}"
            self._entries.append(entry)
            return write_bucketed(df, entry, path, buckets, COMPRESSION)
        if by:
            df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(path, compression=COMPRESSION)
        else:
            df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def _forget_entries(self) -> None:
        if not self.spark.sparkContext._jsc:  # the application has ended
            return
        while self._entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._entries.pop()}")
