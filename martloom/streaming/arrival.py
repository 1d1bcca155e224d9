"""Refresh when a file, or a folder of files, lands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the columns of Spark's file listing source.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"

# Spark passes over files much older than the newest one seen; a landing may be of any age. What
# is remembered for it is one path per landing.
_MAX_AGE = "36500d"


def refresh_on_arrival(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    reload: Callable[[str], None],
    marker: str | None = None,
) -> int:
    """Call `reload` with every path that has landed since the last call, one by one, and
    return how many there were.

    A refresh replaces all rows by those of one landing. By default each file in the folder
    is a landing. With `marker`, each sub-folder is one, complete once it holds a file of
    that name, not empty: so a landing can be many files, written by many tasks.

    The stream lists paths and reads no content. Its checkpoint, on a shared folder, keeps
    what was seen; a reload that fails is repeated by the next call. So is a landing whose file
    is empty: that is an error until the file has been filled.
    """
    source = f"{landing}/*/{marker}" if marker else landing
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("maxFilesPerTrigger", 1)
        .option("maxFileAge", _MAX_AGE)
        .load(source)
        .select("path")
    )
    done = 0

    def on_batch(batch: DataFrame, _: int) -> None:
        nonlocal done
        rows = batch.collect()  # one path
        if not rows:
            raise ValueError(f"{source}: a file has landed that holds nothing yet")
        for row in rows:
            reload(row["path"].rsplit("/", 1)[0] if marker else row["path"])
            done += 1

    query = (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
