"""Merkle fixity audit of WARC replicas.

A replica is a table of records (file, offset, digest). Records whose offsets lie in one range
of LEAF_BYTES bytes of a file are a leaf; eight neighbouring ranges are a node, and so on up to
one node for the whole file; eight neighbouring files are a node again, up to one root for the
archive. Every node's hash is that of its children in order. Two replicas with equal roots are
equal; otherwise only children of nodes that differ are compared, level by level, and records are
compared only in the leaves that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.common import staging
from martloom.sources.staging import Staging

FILE_BYTES = 1 << 22
LEAF_BYTES = 1 << 16
FANOUT = 8
# Copies of one record that a task deals out.
LOT = 1000


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a response record as text; nulls are empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def archive(
    pages: DataFrame, more: Sequence[Column] = (), file_bytes: int = FILE_BYTES
) -> DataFrame:
    """(file, offset, length, digest, page_id) of all pages as records of WARC files, and `more`
    columns made of page_id, url and html.

    Records stand in order of id, those without an id last, and of digest; files are cut where the
    next `file_bytes` bytes begin, so a record belongs to the file in which it starts, and a longer
    record leaves numbers of files out. Repeated rows are records of their own, with equal `more`
    (the least, if a null and an empty text differ in it). No pages are no files. Bodies are
    hashed where they are read and never shuffled.

    An id, or a record, may be repeated in much of the table: equal records are counted before
    they are ordered and dealt out again in lots, and the order is one of ranges of (id,
    digest), whose sizes, one row for each, are summed up first.
    """
    store = staging(pages.sparkSession)
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    measured = pages.select(
        "page_id", F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"), F.struct(F.lit(0), *more).alias("more"),
    )
    counted = measured.groupBy("page_id", "length", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("more").alias("more")
    )
    order = [F.col("page_id").asc_nulls_last(), F.col("digest")]
    # written, so that the ranges stay what they are
    parts = store.save(
        "parts", counted.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    size = F.col("length") * F.col("copies")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("part").agg(F.sum(size).alias("size"))
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = parts.withColumn("start", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    placed = within.join(F.broadcast(sizes), "part").withColumn("start", F.col("start") + F.col("before"))
    placed = store.save("placed", placed.drop("part", "before"))

    def dealt(rows: DataFrame, first: Column, copies: Column) -> DataFrame:
        number = F.explode(F.sequence(first, first + copies - 1))
        each = rows.select("page_id", "length", "digest", "more", "start", number.alias("number"))
        return each.withColumn("start", F.col("start") + F.col("number") * F.col("length")).drop("number")

    few = placed.filter(F.col("copies") <= LOT)
    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(LOT).cast("long")))
    many = placed.filter(F.col("copies") > LOT).select("*", lots.alias("lot")).repartition("digest", "lot")
    rows = dealt(few, F.lit(0).cast("long"), F.col("copies")).unionByName(
        dealt(many, F.col("lot"), F.least(F.lit(LOT), F.col("copies") - F.col("lot")))
    )
    rows = rows.withColumn("file", F.floor(F.col("start") / file_bytes).cast("long"))
    offset = F.col("start") - F.min("start").over(Window.partitionBy("file"))
    names = rows.schema["more"].dataType.names[1:]
    return rows.select(
        "file", offset.alias("offset"), "length", "digest", "page_id",
        *[F.col("more")[name].alias(name) for name in names],
    )


def _parents(nodes: DataFrame, by: list[str], place: str) -> DataFrame:
    """Nodes one level up: the children's places and hashes, in order, are hashed."""
    children = F.array_sort(F.collect_list(F.struct(place, "hash")))
    text = F.transform(children, lambda c: F.concat_ws(":", c[place].cast("string"), c["hash"]))
    up = nodes.withColumn("up", F.floor(F.col(place) / FANOUT).cast("long"))
    return up.groupBy(*by, "up").agg(F.sha2(F.array_join(text, ","), 256).alias("hash")).select(
        *by, F.col("up").alias(place), "hash"
    )


class Tree:
    """The levels of a replica's hash tree, leaves first; each is a written table (file, range,
    hash). Above the whole files, `file` counts groups of files and range is 0."""

    def __init__(self, store: Staging, records: DataFrame, file_levels: int, archive_levels: int) -> None:
        one = F.array_sort(F.collect_list(F.struct("offset", "digest")))
        text = F.transform(one, lambda r: F.concat_ws(":", r["offset"].cast("string"), r["digest"]))
        leaf = F.floor(F.col("offset") / LEAF_BYTES).cast("long")
        leaves = records.groupBy("file", leaf.alias("range")).agg(
            F.sha2(F.array_join(text, ","), 256).alias("hash")
        )
        self.levels = [store.save("leaves", leaves)]
        for _ in range(file_levels):
            self.levels.append(store.save("node", _parents(self.levels[-1], ["file"], "range")))
        for _ in range(archive_levels):
            self.levels.append(store.save("node", _parents(self.levels[-1], ["range"], "file")))


def _levels(least: int, greatest: int) -> int:
    """Levels until all places from `least` to `greatest` fall into places -1 and 0."""
    count = 0
    while greatest > 0 or least < -1:
        least, greatest, count = least // FANOUT, greatest // FANOUT, count + 1
    return count


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, offset, kind, digest, replica_digest) of every place where the replicas differ:
    kind is changed, missing (not in the replica) or extra (only there).

    Both hold file, offset and digest. Equal places that are repeated count as one record with
    the digests in order. No rows on either side are an empty archive.
    """
    store = staging(original.sparkSession)

    def unique(records: DataFrame) -> DataFrame:
        digests = F.array_join(F.array_sort(F.collect_list("digest")), "+")
        return store.save("records", records.groupBy("file", "offset").agg(digests.alias("digest")))

    left, right = unique(original), unique(replica)
    bounds = (
        left.unionByName(right)
        .agg(F.min("file").alias("low"), F.max("file").alias("high"), F.max("offset").alias("end"))
        .first()
    )
    ranges = (bounds["end"] or 0) // LEAF_BYTES
    counts = _levels(0, ranges), _levels(bounds["low"] or 0, bounds["high"] or 0)
    trees = [Tree(store, side, *counts) for side in (left, right)]
    differ: DataFrame | None = None
    for level in range(sum(counts), -1, -1):
        nodes = [tree.levels[level] for tree in trees]
        if differ is not None:
            above = level >= counts[0]  # children are files here, ranges of one file below
            place = "file" if above else "range"
            other = "range" if above else "file"
            parents = differ.select(F.col(place).alias("_up"), F.col(other).alias("_other"))
            nodes = [
                n.join(
                    parents,
                    (F.floor(n[place] / FANOUT) == F.col("_up")) & (n[other] == F.col("_other")),
                    "left_semi",
                )
                for n in nodes
            ]
        a, b = nodes[0].alias("a"), nodes[1].withColumnRenamed("hash", "other").alias("b")
        met = a.join(b, ["file", "range"], "full")
        differ = store.save(
            "differ", met.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "range")
        )

    def inside(records: DataFrame) -> DataFrame:
        leaf = F.floor(F.col("offset") / LEAF_BYTES).cast("long")
        return records.withColumn("range", leaf).join(differ, ["file", "range"], "left_semi")

    both = (
        inside(left)
        .select("file", "offset", "digest")
        .join(inside(right).select("file", "offset", F.col("digest").alias("replica_digest")), ["file", "offset"], "full")
        .filter(~F.col("digest").eqNullSafe(F.col("replica_digest")))
    )
    kind = (
        F.when(F.col("replica_digest").isNull(), "missing")
        .when(F.col("digest").isNull(), "extra")
        .otherwise("changed")
    )
    return both.select("file", "offset", kind.alias("kind"), "digest", "replica_digest")
