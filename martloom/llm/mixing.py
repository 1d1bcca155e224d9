"""A mix of sources with given weights, drawn by hash thresholds.

Every document has a key: 128 bits, the first 60 a hash of its id and text, the others of its
row. A source takes each of its documents a whole number of times, and once more if the key is
below the source's threshold. The threshold is found without sorting documents: sizes are added
up by source and the leading bits of the key, the running sum of these few numbers meets the
budget in one bucket, and only documents of that bucket are split by the next bits. Thresholds of
larger budgets are larger, so a mix holds every smaller one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.common import ASCII_SPACE, staging
from martloom.sources.staging import Staging

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
# Most times that a document may be taken.
REPEATS = 3
# Bits of a key that one round of histograms looks at, and bits of each half of a key.
BITS = 10
HALF = 60


def content_key(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 of id and text, as a number; nulls have marks of their own."""
    marked = F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("?")),
        F.when(text.isNull(), F.lit("?")).otherwise(F.lit(":")),
        F.coalesce(text, F.lit("")),
    )
    return F.conv(F.substring(F.md5(marked.cast("binary")), 1, 15), 16, 10).cast("long")


def measured(store: Staging, documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, row_key) of every document, written."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{ASCII_SPACE}]+"))
    rows = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        size.cast("long").alias("size"),
        content_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    # equal rows have equal keys: what tells them apart is the row, spread over 60 bits
    spread = F.shiftrightunsigned(F.xxhash64("row"), 64 - HALF)
    return store.save("measured", rows.select("doc_id", "source", "size", "key", spread.alias("row_key")))


def ranked(store: Staging, sources: DataFrame) -> DataFrame:
    """`sources` with their place from 0 in code-point order, null last. No task sees them all."""
    parts = (
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .select("*", F.monotonically_increasing_id().alias("at"))
    )
    parts = store.save("ordered", parts)
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task of the step above
    offsets = (
        parts.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
        .select("part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    placed = parts.withColumn("part", part).join(offsets, "part")
    return placed.select(*sources.columns, (F.col("offset") + F.col("at") - F.col("first")).alias("place"))


def targets(
    store: Staging, sizes: DataFrame, weights: Sequence[float], repeats: int, share: float
) -> DataFrame:
    """(source, source_size, target) of sources (source, source_size).

    `share` of all words is dealt out by weight. A target above `repeats` times its source's size
    stops there, and what is left over is dealt out again by weight until none is above: targets
    are level * weight with one level for all sources that are not full. Every round raises the
    level; it comes to the driver as three sums.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = store.save("sources", ranked(store, sizes).withColumn("weight", weight))
    most = F.col("source_size") * repeats
    level: float | None = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level >= most
        sums = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, most)).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not sums["all"] or not sums["open"]:
            break
        new = (sums["all"] * share - (sums["full"] or 0)) / sums["open"]
        if level is not None and new <= level:
            break
        level = new
    target = F.least(F.col("weight") * (level or 0.0), most.cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def _bits(round_no: int) -> Column:
    """The bits of the key that a round looks at: first those of the content, then of the row."""
    rounds = HALF // BITS
    name = "key" if round_no < rounds else "row_key"
    shift = HALF - BITS * (round_no % rounds + 1)
    return F.shiftright(name, shift).bitwiseAND((1 << BITS) - 1)


def thresholds(store: Staging, docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, key, row_key): documents of a source with a smaller key pair fit its budget, and
    so does the one of the pair itself if `with_last`.

    `budgets` is (source, budget), in words beyond the whole repeats. Round by round, sizes by
    source and bucket give the bucket in which the budget ends; it alone is looked at again, until
    it holds one document. The last document is taken if that comes nearer to the budget.
    """
    # open: sources whose bucket still has several documents; left: budget before that bucket
    bound = store.save(
        "bound",
        budgets.filter(F.col("budget") > 0).select(
            "source", F.col("budget").alias("left"), F.lit(0).cast("long").alias("key_bits"),
            F.lit(0).cast("long").alias("row_bits"),
        ),
    )
    found: list[DataFrame] = []
    inside = docs
    for round_no in range(2 * HALF // BITS):
        if bound.isEmpty():
            break
        if round_no:
            last = _bits(round_no - 1) == bound["bucket"]
            same = inside["source"].eqNullSafe(bound["source"]) & last
            inside = inside.join(bound, same).select(*[inside[c] for c in docs.columns])
            inside = store.save("inside", inside)
        sums = (
            inside.groupBy("source", _bits(round_no).alias("bucket"))
            .agg(
                F.sum("size").alias("words"),
                F.count(F.lit(1)).alias("rows"),
                F.max("size").alias("largest"),
            )
            .select("source", "bucket", "words", "rows", "largest")
        )
        # at most 2^BITS rows of one source
        until = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = store.save("sums", sums.withColumn("until", F.sum("words").over(until)))
        limits = bound.select(F.col("source").alias("_source"), "left", "key_bits", "row_bits")
        met = sums.join(limits, F.col("source").eqNullSafe(F.col("_source"))).filter(
            (F.col("until") > F.col("left")) & (F.col("until") - F.col("words") <= F.col("left"))
        )
        deeper = "key_bits" if round_no < HALF // BITS else "row_bits"
        met = store.save(
            "met",
            met.select(
                "source", "bucket", "rows", "words",
                (F.col("left") - (F.col("until") - F.col("words"))).alias("left"),
                *[
                    (F.col(c) * (1 << BITS) + F.col("bucket") if c == deeper else F.col(c)).alias(c)
                    for c in ("key_bits", "row_bits")
                ],
            ),
        )
        ends = round_no == 2 * HALF // BITS - 1
        done = met if ends else met.filter("rows = 1")
        width = BITS * (round_no % (HALF // BITS) + 1)
        found.append(
            done.select(
                "source", "key_bits", "row_bits",
                F.lit(width if deeper == "key_bits" else HALF).alias("key_width"),
                F.lit(0 if deeper == "key_bits" else width).alias("row_width"),
                (F.col("left") * 2 >= F.col("words")).alias("with_last"),
            )
        )
        bound = met.filter("rows > 1")
    empty = budgets.limit(0).select(
        "source", F.lit(0).cast("long").alias("key_bits"), F.lit(0).cast("long").alias("row_bits"),
        F.lit(0).alias("key_width"), F.lit(0).alias("row_width"), F.lit(False).alias("with_last"),
    )
    return store.save("thresholds", reduce(DataFrame.unionByName, found, empty))


def mixed(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = REPEATS,
    share: float = 1.0,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of `documents`.

    Sizes count words `[^\\x20\\x09-\\x0D]+`; null text has none. Sources stand in code-point order,
    null last, and weigh `weights` in turn. `taken` is the size times the number of repeats: whole
    repeats that fit the target, and one more for documents whose key is below the threshold. The
    words taken miss the target by half of one document at most. A document without words, and a
    source without any, take 0. Which of several equal rows takes one more is left open, how many
    is not; all else depends on ids and texts alone. An empty table gives no rows.

    Joins by source are left to Spark: the written tables of sources are small and broadcast by
    their size, and where they are not, adaptive execution splits hot sources.
    """
    store = staging(documents.sparkSession)
    docs = measured(store, documents)
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = store.save("targets", targets(store, store.save("sizes", sizes), weights, repeats, share))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("long"))
    budgets = plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    ends = thresholds(store, docs.filter("size > 0").select("source", "size", "key", "row_key"), budgets)
    ends = ends.withColumnRenamed("source", "_source")
    limit = plan.join(ends, plan["source"].eqNullSafe(ends["_source"]), "left").select(
        plan["source"].alias("_source"), "source_size", "target", "whole",
        "key_bits", "row_bits", "key_width", "row_width", "with_last",
    )
    limit = store.save("limit", limit)
    rows = docs.join(limit, docs["source"].eqNullSafe(limit["_source"]))
    key = F.expr(f"shiftright(key, {HALF} - key_width)")
    row = F.expr(f"shiftright(row_key, {HALF} - row_width)")
    at = (key == F.col("key_bits")) & (row == F.col("row_bits"))
    below = (key < F.col("key_bits")) | ((key == F.col("key_bits")) & (row < F.col("row_bits")))
    once_more = F.coalesce(below | (at & F.col("with_last")), F.lit(False)).cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * (F.col("whole") + once_more)).alias("taken"),
    )
