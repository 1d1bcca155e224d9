"""Documents whose sets of shingles have a Jaccard similarity of 0.8 or more.

Candidates share one of 20 bands of five minima of hashed shingles: two sets of similarity s do
so with probability 1 - (1 - s^5)^20, which is 0.9996 at 0.8. Their similarity is then worked out
from whole sets. Sets are distinct before they are compared, and pairs that are linked already
are left out.

A band with more than PAIRED different sets is not expanded into pairs: its sets are compared
with two hubs, other ones in each band, and in lots of about LOT. Work is then linear in the sets
of a band; a pair that meets in crowded bands only is found if a hub or a lot links it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martloom.sources.staging import Staging

# Fixed value: the least similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 20, 5
# Bands with more sets than this are compared with hubs and in lots.
PAIRED, LOT = 32, 8
# Shingles whose minima are taken at a time.
BLOCK = 1 << 12
# Most numbers in a broadcast set that thins out rows before a join.
BUCKETS = 1 << 20

# Odd factors, one for each minimum, and those that mix minima to one key.
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(43).integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def summary(shingles: np.ndarray) -> tuple[int, int, list[int]]:
    """(key of the set, its size, keys of its bands) of sorted distinct hashes; an empty set has
    no bands."""
    from xxhash import xxh64_intdigest

    key = int(np.uint64(xxh64_intdigest(shingles.tobytes())).astype(np.int64))
    if not len(shingles):
        return key, 0, []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), BLOCK):
        part = shingles[start : start + BLOCK, None] * _FACTORS
        # products keep the low bits of a hash low: fold the high ones in
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
    mixed = (least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[0] + np.arange(BANDS, dtype=np.uint64)
    return key, len(shingles), mixed.view(np.int64).tolist()


def _alike(size: Column, other: Column) -> Column:
    """Sizes that the least similarity allows."""
    few, many = F.least(size, other), F.greatest(size, other)
    return few.cast("long") * LEAST[1] >= many.cast("long") * LEAST[0]


def candidates(store: Staging, rows: DataFrame, rooted: DataFrame) -> DataFrame:
    """(u_text, u_root, v_text, v_root, same) of pairs to compare, each once. `rows` holds (fp,
    text_key, set_key, n_shingles, bands), `rooted` the root of every fp; `same` tells pairs of
    equal sets, which need no comparison."""
    named = rows.filter(F.col("n_shingles") > 0)
    item = F.struct("text_key", "fp", "n_shingles", "bands")
    sets = named.groupBy("set_key").agg(F.min(item).alias("s"), F.min("fp").alias("low"), F.max("fp").alias("high"))
    sets = store.save("sets", sets.join(rooted, F.col("s.fp") == rooted["fp"]).select("set_key", "s", "low", "high", "root"))
    # equal sets whose fingerprints differ, as shingles are repeated
    uneven = sets.filter(F.col("low") != F.col("high")).select("set_key", "root")
    equal = (
        named.select("set_key", "fp").distinct().join(uneven, "set_key")
        .join(rooted.withColumnRenamed("root", "v_root"), "fp")
        .filter(F.col("root") != F.col("v_root"))
        .select(F.lit(0).cast("long").alias("u_text"), F.col("root").alias("u_root"), F.lit(0).cast("long").alias("v_text"), "v_root", F.lit(True).alias("same"))
    )
    keyed = sets.select(
        F.explode("s.bands").alias("band"), F.col("s.text_key").alias("text"), "root", F.col("s.n_shingles").alias("n")
    )
    member = F.struct(F.xxhash64("band", "text").alias("order"), "text", "root", "n")
    groups = keyed.groupBy("band").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.min(member).alias("first"), F.max(member).alias("last"),
    )
    groups = store.save("bands", groups.filter(F.col("low") != F.col("high")).drop("low", "high"))
    bucket = F.pmod(F.xxhash64("band"), F.lit(BUCKETS))
    wanted = groups.select(bucket.alias("bucket")).distinct()
    hopeful = keyed.withColumn("bucket", bucket).join(F.broadcast(wanted), "bucket", "left_semi")
    members = store.save("band_members", hopeful.drop("bucket").join(groups, "band"))
    lots = F.when(F.col("size") > PAIRED, F.ceil(F.col("size") / LOT)).otherwise(F.lit(1))
    dealt = members.withColumn("lot", F.pmod(F.xxhash64("text", "band"), lots))
    mine = dealt.select("band", "lot", F.struct("text", "root", "n").alias("u"))
    pairs = mine.join(mine.withColumnRenamed("u", "v"), ["band", "lot"]).select("u", "v")
    for hub in ("first", "last"):
        of_hub = F.struct(f"{hub}.text", f"{hub}.root", f"{hub}.n")
        crowd = members.filter(F.col("size") > PAIRED)
        pairs = pairs.unionAll(crowd.select(F.least(of_hub, F.struct("text", "root", "n")).alias("u"), F.greatest(of_hub, F.struct("text", "root", "n")).alias("v")))
    different = (F.col("u.text") < F.col("v.text")) & (F.col("u.root") != F.col("v.root"))
    pairs = pairs.filter(different & _alike(F.col("u.n"), F.col("v.n"))).select(
        F.col("u.text").alias("u_text"), F.col("u.root").alias("u_root"),
        F.col("v.text").alias("v_text"), F.col("v.root").alias("v_root"), F.lit(False).alias("same"),
    )
    return store.save("candidates", pairs.distinct().unionAll(equal))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            found.append(LEAST[1] * both >= LEAST[0] * (len(x) + len(y) - both))
        kept = batch.select(["u", "v"]).filter(pa.array(found, pa.bool_()))
        yield kept


def links(
    store: Staging, pairs: DataFrame, texts: DataFrame, shingle_sets: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Edges (u, v) between roots of the pairs whose similarity is large enough."""
    asked = pairs.filter(~F.col("same"))
    keys = asked.select(F.explode(F.array("u_text", "v_text")).alias("text_key")).distinct()
    keys = store.save("compared", keys)
    bucket = F.pmod(F.col("text_key"), F.lit(BUCKETS)).alias("bucket")
    hopeful = texts.withColumn("bucket", bucket).join(
        F.broadcast(keys.select(bucket).distinct()), "bucket", "left_semi"
    )
    sets = shingle_sets(hopeful.drop("bucket")).groupBy("text_key").agg(F.min("shingles").alias("shingles"))
    sets = store.save("shingles", sets)
    compared = (
        asked.join(sets.select(F.col("text_key").alias("u_text"), F.col("shingles").alias("a")), "u_text")
        .join(sets.select(F.col("text_key").alias("v_text"), F.col("shingles").alias("b")), "v_text")
        .select(F.col("u_root").alias("u"), F.col("v_root").alias("v"), "a", "b")
        .mapInArrow(_similar, "u bigint, v bigint")
    )
    equal = pairs.filter("same").select(F.col("u_root").alias("u"), F.col("v_root").alias("v"))
    return store.save("similar", compared.unionAll(equal))
