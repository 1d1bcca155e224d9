"""Near duplicates by SimHash, found with deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that, of two fingerprints within the
distance, one segment differs by one bit at most. Each segment is indexed once for each of its
bits left out, so such a pair shares a key, and an equality join finds it. Fingerprints are
distinct before they are indexed: copies never meet each other.

A key with many different fingerprints (one group of near copies) is not expanded into pairs.
Its fingerprints are linked exactly through the fingerprints around them: two of them within
two bits of each other have a common neighbour one bit away, so those that share a neighbour
are a star. That is linear in the members of the key, and loses no link. For larger distances
the stars are those of neighbours up to half the distance away.

A distance of a few bits stands for a similarity far above 0.8. Where that is too strict, the
documents that `resemblance` finds can be linked, too, if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martloom.llm import resemblance
from martloom.llm.common import as_rows, same_document, staging, text_key
from martloom.llm.components import components
from martloom.sources.staging import Staging

BITS = 64
# Fixed value: the seed of the shingle hash.
SEED = 42
# Keys with more different fingerprints than this are linked by common neighbours.
PAIRED_KEY = 32
# Most numbers in the broadcast set that thins out keys before a join.
BUCKETS = 1 << 20
# Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def shingle_hashes(words: list[bytes], shingle_words: int) -> np.ndarray:
    """Hashes of the shingles of a list of words, repeated ones too."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle_words:
        shingles, count = [b" ".join(words)], 1
    else:
        count = len(words) - shingle_words + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)


def fingerprint_of(hashes: np.ndarray) -> int:
    """SimHash of the hashes of shingles: a bit is 1 if set in over half of them."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), BLOCK):
        part = hashes[start : start + BLOCK].astype("<u8", copy=False)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame, shingle_words: int = 3, resembling: bool = False
) -> DataFrame:
    """(doc_id, text_key, fp) of every row; fp is the fingerprint as a signed long. If asked for,
    also (set_key, n_shingles, bands), what `resemblance` needs.

    A-Z is lower-cased, words are `[^\\x20\\x09-\\x0D]+`. A text of fewer words than a shingle
    is one shingle, a text without words and a null text have fingerprint 0.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sets = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                hashes = shingle_hashes(text.lower().split() if text else [], shingle_words)
                found.append(fingerprint_of(hashes))
                if resembling:
                    sets.append(resemblance.summary(np.unique(hashes)))
            signed = np.array(found, np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(signed, pa.int64())]
            names = ["doc_id", "text_key", "fp"]
            if resembling:
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()))
                columns += [pa.array([s[i] for s in sets], kind) for i, kind in enumerate(kinds)]
                names += ["set_key", "n_shingles", "bands"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = documents.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    more = ", set_key bigint, n_shingles int, bands array<bigint>" if resembling else ""
    return rows.mapInArrow(of_batches, f"doc_id {kind}, text_key bigint, fp bigint{more}")


def shingle_sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    """(text_key, shingles) of (text_key, text): the distinct hashes of shingles, sorted, as bytes."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.unique(shingle_hashes(text.lower().split() if text else [], shingle_words)).tobytes()
                for text in batch.column("text").cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), pa.array(found, pa.binary())], ["text_key", "shingles"]
            )

    return texts.select("text_key", "text").mapInArrow(of_batches, "text_key bigint, shingles binary")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one has one differing bit at most."""
    count = distance // 2 + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _variants(fp: Column, distance: int) -> Column:
    """Keys of a fingerprint: each segment with each of its bits left out."""
    keys = []
    for number, (first, size) in enumerate(_segments(distance)):
        value = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << size) - 1))
        for bit in range(size):
            rest = value.bitwiseAND(F.lit(((1 << size) - 1) ^ (1 << bit)))
            keys.append(F.struct(F.lit(number * BITS + bit).alias("n"), rest.alias("v")))
    return F.array(*keys)


def _neighbours(fp: Column, radius: int) -> Column:
    """The fingerprint and all within `radius` bits of it."""
    masks = [0]
    for r in range(1, radius + 1):
        for bits in combinations(range(BITS), r):
            mask = 0
            for b in bits:
                mask |= 1 << b
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[fp.bitwiseXOR(F.lit(m)) for m in masks])


def links(store: Staging, fps: DataFrame, distance: int) -> DataFrame:
    """Edges (u, v) that join the same fingerprints as all pairs within `distance` bits do.

    `fps` holds distinct fingerprints in a column fp. `distance` is 2 or 3.
    """
    if distance not in (2, 3):
        raise ValueError("distances of 2 and 3 bits are supported")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    # the table is small, its keys are many: spread it before they are made
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = fps.repartition(spread, "fp")
    keyed = fps.select("fp", F.explode(_variants(F.col("fp"), distance)).alias("key")).select(
        "fp", "key.n", "key.v"
    )
    groups = keyed.groupBy("n", "v").agg(
        F.count(F.lit(1)).alias("size"), F.min("fp").alias("u"), F.max("fp").alias("w")
    )
    groups = store.save("keys", groups.filter(F.col("size") > 1))
    bucket = F.pmod(F.xxhash64("n", "v"), F.lit(BUCKETS))
    twos = groups.filter(F.col("size") == 2).select("u", F.col("w").alias("v"))
    more = groups.filter(F.col("size") > 2).select("n", "v", "size")
    # the broadcast set is at most BUCKETS numbers; it only thins out what is shuffled
    wanted = more.select(bucket.alias("bucket")).distinct()
    hopeful = keyed.withColumn("bucket", bucket).join(F.broadcast(wanted), "bucket", "left_semi")
    members = store.save("members", hopeful.drop("bucket").join(more, ["n", "v"]))
    few = members.filter(F.col("size") <= PAIRED_KEY)
    paired = (
        few.join(few.select("n", "v", F.col("fp").alias("other")), ["n", "v"])
        .filter(F.col("fp") < F.col("other"))
        .select(F.col("fp").alias("u"), F.col("other").alias("v"))
    )
    crowded = store.save(
        "crowded", members.filter(F.col("size") > PAIRED_KEY).select("fp").distinct()
    )
    # within 2 bits: a neighbour one bit away of both; within 3: one bit from one, two from the other
    around = crowded.select("fp", F.explode(_neighbours(F.col("fp"), 1)).alias("z"))
    if distance == 3:
        far = crowded.select("fp", F.explode(_neighbours(F.col("fp"), 2)).alias("z"))
        hubs = around.groupBy("z").agg(F.min("fp").alias("hub"))
        stars = far.join(hubs, "z").select(F.col("hub").alias("u"), F.col("fp").alias("v"))
    else:
        hubs = around.groupBy("z").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n"))
        stars = around.join(hubs.filter(F.col("n") > 1), "z").select(
            F.col("hub").alias("u"), F.col("fp").alias("v")
        )
    return twos.unionAll(paired).filter(near).unionAll(stars.filter(F.col("u") != F.col("v")))


def near_duplicates(
    documents: DataFrame, shingle_words: int = 3, distance: int = 2, resembling: bool = False
) -> DataFrame:
    """(doc_id, text_key, fp, component_id, copies_of_row) of every row of `documents`.

    Rows whose fingerprints differ by `distance` bits or fewer are linked, and if asked for, also
    those whose sets of shingles are as similar as `resemblance` demands; component_id is the
    smallest doc_id that links reach, the row's own included. Rows without an id take part and
    get the smallest id of their component, null if none has one. Repeated rows stay. Other
    columns are not looked at.
    """
    store = staging(documents.sparkSession)
    rows = store.save("fingerprints", fingerprints(documents, shingle_words, resembling))
    fps = store.save("distinct", rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = components(store, links(store, fps.select("fp"), distance))
    rooted = fps.join(found, fps["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    if resembling:
        rooted = store.save("rooted", rooted)
        texts = documents.select(text_key(F.col("text")).alias("text_key"), "text")
        pairs = resemblance.candidates(store, rows, rooted.select("fp", "root"))
        more = resemblance.links(store, pairs, texts, lambda t: shingle_sets(t, shingle_words))
        merged = components(store, more).withColumnRenamed("root", "merged")
        rooted = rooted.join(merged, rooted["root"] == merged["node"], "left").select(
            "fp", "first_id", F.coalesce("merged", "root").alias("root")
        )
    first = store.save(
        "first", rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    )
    named = store.save("named", rooted.join(first, "root").select("fp", "root", "component_id"))
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def one_of_each(
    documents: DataFrame, shingle_words: int = 3, distance: int = 2, resembling: bool = False
) -> DataFrame:
    """The documents without near duplicates, as `near_duplicates` finds them: of each component
    the row with the smallest id stays, of rows without an id the one with the smallest text key,
    and one of repeated rows. All columns stay as they are."""
    store = staging(documents.sparkSession)
    rows = store.save("components", near_duplicates(documents, shingle_words, distance, resembling))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    kept = rows.groupBy("root").agg(F.min(order).alias("kept")).select("kept.doc_id", "kept.text_key")
    copies = rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    same = kept["doc_id"].eqNullSafe(copies["doc_id"]) & (kept["text_key"] == copies["text_key"])
    kept = store.save(
        "kept", kept.join(copies, same).select(kept["doc_id"], kept["text_key"], "copies")
    )
    rows = as_rows(documents)
    found = rows.join(kept, same_document(rows, kept))
    alone = found.filter(F.col("copies") == 1).select("row")
    repeated = found.filter(F.col("copies") > 1).dropDuplicates(["row_id", "row_key"]).select("row")
    return alone.unionAll(repeated).select("row.*")
