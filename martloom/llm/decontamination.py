"""Benchmark passages in documents, found with a distributed positional inverted index.

The index holds a posting (term, document, position) for every document word that occurs in the
benchmark at all; other words cannot be part of a passage. Each window of the benchmark is
looked up from its rarest word: the postings of a term, shifted by the word's place in the
window, are a list of places where the window may start. The lists of the two rarest words are
intersected first; what is left is checked against the lists of all other words at once. So the
frequent words' long lists are only read for the few documents that are still in question.

Joins are equality joins on term or on (document, position). The only broadcast asked for is a
set of at most BUCKETS numbers that thins out the long lists before they are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.common import LOWER, UPPER, as_rows, same_document, staging, text_key
from martloom.sources.staging import Staging

WINDOW = 10
# Words of a document in which a proximity match lies.
STRETCH = 20
BUCKETS = 1 << 20
# Fixed value: what separates words, before and after A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATOR_CHARACTERS = "".join(
    chr(c) for c in range(128) if not chr(c).isalnum()
)
# Marks the end of a document in its list of words: a character that is in no word.
_END = "\x00"


def words_of(text: Column) -> Column:
    """Words as they stand, not lower-cased; no words for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SEPARATOR_CHARACTERS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SEPARATORS)
    )


def lowered(word: Column) -> Column:
    """A-Z lower-cased. Most words have no capital, which is quick to see."""
    return F.when(word == F.lower(word), word).otherwise(
        F.translate(word, UPPER, LOWER)
    )


@dataclass(frozen=True)
class Items:
    """Windows of a benchmark: terms (term, term_id), windows (window_id, size, offset, term_id),
    and members (window_id, item_id)."""

    terms: DataFrame
    windows: DataFrame
    members: DataFrame


def benchmark_windows(store: Staging, benchmark: DataFrame, size: int = WINDOW) -> Items:
    """Equal windows are one, whichever items they are from. An item of fewer words is one
    window, one without words none. Ids are numbers of written rows, so they stay the same."""
    words = benchmark.select(
        "item_id", F.transform(words_of(F.col("text")), lowered).alias("words")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    cut = words.filter(F.size("words") > 0).select(
        "item_id",
        F.explode(F.transform(starts, lambda s: F.slice("words", s + 1, size))).alias("window"),
    )
    cut = store.save("cut", cut)
    windows = store.save(
        "windows",
        cut.select("window").distinct().select("window", F.monotonically_increasing_id().alias("window_id")),
    )
    terms = windows.select(F.explode("window").alias("term")).distinct()
    ends = windows.sparkSession.range(1).select(F.lit(_END).alias("term"))
    terms = store.save(
        "terms",
        terms.select("term", F.monotonically_increasing_id().alias("term_id")).unionAll(
            ends.select("term", F.lit(-1).cast("long"))
        ),
    )
    placed = windows.select(
        "window_id", F.size("window").alias("size"), F.posexplode("window").alias("offset", "term")
    ).join(terms, "term")
    return Items(
        terms,
        store.save("placed", placed.select("window_id", "size", "offset", "term_id")),
        store.save("members", cut.join(windows, "window").select("window_id", "item_id").distinct()),
    )


def build_index(store: Staging, documents: DataFrame, terms: DataFrame) -> DataFrame:
    """The written index (term_id, doc_id, text_key, position) over the terms given. Term -1
    stands once in every document, at the number of its words."""
    words = F.concat(words_of(F.col("text")), F.array(F.lit(_END)))
    each = documents.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), F.posexplode(words).alias("position", "word")
    )
    found = each.select("doc_id", "text_key", "position", lowered(F.col("word")).alias("term")).join(
        terms, "term"
    )
    return store.save("index", found.select("term_id", "doc_id", "text_key", "position"))


_DOC = ("doc_id", "text_key")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(BUCKETS))


def _ranked(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows with the rank of each word, 1 for the rarest in the documents. A window with a
    word that no document has is left out."""
    counts = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("postings"))
    known = windows.join(counts, "term_id")
    window = Window.partitionBy("window_id")
    return (
        known.withColumn("known", F.count(F.lit(1)).over(window))
        .withColumn("rank", F.row_number().over(window.orderBy("postings", "offset")))
        .filter(F.col("known") == F.col("size"))
        .select("window_id", "size", "offset", "term_id", "rank")
    )


def phrase_matches(store: Staging, index: DataFrame, items: Items) -> DataFrame:
    """(doc_id, text_key, window_id, start, size) of every place where a window occurs."""
    ranked = store.save("ranked", _ranked(index, items.windows))
    match = ["doc_id", "text_key", "window_id", "start"]

    def shifted(rank: int) -> DataFrame:
        chosen = ranked.filter(F.col("rank") == rank)
        return index.join(chosen, "term_id").select(
            "doc_id", "text_key", "window_id", (F.col("position") - F.col("offset")).alias("start"), "size"
        )

    first, second = shifted(1).filter(F.col("start") >= 0), shifted(2)
    both = first.filter(F.col("size") > 1).join(
        second.select(*[F.col(c).alias(f"_{c}") for c in match]),
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("text_key") == F.col("_text_key"))
        & (F.col("window_id") == F.col("_window_id"))
        & (F.col("start") == F.col("_start")),
        "left_semi",
    )
    both = store.save("both", both.distinct())  # repeated document rows match twice
    rest = ranked.filter(F.col("rank") > 2)
    rest_terms = store.save("rest_terms", rest.select("term_id").distinct())
    hoped = both.filter(F.col("size") > 2).join(rest.select("window_id", "offset", "term_id"), "window_id")
    hoped = hoped.select(*match, "size", (F.col("start") + F.col("offset")).alias("position"), "term_id")
    buckets = both.filter(F.col("size") > 2).select(_bucket().alias("bucket")).distinct()
    lists = (
        index.withColumn("bucket", _bucket())
        .join(F.broadcast(buckets), "bucket", "left_semi")
        .join(rest_terms, "term_id", "left_semi")
        .select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"),
                F.col("position").alias("_position"), F.col("term_id").alias("_term_id"))
    )
    there = hoped.join(
        lists,
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & (F.col("text_key") == F.col("_text_key"))
        & (F.col("position") == F.col("_position"))
        & (F.col("term_id") == F.col("_term_id")),
        "left_semi",
    )
    long = there.groupBy(*match, "size").agg(F.count(F.lit(1)).alias("found"))
    long = long.filter(F.col("found") == F.col("size") - 2)
    out = first.filter(F.col("size") == 1).unionByName(both.filter(F.col("size") == 2))
    return out.distinct().unionByName(long.select(*match, "size"))


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))


def proximity_matches(
    store: Staging, index: DataFrame, items: Items, stretch: int = STRETCH
) -> DataFrame:
    """(doc_id, text_key, window_id): windows whose different words all stand, in any order, in
    some `stretch` successive words of the document.

    Places of a window's rarest word are kept where the second rarest is less than a stretch
    away; the words of the window around those that are left, at most two stretches of them,
    then tell. Places meet by blocks of a stretch, so a frequent word is not held against all others
    of its document.
    """
    terms = items.windows.groupBy("window_id", "term_id").agg(F.min("offset").alias("offset"))
    each = F.count(F.lit(1)).over(Window.partitionBy("window_id"))
    ranked = store.save("near_ranked", _ranked(index, terms.withColumn("size", each)))
    of_others = [F.col(c).alias(f"_{c}") for c in (*_DOC, "position")]

    def block(place: str) -> Column:
        return F.floor(F.col(place) / stretch)

    def around(place: str) -> Column:
        return F.explode(F.array(block(place) - 1, block(place), block(place) + 1))

    def places(rank: int) -> DataFrame:
        return index.join(ranked.filter(F.col("rank") == rank), "term_id")

    close = F.abs(F.col("_position") - F.col("centre")) < stretch
    first = places(1).select(*_DOC, "window_id", "size", F.col("position").alias("centre"))
    second = places(2).select(
        *of_others, F.col("window_id").alias("_window_id"), block("position").alias("_block")
    )
    both = first.filter(F.col("size") > 1).withColumn("block", around("centre")).join(
        second,
        _same_document()
        & (F.col("window_id") == F.col("_window_id"))
        & (F.col("block") == F.col("_block"))
        & close,
        "left_semi",
    )
    centres = store.save("centres", both.drop("block").distinct())
    buckets = centres.select(_bucket().alias("bucket")).distinct()
    lists = (
        index.withColumn("bucket", _bucket())
        .join(F.broadcast(buckets), "bucket", "left_semi")
        .select(*of_others, F.col("term_id").alias("_term_id"), block("position").alias("_block"))
    )
    hoped = centres.withColumn("block", around("centre")).join(
        ranked.select("window_id", "term_id"), "window_id"
    )
    met = hoped.join(
        lists,
        _same_document()
        & (F.col("block") == F.col("_block"))
        & (F.col("term_id") == F.col("_term_id"))
        & close,
    )
    seen = met.groupBy(*_DOC, "window_id", "size", "centre").agg(
        F.collect_set(F.struct("_position", "_term_id")).alias("words")
    )

    def all_from(start: Column) -> Column:
        here = F.filter(
            "words", lambda w: (w["_position"] >= start) & (w["_position"] < start + stretch)
        )
        return F.size(F.array_distinct(F.transform(here, lambda w: w["_term_id"]))) == F.col("size")

    starts = F.sequence(F.col("centre") - stretch + 1, F.col("centre"))
    near = seen.filter(F.size("words") >= F.col("size")).filter(F.exists(starts, all_from))
    alone = first.filter(F.col("size") == 1)
    match = [*_DOC, "window_id"]
    return near.select(match).unionByName(alone.select(match)).distinct()


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_near, item_ids) of every document; item_ids are sorted
    as strings, and empty for a clean document.

    A word inside any occurrence of a window is hit. n_near counts the items of which a window has
    all its different words, in any order, in STRETCH successive words of the document: whatever
    was reordered or has words put in, and all items that occur. Null texts have no words. An item without
    an id marks words but is not listed. Rows of equal id and text are reported once.
    """
    store = staging(documents.sparkSession)
    items = benchmark_windows(store, benchmark, size)
    index = build_index(store, documents, items.terms)
    matches = store.save("matches", phrase_matches(store, index, items))
    spans = matches.groupBy(*_DOC, "start").agg(F.max("size").alias("size"))
    earlier = (
        Window.partitionBy(*_DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("start") + F.col("size")
    reached = F.coalesce(F.max(end).over(earlier), F.lit(0))
    hit = spans.select(*_DOC, F.greatest(end - F.greatest("start", reached), F.lit(0)).alias("new"))
    hit = hit.groupBy(*_DOC).agg(F.sum("new").cast("long").alias("n_hit"))
    near = proximity_matches(store, index, items).join(items.members, "window_id")
    near = near.groupBy(*_DOC).agg(F.count_distinct("item_id").alias("n_near"))
    found = matches.select(*_DOC, "window_id").distinct().join(items.members, "window_id")
    listed = found.select(*_DOC, F.col("item_id").cast("string").alias("item")).distinct()
    listed = listed.groupBy(*_DOC).agg(F.array_sort(F.collect_list("item")).alias("ids"))
    every = index.filter(F.col("term_id") == -1).select(
        *_DOC, F.col("position").cast("long").alias("n_words")
    )
    for part in (hit, near, listed):
        every = every.unionByName(part, allowMissingColumns=True)
    return every.groupBy(*_DOC).agg(
        F.max("n_words").alias("n_words"),
        F.coalesce(F.sum("n_hit"), F.lit(0)).alias("n_hit"),
        F.coalesce(F.sum("n_near"), F.lit(0)).alias("n_near"),
        F.coalesce(F.max("ids"), F.array().cast("array<string>")).alias("item_ids"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs; all columns stay as they are."""
    store = staging(documents.sparkSession)
    items = benchmark_windows(store, benchmark)
    index = build_index(store, documents, items.terms)
    bad = phrase_matches(store, index, items).select("doc_id", "text_key").distinct()
    bad = store.save("contaminated", bad)
    rows = as_rows(documents)
    return rows.join(bad, same_document(rows, bad), "left_anti").select("row.*")
