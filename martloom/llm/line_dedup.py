"""Near-duplicate lines by a deletion-neighbourhood join.

The unit of an edit is a word. A line goes if an earlier line, kept or not, has the same words,
or, for lines of eight words or more, differs by one word put in, left out or replaced. Earlier
is by (doc_id, text key, line number), rows without an id last.

A long line has as many variants with one word left out as words, so variants are made only for
lines that can have a partner at all: two lines one edit apart share their first or last half,
and a line that shares neither half with another line has none. That test is exact and drops no
pair. A variant's key is a sum over its words of hashes of (word, place): running sums give the
keys of all variants of a line in one pass over its words. Within one key, lines need not meet
each other: the smallest of each role is enough to tell which lines have an earlier partner, so
a template with a million fillings costs a million rows. Partners are compared word by word
before a line is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm.common import (
    ASCII_SPACE,
    as_rows,
    same_document,
    split_words,
    staging,
    text_key,
)

# Lines of fewer words are compared for equality only.
NEAR_WORDS = 8
# Bits of a hash of (word, place): sums over a million words stay below 2^63.
SUM_BITS = 42
# Most numbers in a broadcast set that thins out rows before a join.
BUCKETS = 1 << 20


def _order() -> Column:
    """Sorts lines; ids come first, rows without one last."""
    return F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key", "line_no")


def _key(words: Column, seed: str) -> Column:
    return F.xxhash64(F.lit(seed), F.size(words), words)


def _split_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line, line_words) of every line, one row at least per
    document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = documents.select(
        "doc_id", text_key(F.col("text")).alias("text_key"),
        F.posexplode(F.split(text, "\n")).alias("line_no", "line"),
    )
    return lines.select("*", split_words(F.col("line")).alias("line_words"))


def _halves() -> Column:
    """Keys of the beginnings and ends that a line shares with any line one edit away: half its
    words, and half the words of a line that is shorter by one."""
    words, n = F.col("line_words"), F.size("line_words")
    keys = []
    for half in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        size = F.greatest(half, F.lit(1))
        keys.append(_key(F.slice(words, 1, size), "head"))
        keys.append(_key(F.slice(words, n - size + 1, size), "tail"))
    return F.when(n >= NEAR_WORDS, F.array_distinct(F.array(*keys)))


def _thinned(rows: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows whose key may be among the keys (one column) of `wanted`: all that are, and some
    others. Keys are hashes, so two parts of their bits are as good as two hashes of them. What
    is broadcast is twice at most BUCKETS numbers."""
    for first_bit in (0, 24):

        def bucket(hashed: Column, first_bit: int = first_bit) -> Column:
            return F.pmod(F.shiftright(hashed, first_bit), F.lit(BUCKETS)).alias("bucket")

        buckets = wanted.select(bucket(wanted[wanted.columns[0]])).distinct()
        hopeful = rows.withColumn("bucket", bucket(key))
        rows = hopeful.join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
    return rows


def _variants(words: DataFrame) -> DataFrame:
    """(first, left, at, group, place) of each line's variants. `at` is the word left out, -1 for
    the whole line, `left` the number of words left; equal variants have equal groups, and equal
    places if the same place was left out, too. key, check and line_words stand beside the whole
    line only."""
    # `words` come in partitions of (key, check): the windows need no shuffle
    one = words.select(
        "key", "check", "first", F.size("line_words").alias("n"), "line_words",
        F.posexplode("line_words").alias("at", "word"),
    )
    one = one.withColumn("line_words", F.when(F.col("at") == 0, F.col("line_words")))
    line = Window.partitionBy("key", "check").orderBy("at")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    until = line.rowsBetween(Window.unboundedPreceding, 0)
    all_words = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums, wholes = [], []
    for name in ("v", "w"):

        def part(place: Column, name: str = name) -> Column:
            bits = F.lit((1 << SUM_BITS) - 1)
            return F.xxhash64(F.lit(name), "word", place).bitwiseAND(bits)

        here, moved = part(F.col("at")), part(F.col("at") - 1)
        left_of = F.coalesce(F.sum(here).over(before), F.lit(0))
        sums.append(left_of + F.sum(moved).over(all_words) - F.sum(moved).over(until))
        wholes.append(F.sum(here).over(all_words))
    whole = F.struct(F.lit(-1).alias("at"), F.col("n").alias("left"), F.xxhash64("n", *wholes).alias("group"))
    left = F.col("n") - 1
    without = F.struct("at", left.alias("left"), F.xxhash64(left, *sums).alias("group"))
    # the first word also stands for the whole line
    both = F.when(F.col("at") == 0, F.array(whole, without)).otherwise(F.array(without))
    made = one.select("key", "check", "first", "line_words", both.alias("both")).select(
        "key", "check", "first", "line_words", F.explode("both").alias("v")
    )
    is_whole = F.col("v.at") < 0
    return made.select(
        *[F.when(is_whole, F.col(c)).alias(c) for c in ("key", "check", "line_words")],
        "first", "v.*", F.xxhash64("v.group", "v.at").alias("place"),
    )


def _without(words: Column, at: Column) -> Column:
    return F.concat(F.slice(words, 1, at), F.slice(words, at + 2, F.size(words)))


def dropped_lines(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, line_no, n_words, key, check) of all lines, and the same of those that
    an earlier line makes superfluous. Lines without a word are never dropped; a document
    without lines has one such line. A repeated row repeats its lines in both. Other columns are
    not looked at."""
    store = staging(documents.sparkSession)
    n = F.size("line_words")
    lines = store.save(
        "lines",
        _split_lines(documents).select(
            "doc_id", "text_key", "line_no", n.alias("n_words"),
            _key(F.col("line_words"), "line").alias("key"),
            F.hash("line_words").alias("check"), _halves().alias("halves"),
            F.when(n >= NEAR_WORDS, F.col("line")).alias("line"),
        ),
    )
    distinct = store.save(
        "distinct",
        lines.filter(F.col("n_words") > 0)
        .groupBy("key", "check")
        .agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("copies")),
    )

    # lines that share a half with another line
    halves = lines.select("key", "check", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    shared = store.save("shared", shared.filter(F.col("low") != F.col("high")).select("half"))
    likely = _thinned(halves, F.col("half"), shared).join(shared, "half", "left_semi")
    likely = store.save("likely", likely.select("key", "check").distinct())

    # their words, from where each line stands first: copies meet as one row of each task, and the
    # rows stay in the partitions of (key, check) from here to the variants
    here = _thinned(lines.filter(F.col("n_words") >= NEAR_WORDS), F.col("key"), likely)
    first = F.min(F.struct(_order().alias("first"), "line")).alias("one")
    found = here.groupBy("key", "check").agg(first).join(likely, ["key", "check"], "left_semi")
    found = found.select("key", "check", "one.first", split_words(F.col("one.line")).alias("line_words"))

    # variants that are not alone: counting needs their keys only
    variants = store.save("variants", _variants(found))
    words = variants.filter(F.col("line_words").isNotNull()).select("key", "check", "first", "line_words")
    variants = variants.select("first", "left", "at", "group", "place")
    whole, without = F.col("at") < 0, F.col("at") >= 0
    keys = F.when(without, F.array("group", "place")).otherwise(F.array("group"))
    keys = variants.select(F.explode(keys).alias("shared_key"))
    met = keys.groupBy("shared_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    met = store.save("met", met.select("shared_key"))
    # one word replaced: the same place left out of both
    replaced = _thinned(variants.filter(without), F.col("place"), met)
    replaced = store.save("replaced", replaced.select("first", "at", "group", "place"))
    least = replaced.groupBy("place").agg(F.min("first").alias("other"), F.count(F.lit(1)).alias("n"))
    least = store.save("least", least.filter(F.col("n") > 1).select("place", "other"))
    # one word more or less: a whole line equals another with a word left out
    added = store.save("added", _thinned(variants, F.col("group"), met).select("first", "at", "group"))
    roles = added.groupBy("group").agg(
        F.min(F.when(whole, F.col("first"))).alias("short"),
        F.min(F.when(without, F.struct("first", "at"))).alias("long"),
    )
    roles = store.save("roles", roles.filter(F.col("short").isNotNull() & F.col("long").isNotNull()))
    mine = ["first", "at"]
    met_by = added.join(roles, "group")
    earlier = (
        replaced.join(least, "place")
        .select(*mine, "other", F.col("at").alias("other_at"))
        .unionByName(
            met_by.filter(without).select(*mine, F.col("short").alias("other"), F.lit(-1).alias("other_at"))
        )
        .unionByName(
            met_by.filter(whole).select(*mine, F.col("long.first").alias("other"), F.col("long.at").alias("other_at"))
        )
        .filter(F.col("other") < F.col("first"))
    )
    earlier = store.save("earlier", earlier)

    def rest(column: str, at: str) -> Column:
        left = _without(F.col(column), F.greatest(F.col(at), F.lit(0)))
        return F.when(F.col(at) < 0, F.col(column)).otherwise(left)

    def needed(column: str) -> DataFrame:
        wanted = earlier.select(F.xxhash64(column).alias("wanted"))
        return _thinned(words, F.xxhash64("first"), wanted)

    mine = needed("first").select("key", "check", "first", F.col("line_words").alias("mine"))
    others = needed("other").select(F.col("first").alias("other"), F.col("line_words").alias("others"))
    near = (
        earlier.join(mine, "first")
        .join(others, "other")
        .filter(rest("mine", "at") == rest("others", "other_at"))
        .select("key", "check", F.lit(True).alias("near"))
        .distinct()
    )
    near = store.save("near", near)

    # lines with a copy, and those that may have a near one: the others meet no join
    single = F.col("copies") == 1
    hopeful = distinct.filter(~single).unionByName(_thinned(distinct.filter(single), F.col("key"), near))
    repeated = hopeful.join(near, ["key", "check"], "left")
    repeated = store.save("repeated", repeated.filter((F.col("copies") > 1) | F.col("near")))
    columns = ["doc_id", "text_key", "line_no", "n_words", "key", "check"]
    placed = lines.select(columns)
    gone = _thinned(placed, F.col("key"), repeated.select("key")).join(repeated, ["key", "check"])
    gone = gone.filter(F.coalesce("near", F.lit(False)) | (_order() != F.col("first")))
    # not made distinct: that would tie the join to its keys, and a line of a third of all
    # documents could not be split
    return placed, store.save("gone", gone.select(columns))


def line_report(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, dropped_lines) of every document; lines without a
    word do not count. Repeated rows count once."""
    lines, gone = dropped_lines(documents)
    key = ["doc_id", "text_key"]
    # a row that is repeated has each line as often as line 0
    rows = F.sum((F.col("line_no") == 0).cast("long"))
    counted = lines.groupBy(key).agg(
        (F.sum((F.col("n_words") > 0).cast("long")) / rows).cast("long").alias("n_lines")
    )
    taken = F.array_sort(F.collect_set("line_no"))
    numbers = F.transform(taken, lambda n: n.cast("string"))
    dropped = gone.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.size(taken).alias("n_dropped"), F.array_join(numbers, ",").alias("dropped_lines")
    )
    same = counted["doc_id"].eqNullSafe(dropped["_id"]) & (counted["text_key"] == dropped["_key"])
    return counted.join(dropped, same, "left").select(
        *key,
        "n_lines",
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped_lines", F.lit("")).alias("dropped_lines"),
    )


def without_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents with superfluous lines taken out of `text`; n_chars follows if it is there.

    A document of which no word is left goes; one that had no word to begin with stays. Columns
    and the order of lines stay as they are. Equal rows share their fate.
    """
    store = staging(documents.sparkSession)
    _, gone = dropped_lines(documents)
    dropped = gone.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone"))
    dropped = store.save("dropped", dropped)
    rows = as_rows(documents)
    found = rows.join(dropped, same_document(rows, dropped), "left")
    text = F.col("row.text")
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(F.col("gone"), i))
    touched = F.col("gone").isNotNull()
    new = found.select("row", "gone", F.when(touched, F.array_join(left, "\n")).otherwise(text).alias("new"))
    shown = {c: F.col("row")[c] for c in documents.columns} | {"text": F.col("new")}
    if "n_chars" in shown:
        size = F.length("new").cast(documents.schema["n_chars"].dataType)
        shown["n_chars"] = F.when(touched, size).otherwise(shown["n_chars"])
    kept = ~touched | F.col("new").rlike(f"[^{ASCII_SPACE}]")
    row = F.struct(*[column.alias(c) for c, column in shown.items()])
    return new.select(F.inline(F.when(kept, F.array(row))))
