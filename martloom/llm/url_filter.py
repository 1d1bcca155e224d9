"""URL filters whose lists change: every capture is judged by the entries of its own day.

Dated additions and removals of a key become validity intervals. A key is a host, a parent
domain of it, or a host with the beginning of a path. Captures and intervals meet in an equality
join on (key, month), intervals standing once in each of their months; what remains is a check
of two dates. So a capture meets the intervals of one month of its keys, however long a key's
history is, and a host with a third of all captures is split like any other skewed join key. Of
the entries that hold, the most specific key decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")
    return F.rtrim(F.lower(host), F.lit("."))


def keys_of(url: Column) -> Column:
    """Keys that can list a URL: its host and the domains above it, of two labels at least, and
    the host with each beginning of its path that ends at a slash or at the end."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:]*://[^/?#]*/([^?#]*)", 1)
    parts = F.array_remove(F.split(path, "/"), "")
    paths = F.transform(
        F.slice(parts, 1, F.size(parts)),
        lambda _, i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i + 1), "/")),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, paths))
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(key, category, since, until) from (key, category, action, day): an `add` holds until the
    day before the key's next entry of that category, or for good (until is null). Of entries of
    one day the removal is the last. Rows without a key or day, or with another action, are
    left out; repeated rows count once."""
    known = entries.filter(
        F.col("key").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove")
    ).select("key", "category", "action", "day").distinct()
    order = Window.partitionBy("key", "category").orderBy("day", "action")
    following = known.withColumn("next", F.lead("day").over(order))
    return (
        following.filter(F.col("action") == "add")
        .select("key", "category", F.col("day").alias("since"), F.date_sub("next", 1).alias("until"))
        .filter(F.col("until").isNull() | (F.col("until") >= F.col("since")))
    )


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, day, key, category, since) of every capture (page_id, url, day): the entry
    that decides, nulls if none holds on that day. The longest key wins, then the later entry,
    then the smaller category. Repeated captures are reported once; a capture without a day or
    a host matches nothing.
    """
    seen = captures.select("page_id", "url", "day")
    span = seen.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    held = intervals(entries).filter(F.col("since") <= F.lit(span["last"]))
    until = F.coalesce(F.least("until", F.lit(span["last"])), F.lit(span["last"]))
    held = held.withColumn("until", until).filter(F.col("until") >= F.lit(span["first"]))
    start = F.greatest("since", F.lit(span["first"]))
    held = held.select(
        "key", "category", "since", "until",
        F.explode(F.sequence(_month(start), _month(F.col("until")))).alias("month"),
    )
    keyed = seen.select("*", _month(F.col("day")).alias("month"), F.explode_outer(keys_of(F.col("url"))).alias("key"))
    holds = F.col("day").between(F.col("since"), F.col("until"))
    met = keyed.join(held, ["key", "month"], "left").select(
        "page_id", "url", "day",
        F.when(holds, F.struct(F.length("key").alias("size"), "since", "key")).alias("entry"),
        "category",
    )
    capture = ["page_id", "url", "day"]
    # first the smallest category of each entry, then the strongest entry: partial sums in both
    named = met.groupBy(*capture, "entry").agg(F.min("category").alias("category"))
    best = named.groupBy(*capture).agg(
        F.max("entry").alias("top"), F.max_by("category", "entry").alias("category")
    )
    found = F.col("top").isNotNull()
    return best.select(
        *capture,
        F.col("top.key").alias("key"),
        F.when(found, F.col("category")).alias("category"),
        F.col("top.since").alias("since"),
    )
