"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from martloom.llm import (
    bpe,
    conversation_repair,
    decontamination,
    fixity,
    line_dedup,
    mixing,
    quality,
    repair,
    secret_scan,
    simhash,
    toxicity,
    url_filter,
    whitening,
)
from martloom.llm.common import read_table, staging, vocabulary_path

Query = Callable[[SparkSession, str], DataFrame]


def op3_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of the patterns' matches, and all spans."""
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))

    def joined(spans: str):
        texts = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(texts, ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secret_scan.BASE_KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op4_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op5_quality_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    documents = read_table(spark, sf_dir, "documents")
    rules = quality.fit(documents, read_table(spark, sf_dir, "labels"))
    return quality.judged(documents.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def op7_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two replicas of all pages as WARC files, one of them damaged by a rule; the places where
    the audit finds that they differ, and their pages."""
    store = staging(spark)
    rule = F.pmod(F.octet_length(F.coalesce("html", F.lit(""))) + F.col("page_id"), F.lit(97))
    damaged = (
        F.when(rule == 0, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30)))
        .when(rule == 2, F.substring("html", 1, F.floor(F.length("html") / 2).cast("int")))
        .otherwise(F.col("html"))
    )
    body = fixity.warc_record(F.col("page_id"), F.col("url"), damaged)
    pages = read_table(spark, sf_dir, "pages")
    more = [F.sha2(body, 256).alias("damaged"), F.coalesce(rule, F.lit(-1)).alias("rule")]
    records = store.save("records", fixity.archive(pages, more))
    original = records.filter(F.col("rule") != 3).select("file", "offset", "digest")
    replica = records.filter(F.col("rule") != 1).select("file", "offset", F.col("damaged").alias("digest"))
    found = fixity.audit(original, replica).select("file", "offset", "kind")
    return found.join(records, ["file", "offset"]).select("page_id", "file", "offset", "length", "kind")


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by lists that change. The tables have no dates, so days follow from
    ids and names by rule; hosts and first path parts of the pages themselves are listed."""
    pages = read_table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    captures = pages.select("page_id", "url", day.alias("day"))
    host = url_filter.host_of(F.col("url"))
    part = F.regexp_extract("url", r"^[^:]*://[^/?#]*/([^/?#]+)", 1)
    keys = (
        pages.select(F.explode(F.array(host, F.when(part != "", F.concat(host, F.lit("/"), part)))).alias("key"))
        .filter(F.col("key").isNotNull() & (F.col("key") != ""))
        .distinct()
    )
    size = F.length("key")

    def entry(action: str, category: str, step: int, wide: int):
        when = F.date_add(F.lit("2024-01-01").cast("date"), (size * step) % wide)
        return F.struct(F.lit(action).alias("action"), F.lit(category).alias("category"), when.alias("day"))

    listed = [entry("add", "spam", 13, 120), entry("remove", "spam", 29, 366), entry("add", "adult", 7, 300)]
    entries = keys.select("key", F.explode(F.array(*listed)).alias("e")).select("key", "e.*")
    return url_filter.judged(captures, entries)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier equal or nearly equal line makes superfluous, per document."""
    report = line_dedup.line_report(read_table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_lines", "n_dropped", "dropped_lines")


def op6_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to compressed shards and read back from them."""
    path = f"{staging(spark).root}/shards"
    repair.write_shards(read_table(spark, sf_dir, "documents"), vocabulary_path(), path)
    return repair.read_documents(spark, path)


def op10_bpe_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as hashes."""
    documents = read_table(spark, sf_dir, "documents")
    return bpe.encoded(documents, vocabulary_path(), decode=True, keep_ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(
        spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op2_decontamination_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule, and their cheapest repair."""
    conversations = read_table(spark, sf_dir, "conversations")
    return conversation_repair.repaired(conversation_repair.damaged(conversations))


def op12_mix_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words a mix of all sources by weight takes of every document."""
    return mixing.mixed(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened scores of every embedding on the eight leading components."""
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_toxicity_grammar": op1_toxicity_grammar,
    "op2_decontamination_index": op2_decontamination_index,
    "op3_secret_battery": op3_secret_battery,
    "op4_simhash_variants": op4_simhash_variants,
    "op5_quality_list": op5_quality_list,
    "op6_repair_shards": op6_repair_shards,
    "op7_fixity_audit": op7_fixity_audit,
    "op8_url_lists": op8_url_lists,
    "op9_line_dedup": op9_line_dedup,
    "op10_bpe_backtracking": op10_bpe_backtracking,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_mix_weights": op12_mix_weights,
    "op13_feast_whitening": op13_feast_whitening,
    "pipeline": corpus_pipeline.run,
}

_WORDS = r"""list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination_index": f"""
        WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT item_id, s AS at, array_to_string(w[s + 1 : s + 10], ' ') AS phrase,
                   least(len(w), 10) AS size
            FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s
                  FROM item_words WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        places AS (
            SELECT doc_id, size, s, array_to_string(w[s + 1 : s + size], ' ') AS phrase
            FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS s
                  FROM doc_words, sizes WHERE len(w) >= size)),
        found AS (SELECT doc_id, item_id, s, p.size FROM places p
                  JOIN windows USING (phrase) WHERE windows.size = p.size),
        hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
                FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items,
                         string_agg(item, ',' ORDER BY item) AS listed
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
                  GROUP BY doc_id),
        postings AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS c FROM doc_words),
        counts AS (SELECT word, count(*) AS n FROM postings GROUP BY word),
        asked AS (
            SELECT string_split(phrase, ' ') AS terms, list_distinct(list(item_id)) AS item_ids
            FROM windows GROUP BY phrase),
        rarest AS (
            SELECT terms, any_value(item_ids) AS item_ids, arg_min(word, n) AS word
            FROM (SELECT terms, item_ids, unnest(terms) AS word FROM asked) JOIN counts USING (word)
            GROUP BY terms),
        around AS (
            SELECT doc_id, item_ids, terms, w[greatest(c - 18, 1) : c + 20] AS here
            FROM rarest JOIN postings USING (word) JOIN doc_words USING (doc_id)
            WHERE list_has_all(w[greatest(c - 18, 1) : c + 20], terms)),
        close AS (
            SELECT doc_id, item_ids FROM around
            WHERE len(list_filter(range(len(here)),
                                  lambda s: list_has_all(here[s + 1 : s + 20], terms))) > 0),
        near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near
                 FROM (SELECT doc_id, unnest(item_ids) AS item_id FROM close) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated,
               CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
        FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
             LEFT JOIN near USING (doc_id)""",
    "op12_mix_weights": r"""
        WITH RECURSIVE measured AS (
            SELECT doc_id, source, text,
                   len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                   lambda x: x <> '')) AS size,
                   ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '?')
                       || CASE WHEN text IS NULL THEN '?' ELSE ':' END || coalesce(text, '')), 1, 15)
                   )::BIGINT AS key
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
            FROM measured GROUP BY source),
        levels AS (
            SELECT 0 AS round, sum(source_size)::DOUBLE / sum(weight) AS level FROM sources
            UNION ALL
            SELECT round + 1, next FROM (
                SELECT round, any_value(level) AS level,
                       (sum(source_size)::DOUBLE
                        - coalesce(sum(CASE WHEN weight * level >= 3 * source_size THEN 3 * source_size END), 0))
                       / sum(CASE WHEN weight * level >= 3 * source_size THEN NULL ELSE weight END) AS next
                FROM levels, sources GROUP BY round)
            WHERE next > level),
        planned AS (
            SELECT source, source_size, least(weight * top, (3 * source_size)::DOUBLE) AS target
            FROM sources, (SELECT max(level) AS top FROM levels)),
        summed AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
                   sum(size) OVER (PARTITION BY m.source ORDER BY key
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
            FROM measured m JOIN planned p ON m.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(size * (whole + CASE
                   WHEN target - whole * source_size > 0
                        AND (until <= target - whole * source_size
                             OR (until - size <= target - whole * source_size
                                 AND (target - whole * source_size - (until - size)) * 2 >= size))
                   THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM summed""",
    "op7_fixity_audit": """
        WITH written AS (
            SELECT page_id, html, (strlen(html) + page_id) % 97 AS rule,
                   concat_ws(chr(13) || chr(10), 'WARC/1.0', 'WARC-Type: response',
                             'WARC-Record-ID: <urn:page:' || page_id || '>', 'WARC-Target-URI: ' || url,
                             'Content-Length: ' || strlen(html), '', html, '', '') AS record
            FROM pages),
        made AS (SELECT *, strlen(record) AS length, sha256(record) AS digest FROM written),
        started AS (
            SELECT *, coalesce(sum(length) OVER (ORDER BY page_id, digest
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM made),
        filed AS (SELECT *, CAST(start // 4194304 AS BIGINT) AS file FROM started),
        placed AS (SELECT *, start - min(start) OVER (PARTITION BY file) AS place FROM filed)
        SELECT page_id, file, CAST(place AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
               CASE rule WHEN 1 THEN 'missing' WHEN 3 THEN 'extra' ELSE 'changed' END AS kind
        FROM placed
        WHERE rule IN (1, 3) OR (rule = 0 AND substr(html, 1, 1) <> '#')
           OR (rule = 2 AND length(html) > 0)""",
    "op8_url_lists": r"""
        WITH seen AS (
            SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INT) AS day,
                   lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
                   regexp_extract(url, '^[^:]*://[^/?#]*/([^?#]*)', 1) AS path
            FROM pages),
        keys AS (
            SELECT DISTINCT key FROM (
                SELECT host AS key FROM seen
                UNION ALL SELECT host || '/' || split_part(path, '/', 1) FROM seen
                WHERE split_part(path, '/', 1) <> '') WHERE key <> ''),
        held AS (
            SELECT key, 'spam' AS category, DATE '2024-01-01' + CAST((length(key) * 13) % 120 AS INT) AS since,
                   CASE WHEN (length(key) * 29) % 366 >= (length(key) * 13) % 120
                        THEN DATE '2024-01-01' + CAST((length(key) * 29) % 366 AS INT) - 1 END AS until
            FROM keys
            UNION ALL
            SELECT key, 'adult', DATE '2024-01-01' + CAST((length(key) * 7) % 300 AS INT), NULL FROM keys),
        asked AS (
            SELECT page_id, url, day, unnest(list_distinct(list_concat(
                list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
                               lambda i: array_to_string(string_split(host, '.')[i:], '.')),
                list_transform(range(1, len(parts) + 1),
                               lambda i: host || '/' || array_to_string(parts[1:i], '/'))))) AS key
            FROM (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM seen)),
        met AS (
            SELECT page_id, key, category, since,
                   row_number() OVER (PARTITION BY page_id
                       ORDER BY length(key) DESC, since DESC, key DESC, category) AS place
            FROM asked JOIN held USING (key)
            WHERE day >= since AND (until IS NULL OR day <= until))
        SELECT seen.page_id, seen.url, seen.day, key, category, since
        FROM seen LEFT JOIN met ON met.page_id = seen.page_id AND place = 1""",
}
