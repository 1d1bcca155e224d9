"""A training corpus out of `documents`: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import bpe, decontamination, line_dedup, quality, simhash
from martloom.llm.common import read_table, staging, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the decision list learned from the labels."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has; those left without a word go."""
    return line_dedup.without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked by two
    differing bits or fewer, as op4 links them."""
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontamination.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document: its ids, and the hash
    of the text they decode to."""
    return bpe.encoded(docs, vocabulary_path(), decode=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; every stage but the last is written and read again."""
    store = staging(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.save(name.replace(" ", "_"), stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned rules, fingerprints and BPE are beyond SQL: tests compare with brute force.
ORACLE_SQL = None
