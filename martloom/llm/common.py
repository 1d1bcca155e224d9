"""What several operators share: columns, keys and written intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.sources.staging import Staging, shared_folder

# The characters between words, as a regular expression class.
ASCII_SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    """Where the installed package of public tokenizers keeps its file."""
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging(spark: SparkSession) -> Staging:
    """Tables in the shared folder; `save` cuts the lineage of what it writes."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        shared_folder(spark)
    return Staging(spark)


def text_key(text: Column) -> Column:
    """Tells documents apart that share an id, or have none."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def split_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` as an array; no words for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{ASCII_SPACE}]+"), "")


def as_rows(documents: DataFrame) -> DataFrame:
    """Each document as one column `row`, with `row_id` and `row_key` to join on: names of other
    columns then never meet those of an operator."""
    row = F.struct(*[documents[c] for c in documents.columns])
    key = text_key(documents["text"])
    return documents.select(row.alias("row"), documents["doc_id"].alias("row_id"), key.alias("row_key"))


def same_document(rows: DataFrame, other: DataFrame) -> Column:
    """Join condition of `as_rows` and a table with doc_id and text_key; nulls are equal."""
    return rows["row_id"].eqNullSafe(other["doc_id"]) & (rows["row_key"] == other["text_key"])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that no fit may see: crc32 of the id as text, remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, most: int, folds: int = 5
) -> DataFrame:
    """(doc_id, text, label) of at most `most` labelled rows outside the held-out fold. Of rows that
    share an id, the one with the smallest text key is taken.

    The rows are those with the smallest hash of their id, so any size of input gives the
    same kind of sample. A label of neither 0 nor 1 is left out. The chosen ids are at most
    `most` rows of two numbers: that bound is why they are broadcast.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .filter(~held_out(F.col("doc_id"), folds))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # least rows are found before the shuffle: a hot id sends one row from each task
    one = F.min(F.struct(text_key(F.col("text")).alias("text_key"), "text", "label")).alias("one")
    return rows.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.label")
