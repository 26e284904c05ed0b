"""The corpus pipeline: quality rules, near-duplicate removal, repeated-passage removal, secret redaction, packing.

Each stage reads the columns of documents by name and returns these alone, so other columns of the input,
whatever their names, go with the first stage. A text of any length is worked on as a whole. Every stage of
an empty table is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import near_dedup, packing, quality_rules, secret_ledger, staging, suffix_dedup

#: The columns of documents that every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates: shingles of five words, similarity in per cent.
WORDS, PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts fail the base rule and go. Each row is judged by its own text, so of rows that
    repeat a doc_id some may stay and others go; equal rows share their fate. A value at a limit stays.
    """
    return quality_rules.passing(docs.select(*COLUMNS))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows with a null doc_id take no part and stay, as do rows without words. Rows that repeat a doc_id are
    documents of their own; those with the smallest id of their group stay, equal rows all of them.
    """
    there = near_dedup.linked(docs, PERCENT, WORDS).where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    gone = (docs["doc_id"] == there["_id"]) & (F.xxhash64(docs["text"].cast("string")) == there["_hash"])
    return docs.join(there, gone, "left_anti").select(*COLUMNS)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier too. Bytes of characters that a cut breaks go as well.

    Null and empty texts stay as they are. A null doc_id stands before all others. Rows that repeat a
    doc_id with other texts are documents of their own, equal rows one document. n_chars follows the text.
    """
    out = suffix_dedup.without_repeats(docs, carry=("lang", "source", "n_chars", "text"), as_text=True)
    cut = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return out.withColumn("text", cut).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark.

    Null and empty texts stay as they are. Overlapping spans get one mark. Equal texts are scanned once,
    however many rows have them. n_chars follows the text.
    """
    found = secret_ledger.located(docs.select(*COLUMNS), secret_ledger.scan(docs))
    some = F.size("spans") > 0
    marked = secret_ledger.redacted(found.withColumn("_some", some))
    return marked.withColumn("n_chars", F.when(F.col("_some"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place.

    Null and empty texts are a piece with the end token alone. Each row, a repeated one too, is packed.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]
#: Not expressible in SQL: the stages after the first are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again for the next."""
    docs = staging.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staging.stored(docs, f"stage-{name}")
    return docs
