"""Corpus pipeline: documents to packed training sequences.

Each stage works on all rows that its predecessor kept. Between stages the rows are
written as Parquet in the shared scratch folder and read again, so a lost executor
costs the running stage some tasks and no finished stage anything.

1. ``quality``: rows that the classifier rejects go.
2. ``lines``: lines that are equal or near to an earlier one go, and rows of which
   nothing but blank is left by that.
3. ``near_copies``: of each group of similar documents the one with the smallest
   doc_id stays.
4. ``decontaminate``: rows that hold a passage of a benchmark item go.
5. ``pack``: token pieces with their places in training sequences.

All but the last return the columns of their input; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontaminate, jaccard, line_dedup, packing, quality
from newsloom.llm.queries import table, tokenizer_path
from newsloom.scratch import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that lose no line stay as they are, blank ones included."""
    done = line_dedup.dedup_lines(docs)
    left = done.filter((F.col("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        length = F.when(F.col("lines_removed") == 0, F.col("n_chars")).otherwise(F.char_length("text"))
        left = left.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near_copies", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("pack", packed),
]

#: The classifier and the tokenizer have no SQL; the pipeline is tested against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; a row for each packed piece."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
