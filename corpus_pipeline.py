"""The training-corpus pipeline: what is toxic, poor, copied or repeated goes; what stays is packed for training.

Every stage takes (spark, docs, sf_dir), keeps columns that it doesn't know, and gives no rows for an empty table. ``run`` writes each stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import factors, neardup, packing, quality, toxicity
from paperloom.llm.common import materialise, table
from paperloom.llm.queries import tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go; rows are judged one by one, null texts as empty ones, and without usable labels the score is that of no toxic votes."""
    return toxicity.without_toxic(docs, toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained views call poor go; rows are judged one by one, null texts as empty ones, and without usable labels all stay."""
    return quality.without_poor(docs, quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id; of equal rows one. Documents without words and rows without a doc_id all stay."""
    return neardup.without_near_duplicates(docs, size=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under windows of 50 words that a document with a smaller doc_id has go from the texts; null texts become empty, rows of one doc_id take nothing from each other, rows without one lose nothing."""
    return factors.without_repeats(docs, window=50)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised texts, placed in sequences of at most 2048 tokens; null and empty texts are the end id alone, repeated rows are packed as rows of their own."""
    return packing.best_fit(docs, tokenizer_file("word_bpe_49k.json"), length=2048)


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("substrings", substring_stage), ("packing", packing_stage)]

#: Co-training, nearest-example votes and tokenisation have no SQL form; tests/llm/test_registered.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
