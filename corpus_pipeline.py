"""Documents to packed training sequences, in stages that are each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import op4_packing, op6_substrings, op7_jaccard, op8_fertility, op10_pii
from rosterline.llm.common import remove, small_batches, staged, staged_folders, table
from rosterline.llm.queries import PIECE_BPE, WORD_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the bands of tokeniser fertility keep."""
    small_batches(spark)
    return op8_fertility.keep_good(docs, PIECE_BPE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    small_batches(spark)
    return op7_jaccard.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere as well."""
    small_batches(spark)
    return _counted(op6_substrings.without_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _counted(op10_pii.mask_personal(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens.

    The stages before have grown the Python workers, so this one remembers less.
    """
    small_batches(spark)
    return op4_packing.pack(docs, WORD_BPE, remembered=300_000, batch_bytes=4 << 20)


def _counted(docs: DataFrame) -> DataFrame:
    """Bring `n_chars` in line with the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("personal data", personal_data),
    ("best-fit packing", packing),
]

# Tokenising, expectation maximisation and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each to what its predecessor kept.

    Once a stage's documents are written, its input and its intermediate tables are removed.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with staged_folders() as folders:
            docs = staged(stage(spark, docs, sf_dir))
        *used, written = folders
        for folder in [*before, *used]:
            remove(spark, folder)
        before = [written]
    return STAGES[-1][1](spark, docs, sf_dir)
