"""One check query per operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import (
    op1_lattice,
    op2_chain,
    op3_pq,
    op4_packing,
    op5_secrets,
    op6_substrings,
    op7_jaccard,
    op8_fertility,
    op9_bpe,
    op10_pii,
    op11_runs,
    op12_urls,
    op13_spelling,
    oracle,
)
from rosterline.llm.common import small_batches, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return table(spark, sf_dir, "documents")


def op1_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return op1_lattice.lattice_scores(_documents(spark, sf_dir), PIECE_BPE, held_out)


def op2_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    return op2_chain.toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), categories)


def op3_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_pq.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_packing.pack(_documents(spark, sf_dir), WORD_BPE)


def op5_trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_secrets.secret_report(table(spark, sf_dir, "documents"))


def op6_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_substrings.removal_digest(_documents(spark, sf_dir))


def op7_multi_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_jaccard.join_report(_documents(spark, sf_dir))


def op8_fertility_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_fertility.quality_report(_documents(spark, sf_dir), PIECE_BPE)


def op9_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_bpe.bpe_digest(_documents(spark, sf_dir), WORD_BPE)


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_pii.personal_report(table(spark, sf_dir, "documents"))


def op11_scale_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = op11_runs.repeated_tail(F.col("doc_id"), F.col("text"))
    return op11_runs.run_report(_documents(spark, sf_dir), text=text)


URL_RULES = [
    op12_urls.Rule("allow", "com/"),
    op12_urls.Rule("block", "example.com/en/"),
    op12_urls.Rule("allow", "www.example.com/en/"),
    op12_urls.Rule("block", "net/es/"),
    op12_urls.Rule("block", "net/fr/"),
]


def op12_markov_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_urls.url_report(table(spark, sf_dir, "pages"), URL_RULES)


def op13_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_spelling.variant_report(_documents(spark, sf_dir), change=op13_spelling.slip)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_subword_lattice, op2_classifier_chain, op3_product_quantisation, op4_best_two_fit, op5_trigram_index, op6_suffix_automata, op7_multi_order, op8_fertility_bands, op9_rank_array_bpe, op10_weak_supervision, op11_scale_tiles, op12_markov_ratio, op13_reduced_alphabet]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
