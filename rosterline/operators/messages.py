"""Messages: parsing, flagging against word lists, encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.text import words
from rosterline.schemas import MESSAGE


def parse_messages(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON bytes or text to sender, receiver and message; malformed input gives NULLs."""
    parsed = F.from_json(F.col(value).cast("string"), MESSAGE)
    return df.select(*keep, parsed.alias("_data")).select(*keep, "_data.*")


def word_table(vocab: DataFrame, marked: DataFrame, word: str = "word") -> DataFrame:
    """One row per listed word: is it in the vocabulary, is it marked.

    Grouped by a struct for the reason given in `distinct_keys`: words are skewed.
    """
    yes, no = F.lit(True), F.lit(False)
    listed = vocab.select(F.col(word).alias("_word"), yes.alias("_known"), no.alias("_marked"))
    listed = listed.unionByName(
        marked.select(F.col(word).alias("_word"), no.alias("_known"), yes.alias("_marked"))
    )
    table = listed.groupBy(F.struct("_word").alias("_key")).agg(
        F.bool_or("_known").alias("_known"), F.bool_or("_marked").alias("_marked")
    )
    return table.select("_key._word", "_known", "_marked")


def flag_messages(
    messages: DataFrame, vocab: DataFrame, marked: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Messages with at least one marked word whose words are all in the vocabulary.

    `keys` identify a message (for Kafka: topic, partition and offset; copies of a
    text under different keys stay apart). Returns the keys and `employee_id`, the
    sender. A NULL or wordless message is not flagged.
    """
    return flag_listed(messages, word_table(vocab, marked), keys)


def flag_listed(messages: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`flag_messages` with the words of both lists as one `word_table`.

    Every distinct word of a message is looked up in one table of listed words. The
    lookup is a broadcast join while that table is below the session's threshold and
    a shuffled one beyond, with frequent words split by adaptive execution. A word that
    is known and not marked cannot change the verdict, so it goes no further than the
    lookup: the aggregate shuffles marked and unknown words only, and no text.
    """
    ids = [*keys, "employee_id"]
    found = messages.select(
        *keys,
        F.col("sender").alias("employee_id"),
        F.explode(F.array_distinct(words(F.col("message")))).alias("_word"),
    )
    looked_up = found.join(listed, "_word", "left")
    known, hit = F.coalesce("_known", F.lit(False)), F.coalesce("_marked", F.lit(False))
    verdict = (
        looked_up.filter(hit | ~known)
        .groupBy(*ids)
        .agg(F.bool_or(hit).alias("_any_marked"), F.bool_and(known).alias("_all_known"))
    )
    return verdict.filter(F.col("_any_marked") & F.col("_all_known")).select(*ids)


def encode_messages(df: DataFrame) -> DataFrame:
    """Messages with all required fields, as Kafka `key` (sender) and JSON `value`."""
    fields = MESSAGE.fieldNames()
    return df.dropna(subset=fields).select(
        F.col("sender").cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )
