import json
import re

from helpers import plan, rows
from rosterline.functions.text import words
from rosterline.operators import messages

KEYS = ["id"]


def words_df(spark, listed):
    return spark.createDataFrame([(w,) for w in listed], "word string")


def test_words_follow_the_unicode_word_rule(spark):
    texts = ["Hello, wörld_1!", "l'été d'Œuvre", "日本語 text", "a-b c", "", "...", "naïve café", "x²"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.w for r in df.select(words(df.t).alias("w")).collect()]
    assert got == [re.findall(r"\b\w+\b", t.upper()) for t in texts]


def test_parse_messages(spark):
    values = [
        b'{"sender": "a", "receiver": "b", "message": "hi"}',
        b'{"sender": "a"}',
        b"not json",
        None,
    ]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "id int, value binary")
    assert rows(messages.parse_messages(df, keep=["id"])) == [
        (0, "a", "b", "hi"),
        (1, "a", None, None),
        (2, None, None, None),
        (3, None, None, None),
    ]


def test_flag_needs_a_marked_word_and_only_known_words(spark):
    vocab = words_df(spark, ["PAY", "ME", "NOW", "ÉTÉ", "PAY"])
    marked = words_df(spark, ["PAY", "SECRET", "PAY"])
    data = [
        (0, "s0", "pay me"),
        (1, "s1", "me now"),  # nothing marked
        (2, "s2", "pay them"),  # unknown word
        (3, "s3", "secret"),  # marked but unknown
        (4, "s4", None),
        (5, "s5", ""),
        (6, "s6", "Pay, PAY, été!"),
        (7, None, "pay"),
        (8, "s0", "pay me"),  # the same text again is another message
    ]
    df = spark.createDataFrame([(i, s, "r", m) for i, s, m in data], "id int, sender string, receiver string, message string")
    got = messages.flag_messages(df, vocab, marked, KEYS)
    assert rows(got) == [(0, "s0"), (6, "s6"), (7, None), (8, "s0")]


def test_flag_agrees_with_brute_force_and_without_broadcast(spark):
    import random

    rng = random.Random(5)
    listed = [f"W{i}" for i in range(30)]
    vocab, marked = listed[:25], listed[20:28]
    data = [(i, f"s{i % 7}", " ".join(rng.choices(listed, k=rng.randint(0, 6)))) for i in range(300)]
    df = spark.createDataFrame([(i, s, "r", m) for i, s, m in data], "id int, sender string, receiver string, message string")
    want = sorted(
        (
            (i, s)
            for i, s, m in data
            if any(w in marked for w in m.split()) and all(w in vocab for w in m.split())
        ),
        key=repr,
    )
    frames = (words_df(spark, vocab), words_df(spark, marked))
    assert rows(messages.flag_messages(df, *frames, KEYS)) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = messages.flag_messages(df, *frames, KEYS)
        assert "BroadcastHashJoin" not in plan(shuffled)
        assert rows(shuffled) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_text_crosses_the_exchange(spark):
    df = spark.createDataFrame([(1, "s", "r", "pay")], "id int, sender string, receiver string, message string")
    frames = (words_df(spark, ["PAY"]), words_df(spark, ["PAY"]))
    text = plan(messages.flag_messages(df, *frames, KEYS))
    last_exchange = text[: text.index("Exchange hashpartitioning(id")]
    assert "message" not in last_exchange and "partial_bool" not in last_exchange


def test_encode_round_trip(spark):
    df = spark.createDataFrame(
        [("a", "b", 'quote " and\nline é'), (None, "b", "x"), ("a", None, "x"), ("a", "b", None)],
        "sender string, receiver string, message string",
    )
    encoded = messages.encode_messages(df)
    assert encoded.columns == ["key", "value"]
    (row,) = encoded.collect()
    assert row.key == "a"
    assert json.loads(row.value) == {"sender": "a", "receiver": "b", "message": 'quote " and\nline é'}
    assert rows(messages.parse_messages(encoded)) == [("a", "b", 'quote " and\nline é')]
