"""Strikes as keyed state: late and repeated flags, expiry by timers, restart."""

import datetime as dt
import json
import os
import random
from collections import Counter

from pyspark.sql import functions as F

from helpers import rows
from rosterline import schemas
from rosterline.operators.strikes import strike_standing
from rosterline.streaming.keyed_strikes import (
    current_strikes,
    most_within,
    read_flags,
    start_flag_stream,
    start_keyed_strikes,
)

STEPS = [None] * 10
START = dt.datetime(2024, 1, 1)


def seed_rows(spark, *names):
    return spark.createDataFrame([(n, 1000.0, *STEPS, 0) for n in names], schemas.STRIKES)


class Stream:
    """A folder of flags, and a keyed stream that takes what is new on each run."""

    def __init__(self, spark, folder, strikes, delay="2 days"):
        self.spark, self.folder, self.strikes, self.delay = spark, folder, strikes, delay
        self.sent = 0
        os.makedirs(f"{folder}/flags")

    def run(self, *flags, restart=True):
        """`flags` are (position, employee, day); one file each run."""
        if flags:
            lines = [(p, e, str(START + dt.timedelta(days=d))) for p, e, d in flags]
            df = self.spark.createDataFrame(lines, "id long, employee_id string, start_date string")
            df.withColumn("start_date", F.col("start_date").cast("timestamp")).coalesce(1).write.parquet(
                f"{self.folder}/flags/batch={self.sent}"
            )
            self.sent += 1
        stream = read_flags(self.spark, f"{self.folder}/flags", "id long")
        query = start_keyed_strikes(
            stream, self.strikes, f"{self.folder}/changes", f"{self.folder}/cp", ["id"], self.delay, None
        )
        query.awaitTermination()
        return {r[0]: r[1] for r in rows(self.now(), "employee_id", "no_of_strikes")}

    def now(self):
        return current_strikes(self.spark, f"{self.folder}/changes", self.strikes)


def test_most_flags_within_a_span():
    assert most_within(Counter(), 5) == 0
    assert most_within(Counter([1, 6, 7, 12]), 5) == 2
    assert most_within(Counter({3: 4, 8: 1, 9: 2}), 5) == 5


def test_strikes_rise_expire_and_survive_a_restart(spark, folder):
    stream = Stream(spark, folder, seed_rows(spark, "a", "b", "c"))
    assert stream.run((1, "a", 0), (2, "a", 5), (3, "b", 5)) == {"a": 2, "b": 1, "c": 0}
    # The clock moves to day 33: a's first flag has expired, nobody called for it.
    assert stream.run((4, "c", 35)) == {"a": 1, "b": 1, "c": 1}
    # Day 48: all flags of day 5 are gone.
    assert stream.run((5, "c", 50)) == {"a": 0, "b": 0, "c": 2}
    assert rows(stream.now().filter("employee_id = 'c'"), "strike_1", "strike_2", "strike_3") == [(900.0, 810.0, None)]


def test_late_flags_are_left_out_and_repeats_count_once(spark, folder):
    stream = Stream(spark, folder, seed_rows(spark, "a", "b"))
    assert stream.run((1, "a", 10), (2, "b", 9)) == {"a": 1, "b": 1}
    # The clock stands at day 8: day 7 is late, day 9 is not; records 1 and 2 come again.
    assert stream.run((1, "a", 10), (2, "b", 9), (3, "a", 7), (4, "b", 9)) == {"a": 1, "b": 2}


def test_without_the_late_rule_the_result_differs(spark, folder):
    flags = [(1, "a", 10)], [(2, "a", 7)]
    strict = Stream(spark, f"{folder}/strict", seed_rows(spark, "a"))
    lenient = Stream(spark, f"{folder}/lenient", seed_rows(spark, "a"), delay="10 days")
    for part in flags:
        results = strict.run(*part), lenient.run(*part)
    assert results == ({"a": 1}, {"a": 2})


def test_struck_out_employees_stay_struck_out(spark, folder):
    stream = Stream(spark, folder, seed_rows(spark, "a", "b"))
    ten = [(i, "a", 1) for i in range(10)] + [(20 + i, "b", 4 * i) for i in range(10)]
    # b has ten flags as well, but no more than eight within thirty days, nine since day 4.
    assert stream.run(*ten) == {"a": 10, "b": 9}
    assert stream.run((50, "b", 90)) == {"a": 10, "b": 1}


def test_flags_nobody_owns(spark, folder):
    stream = Stream(spark, folder, seed_rows(spark, "a"))
    assert stream.run((1, None, 1), (2, "stranger", 1), (3, "a", 1)) == {"a": 1}


def test_stream_equals_the_batch_form(spark, folder):
    """Flags in any order within the delay, over many batches, with many at one instant."""
    rng = random.Random(3)
    flags = []
    for i in range(400):
        day = rng.randint(0, 79)
        employee = rng.choice(["hot"] * 4 + [f"e{k}" for k in range(25)])
        flags.append((i, employee, day))
    flags += [(1000 + i, "burst", 30) for i in range(2500)]
    flags.sort(key=lambda f: f[2] + rng.uniform(0, 1.9))
    names = ["hot", "burst", "quiet", *[f"e{k}" for k in range(25)]]
    stream = Stream(spark, folder, seed_rows(spark, *names))
    for i in range(0, len(flags), 800):
        stream.run(*flags[i : i + 800])
    whole = spark.createDataFrame(
        [(e, START + dt.timedelta(days=d)) for _, e, d in flags], schemas.FLAG
    )
    clock = START + dt.timedelta(days=max(d for _, _, d in flags) - 2)
    want = strike_standing(stream.strikes, whole, clock)
    assert rows(stream.now(), *want.columns) == rows(want)


def test_messages_to_strikes(spark, folder):
    """Two queries: messages to flags with their records, flags to strikes."""
    source = f"{folder}/in"
    os.makedirs(source)
    words = spark.createDataFrame([("PAY",)], "word string")
    strikes = seed_rows(spark, "a", "b")

    def run(name, *sent):
        with open(f"{source}/{name}.json", "w") as out:
            for i, who, text, day in sent:
                value = json.dumps({"sender": who, "receiver": "r", "message": text})
                out.write(json.dumps({"id": i, "at": f"2024-01-{day:02} 00:00:00", "value": value}) + "\n")
        stream = spark.readStream.schema("id long, at timestamp, value string").json(source)
        start_flag_stream(
            stream, words, words, f"{folder}/flags", f"{folder}/cp1", ["id"], "at", interval=None
        ).awaitTermination()
        start_keyed_strikes(
            read_flags(spark, f"{folder}/flags", "id long"), strikes, f"{folder}/changes", f"{folder}/cp2", ["id"], interval=None
        ).awaitTermination()
        return rows(current_strikes(spark, f"{folder}/changes", strikes), "employee_id", "no_of_strikes")

    assert run("1", (1, "a", "pay", 5), (2, "b", "hello", 5)) == [("a", 1), ("b", 0)]
    assert run("2", (1, "a", "pay", 5), (3, "b", "PAY", 5), (4, "a", "pay", 1)) == [("a", 1), ("b", 1)]
