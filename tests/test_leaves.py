import datetime as dt
import random

from helpers import at, day, plan, rows
from rosterline.operators import leaves

SCHEMA = "emp_id bigint, date date, status string"


def test_weekends_and_null_dates_drop(spark):
    df = spark.createDataFrame(
        [(1, day(d), "ACTIVE") for d in ("2024-05-03", "2024-05-04", "2024-05-05", "2024-05-06", None)], SCHEMA
    )
    assert rows(leaves.drop_weekends(df), "date") == [(day("2024-05-03"),), (day("2024-05-06"),)]


def test_holidays_match_dates_and_timestamps(spark):
    df = spark.createDataFrame([(1, day("2024-07-19"), "ACTIVE"), (1, day("2024-07-22"), "ACTIVE")], SCHEMA)
    calendar = spark.createDataFrame(
        [(at("2024-07-19 00:00:00"),), (at("2024-07-19 00:00:00"),), (None,)], "date timestamp_ntz"
    )
    kept = leaves.drop_holidays(df, calendar)
    assert rows(kept, "date") == [(day("2024-07-22"),)]
    assert "Exchange hashpartitioning(emp_id" not in plan(kept)


def test_keep_active_across_key_types(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",)], "emp_id string")
    timeline = spark.createDataFrame(
        [(1, "ACTIVE"), (1, "ACTIVE"), (2, "INACTIVE")], "emp_id bigint, status string"
    )
    assert rows(leaves.keep_active(df, timeline)) == [("1",)]


def events(spark, data):
    return spark.createDataFrame(
        [(e, day(d), s, f"{i:02d}", at(f"2024-01-01 00:{i:02d}:00")) for i, (e, d, s) in enumerate(data)],
        SCHEMA + ", ingest_date string, ingest_timestamp timestamp_ntz",
    )


VOTES = [
    (1, "2024-05-03", "ACTIVE"),
    (1, "2024-05-03", "CANCELLED"),  # tie: cancelled
    (2, "2024-05-03", "ACTIVE"),
    (2, "2024-05-03", "ACTIVE"),
    (2, "2024-05-03", "CANCELLED"),  # majority for the leave
    (3, "2024-05-03", "PENDING"),  # no vote: cancelled, and no row says so
    (4, "2024-05-03", "CANCELLED"),
    (4, "2024-05-06", "ACTIVE"),
]


def test_verdict(spark):
    assert rows(leaves.leave_verdict(events(spark, VOTES))) == [
        (1, day("2024-05-03"), 1, 1, "CANCELLED"),
        (2, day("2024-05-03"), 1, 2, "ACTIVE"),
        (3, day("2024-05-03"), 0, 0, "CANCELLED"),
        (4, day("2024-05-03"), 1, 0, "CANCELLED"),
        (4, day("2024-05-06"), 0, 1, "ACTIVE"),
    ]


def test_settle_keeps_the_newest_row_of_the_winning_status(spark):
    got = leaves.settle(events(spark, VOTES))
    assert rows(got, "emp_id", "date", "status", "ingest_date") == [
        (1, day("2024-05-03"), "CANCELLED", "01"),
        (2, day("2024-05-03"), "ACTIVE", "03"),
        (4, day("2024-05-03"), "CANCELLED", "06"),
        (4, day("2024-05-06"), "ACTIVE", "07"),
    ]


def test_settle_against_brute_force(spark):
    rng = random.Random(11)
    data = [
        (rng.randint(1, 4), f"2024-05-0{rng.randint(1, 9)}", rng.choice(["ACTIVE", "CANCELLED", "PENDING", None]))
        for _ in range(59)
    ]
    groups = {}
    for i, (e, d, s) in enumerate(data):
        groups.setdefault((e, d), []).append((i, s))
    want = []
    for (e, d), seen in groups.items():
        statuses = [s for _, s in seen]
        final = "CANCELLED" if statuses.count("CANCELLED") >= statuses.count("ACTIVE") else "ACTIVE"
        hits = [i for i, s in seen if s == final]
        if hits:
            want.append((e, day(d), final, f"{max(hits):02d}"))
    got = leaves.settle(events(spark, data))
    assert rows(got, "emp_id", "date", "status", "ingest_date") == sorted(want, key=repr)


def test_settle_is_one_exchange_without_join_or_window(spark):
    text = plan(leaves.settle(events(spark, VOTES)))
    assert text.count("Exchange") == 1 and "Join" not in text and "Window" not in text


def test_ledger_counts_votes_of_history_with_partition_columns(spark):
    raw = leaves.with_ingest(
        spark.createDataFrame(
            [
                (1, day("2024-05-03"), "CANCELLED"),
                (1, day("2024-05-04"), "ACTIVE"),  # Saturday
                (1, day("2024-05-06"), "ACTIVE"),  # holiday
                (9, day("2024-05-03"), "ACTIVE"),  # not employed
                (2, day("2024-05-07"), "ACTIVE"),
            ],
            SCHEMA,
        ),
        dt.datetime(2024, 5, 2, 8, 0),
    )
    calendar = spark.createDataFrame([(day("2024-05-06"),)], "date date")
    timeline = spark.createDataFrame([(1, "ACTIVE"), (2, "ACTIVE"), (9, "INACTIVE")], "emp_id bigint, status string")
    history = leaves.with_ingest(
        spark.createDataFrame([(1, day("2024-05-03"), "ACTIVE"), (1, day("2024-05-03"), "ACTIVE")], SCHEMA),
        dt.datetime(2024, 5, 1, 8, 0),
    ).selectExpr("*", "year(date) AS year", "month(date) AS month")
    got = leaves.leave_ledger(raw, calendar, timeline, history)
    assert rows(got, "emp_id", "date", "status", "ingest_date", "year", "month") == [
        (1, day("2024-05-03"), "ACTIVE", "2024-05-01", 2024, 5),
        (2, day("2024-05-07"), "ACTIVE", "2024-05-02", 2024, 5),
    ]
