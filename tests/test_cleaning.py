import datetime as dt

from helpers import at, day, rows
from rosterline.operators import cleaning


def test_clean_required(spark):
    df = spark.createDataFrame(
        [
            ("a", 30, 1),
            ("a", 30, 1),
            ("b", 0, 2),
            ("c", -1, 3),
            (None, 5, 4),
            ("d", None, 5),
            ("e", 5, None),
            ("a", 31, 1),
        ],
        "name string, age int, emp_id bigint",
    )
    keys = ["emp_id", "name", "age"]
    assert rows(cleaning.clean_required(df, keys, ["age"], keys)) == [("a", 30, 1), ("a", 31, 1)]


def test_clean_required_on_fewer_keys_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y")], "k int, v int, w string").repartition(2)
    assert rows(cleaning.clean_required(df, ["k"], ["v"], ["k"])) == [(1, 5, "y")]


def test_stamp_load_date_pads(spark):
    df = cleaning.stamp_load_date(spark.range(1), dt.date(2024, 3, 7))
    assert rows(df) == [(0, "2024", "03", "07")]


def test_clean_calendar_drops_header_and_duplicates(spark):
    df = spark.createDataFrame(
        [("reason", None), ("A", at("2024-07-19 00:00:00")), ("A", at("2024-07-19 00:00:00")), ("B", at("2023-12-09 00:00:00"))],
        "reason string, date timestamp_ntz",
    )
    assert rows(cleaning.clean_calendar(df)) == [
        ("A", day("2024-07-19"), 2024),
        ("B", day("2023-12-09"), 2023),
    ]


def test_clean_quota(spark):
    df = spark.createDataFrame(
        [(1, 10, 2024), (1, 10, 2024), (1, 12, 2024), (None, 1, 2024), (2, None, 2024), (3, 0, None), (4, 0, 2024)],
        "emp_id int, leave_quota int, year int",
    )
    assert rows(cleaning.clean_quota(df)) == [(1, 10, 2024), (1, 12, 2024), (4, 0, 2024)]


def test_epoch_to_dates_ignores_the_time_zone(spark):
    df = spark.createDataFrame(
        [(0.0,), (86_399.0,), (86_400.0,), (-1.0,), (1_714_521_600.9,), (None,)], "d double"
    )
    want = ["1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31", "2024-05-01", None]
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [r.d for r in cleaning.epoch_to_dates(df, ["d"]).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [day(w) for w in want]
