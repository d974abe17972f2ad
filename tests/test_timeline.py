import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import day, plan, rows
from rosterline import schemas
from rosterline.operators import timeline
from rosterline.operators.cleaning import epoch_to_dates

COLUMNS = ["emp_id", "designation", "start_date", "end_date", "salary", "status"]


def epoch(text):
    return float((day(text) - dt.date(1970, 1, 1)).days * 86_400) if text else None


def raw(spark, data):
    """(emp, designation, start, end, salary) with ISO dates, as a raw load."""
    return spark.createDataFrame(
        [(e, d, epoch(s), epoch(x), p) for e, d, s, x, p in data],
        "emp_id bigint, designation string, start_date double, end_date double, salary double",
    )


def stored(spark, data):
    return spark.createDataFrame(
        [(e, d, day(s), day(x), p, st) for e, d, s, x, p, st in data], schemas.TIMELINE
    )


def nobody(spark):
    return spark.createDataFrame([], "employee_id string")


def build(spark, data):
    return timeline.timeline_build(raw(spark, data), nobody(spark)).select(*COLUMNS)


def test_build_chains_and_ignores_given_ends(spark):
    got = build(
        spark,
        [
            (1, "eng", "2024-01-01", None, 100.0),
            (1, "eng", "2024-01-01", None, 90.0),
            (1, "lead", "2024-03-01", "2024-03-05", 120.0),
            (2, None, "2024-02-01", None, None),
        ],
    )
    assert rows(got) == rows(
        stored(
            spark,
            [
                (1, "eng", "2024-01-01", "2024-03-01", 100.0, "INACTIVE"),
                (1, "lead", "2024-03-01", None, 120.0, "ACTIVE"),
                (2, None, "2024-02-01", None, None, "ACTIVE"),
            ],
        )
    )


def test_build_keep_ends_fills_only_open_ends(spark):
    got = timeline.timeline_build(
        raw(
            spark,
            [
                (1, "a", "2024-01-01", "2024-01-15", 1.0),
                (1, "b", "2024-02-01", None, 2.0),
                (1, "c", "2024-03-01", "2024-04-01", 3.0),
            ],
        ),
        nobody(spark),
        keep_ends=True,
    )
    assert rows(got, "designation", "end_date", "status") == [
        ("a", day("2024-01-15"), "INACTIVE"),
        ("b", day("2024-03-01"), "INACTIVE"),
        ("c", day("2024-04-01"), "INACTIVE"),
    ]


def test_build_drops_struck_employees(spark):
    struck = spark.createDataFrame([("1",), ("1",)], "employee_id string")
    got = timeline.timeline_build(
        raw(spark, [(1, "a", "2024-01-01", None, 1.0), (2, "a", "2024-01-01", None, 1.0)]), struck
    )
    assert rows(got, "emp_id") == [(2,)]


def test_silver_dedupes_by_second_and_keeps_given_ends(spark):
    df = spark.createDataFrame(
        [
            ("1", "a", "0", None, "10.9"),
            ("1", "b", "0", None, "11"),
            ("1", "c", "3600", "100000", "5"),
            ("1", "d", "180000", None, "5"),
            ("x", "e", "10", None, "1"),
        ],
        "emp_id string, designation string, start_date string, end_date string, salary string",
    )
    assert rows(timeline.timeline_silver(df), *COLUMNS) == rows(
        spark.createDataFrame(
            [
                (1, "b", day("1970-01-01"), day("1970-01-01"), 11, "INACTIVE"),
                (1, "c", day("1970-01-01"), day("1970-01-02"), 5, "INACTIVE"),
                (1, "d", day("1970-01-03"), None, 5, "ACTIVE"),
                (None, "e", day("1970-01-01"), None, 1, "ACTIVE"),
            ],
            "emp_id bigint, designation string, start_date date, end_date date, salary bigint, status string",
        )
    )


@pytest.mark.parametrize("operator", [timeline.chain_intervals, timeline.fill_open_end])
def test_sliced_chain_equals_single_window(spark, operator):
    rng = random.Random(7)
    data = [
        (
            rng.choice([1, 1, 1, 2, None]),
            rng.choice([None, *range(1, 40)]),
            rng.choice([None, 5]),
            i,
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "k int, s int, e int, line int")
    plain = operator(df, "k", "s", "e", ["line"])
    for slice_by in (F.col("s"), F.floor(F.col("s") / 7), "s"):
        assert rows(operator(df, "k", "s", "e", ["line"], slice_by)) == rows(plain)


def test_merge_is_idempotent(spark):
    load = [
        (1, "a", "2024-01-01", None, 100.0),
        (1, "b", "2024-02-01", None, 110.0),
        (2, "a", "2024-01-05", None, 90.0),
    ]
    first = build(spark, load)
    once = timeline.timeline_merge(first, build(spark, load))
    assert rows(once) == rows(first)
    assert rows(timeline.timeline_merge(once, build(spark, load))) == rows(first)


def test_merge_backdated_row_splits_an_interval(spark):
    existing = build(spark, [(1, "a", "2024-01-01", None, 1.0), (1, "c", "2024-03-01", None, 3.0)])
    new = build(spark, [(1, "b", "2024-02-01", None, 2.0)])
    assert rows(timeline.timeline_merge(existing, new), "designation", "end_date", "status") == [
        ("a", day("2024-02-01"), "INACTIVE"),
        ("b", day("2024-03-01"), "INACTIVE"),
        ("c", None, "ACTIVE"),
    ]


def test_merge_same_start_leaves_one_zero_length_row(spark):
    existing = build(spark, [(1, "a", "2024-01-01", None, 1.0)])
    new = build(spark, [(1, "b", "2024-01-01", None, 3.0), (1, "z", "2024-05-01", None, 9.0)])
    once = timeline.timeline_merge(existing, new)
    newer = build(spark, [(1, "c", "2024-01-01", None, 2.0)])
    twice = timeline.timeline_merge(once, newer)
    assert rows(twice, "designation", "end_date") == [
        ("b", day("2024-05-01")),
        ("c", day("2024-01-01")),
        ("z", None),
    ]
    assert rows(timeline.timeline_merge(twice, newer)) == rows(twice)


def test_merge_leaves_untouched_employees_as_stored(spark):
    existing = stored(
        spark,
        [
            (1, "a", "2024-01-01", "2024-02-02", 1.0, "INACTIVE"),  # struck out: closed for good
            (2, "a", "2024-01-01", None, 1.0, "ACTIVE"),
        ],
    )
    new = build(spark, [(2, "b", "2024-06-01", None, 2.0), (3, "c", "2024-06-01", None, 3.0)])
    got = timeline.timeline_merge(existing, new)
    assert (1, "a", day("2024-01-01"), day("2024-02-02"), 1.0, "INACTIVE") in rows(got)
    assert len(rows(got)) == 4


def test_merge_properties_on_random_loads(spark):
    rng = random.Random(3)

    def load(n):
        return [
            (rng.randint(1, 6), rng.choice("abc"), f"2024-{rng.randint(1, 12):02d}-01", None, float(rng.randint(1, 5)))
            for _ in range(n)
        ]

    existing = spark.createDataFrame(build(spark, load(30)).collect(), schemas.TIMELINE)
    for _ in range(2):
        new = spark.createDataFrame(build(spark, load(25)).collect(), schemas.TIMELINE)
        existing = spark.createDataFrame(
            timeline.timeline_merge(existing, new).collect(), schemas.TIMELINE
        )
        again = timeline.timeline_merge(existing, new)
        assert rows(again) == rows(existing)
        by_emp = {}
        for r in existing.collect():
            by_emp.setdefault(r.emp_id, []).append(r)
        for chain in by_emp.values():
            assert sum(r.status == "ACTIVE" for r in chain) == 1
            real = sorted((r.start_date, r.end_date) for r in chain if r.end_date and r.end_date > r.start_date)
            assert all(left[1] <= right[0] for left, right in zip(real, real[1:]))


def test_deactivate_changes_only_the_active_row_and_keeps_the_first_date(spark):
    rows_in = [
        (1, "a", "2024-01-01", "2024-02-01", 1.0, "INACTIVE"),
        (1, "b", "2024-02-01", None, 2.0, "ACTIVE"),
        (2, "a", "2024-01-01", None, 1.0, "ACTIVE"),
    ]
    ids = spark.createDataFrame([("1",)], "employee_id string")
    once = timeline.deactivate_ids(stored(spark, rows_in), ids, dt.date(2024, 5, 1))
    want = [
        (1, day("2024-02-01"), "INACTIVE"),
        (1, day("2024-05-01"), "INACTIVE"),
        (2, None, "ACTIVE"),
    ]
    assert rows(once, "emp_id", "end_date", "status") == sorted(want, key=repr)
    later = timeline.deactivate_ids(once, ids, dt.date(2024, 6, 1))
    assert rows(later, "emp_id", "end_date", "status") == sorted(want, key=repr)


def test_build_chains_by_day_in_four_exchanges_besides_the_id_list(spark):
    struck = spark.createDataFrame([("1",)], "employee_id string")
    text = plan(timeline.timeline_build(raw(spark, [(1, "a", "2024-01-01", None, 1.0)]), struck))
    assert text.count("Exchange hashpartitioning(emp_id") == 4 and "_top" in text


def test_rows_without_a_start_leave_one_active_row(spark):
    data = [(1, d, None, None, p, "ACTIVE") for d, p in (("a", 1.0), ("b", 2.0), ("c", 3.0))]
    merged = timeline.rebuild_chain(spark.createDataFrame(data, schemas.TIMELINE))
    assert rows(merged, "designation", "status") == [("c", "ACTIVE")]


def test_epochs_beyond_the_calendar_are_null(spark):
    seconds = [1.7e18, -1.7e18, float("nan"), 0.0, 253402300799.0, 253402300800.0, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seconds)], "i int, s double")
    got = dict(rows(epoch_to_dates(df, ["s"])))
    assert {i: str(d) for i, d in got.items() if d} == {3: "1970-01-01", 4: "9999-12-31"}
