import datetime as dt
import random

from helpers import at, rows
from rosterline import schemas
from rosterline.operators import strikes
from rosterline.schemas import STRIKE_STEPS

NOW = dt.datetime(2024, 1, 31)


def strike_rows(spark, data):
    """(id, salary, known steps, count) as a strike table."""
    return spark.createDataFrame(
        [(e, s, *known, *[None] * (10 - len(known)), n) for e, s, known, n in data], schemas.STRIKES
    )


def counts(spark, data):
    return spark.createDataFrame(data, "employee_id string, strike_count bigint")


def flags(spark, data):
    return spark.createDataFrame([(e, at(t)) for e, t in data], "employee_id string, start_date timestamp_ntz")


def prices(salary, upto):
    from decimal import ROUND_HALF_UP, Decimal

    cents = Decimal("0.01")
    return [
        float((Decimal(str(salary)) * Decimal("0.9") ** i).quantize(cents, ROUND_HALF_UP)) if i <= upto else None
        for i in range(1, 11)
    ]


def test_rolling_count_includes_exactly_thirty_days(spark):
    known = flags(
        spark,
        [("a", "2024-01-01 00:00:00"), ("a", "2023-12-31 23:59:59"), ("a", "2024-01-30 00:00:00"), ("b", "2023-12-01 00:00:00")],
    )
    assert rows(strikes.rolling_flag_count(known, NOW)) == [("a", 2)]


def test_aware_and_naive_times_agree(spark):
    known = flags(spark, [("a", "2024-01-01 00:00:00")])
    aware = NOW.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=9)))
    assert rows(strikes.rolling_flag_count(known, aware)) == [("a", 1)]


def test_trailing_count_against_brute_force(spark):
    rng = random.Random(2)
    data = [
        (rng.choice("aab"), f"2024-0{rng.randint(1, 3)}-{rng.choice([1, 5, 5, 28]):02d} {rng.choice([0, 0, 12]):02d}:00:00")
        for _ in range(80)
    ]
    span = dt.timedelta(days=30)
    want = sorted(
        ((e, at(t), sum(x == e and at(t) - span <= at(u) <= at(t) for x, u in data)) for e, t in data), key=repr
    )
    assert rows(strikes.trailing_flag_count(flags(spark, data))) == want


def test_full_ladder(spark):
    table = strike_rows(spark, [("a", 1000.0, [], 0), ("b", 999.99, [1.0], 5), ("c", 5.0, [], None)])
    got = strikes.strike_ladder_full(table, counts(spark, [("a", 3), ("b", 12), ("z", 1)]))
    assert rows(got) == [("a", 1000.0, *prices(1000, 3), 3), ("b", 999.99, *prices(999.99, 10), 10)]
    assert rows(got)[0][2:5] == (900.0, 810.0, 729.0)


def test_incremental_ladder_keeps_stored_steps(spark):
    table = strike_rows(
        spark, [("a", 2000.0, [900.0, 810.0], 2), ("b", 1000.0, [900.0, 810.0, 729.0], 3), ("c", 1000.0, [], None)]
    )
    got = strikes.strike_ladder_incremental(table, counts(spark, [("a", 3), ("b", 1), ("c", 2)]))
    fresh = prices(2000, 3)
    assert rows(got) == [
        ("a", 2000.0, 900.0, 810.0, *fresh[2:], 3),
        ("b", 1000.0, 900.0, *[None] * 9, 1),
        ("c", 1000.0, *prices(1000, 2), 2),
    ]


def test_jump_past_the_cap_strikes_out(spark):
    table = strike_rows(spark, [("a", 1000.0, prices(1000, 9)[:9], 9), ("b", 1000.0, prices(1000, 10), 10)])
    changed = strikes.strike_updates(table, counts(spark, [("a", 12), ("b", 2)]))
    assert rows(changed) == [("a", 1000.0, *prices(1000, 10), 10)]
    assert rows(strikes.newly_capped(changed)) == [("a",)]


def test_drop_capped(spark):
    table = strike_rows(spark, [("a", 1.0, [], 10), ("b", 1.0, [], 9), ("c", 1.0, [], None), ("d", 1.0, [], 11)])
    got = strikes.drop_capped(counts(spark, [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]), table)
    assert rows(got, "employee_id") == [("b",), ("c",), ("e",)]


def test_updates_leave_out_unchanged_rows(spark):
    table = strike_rows(spark, [("a", 1000.0, prices(1000, 3)[:3], 3), ("b", 1000.0, prices(1000, 3)[:3], 3)])
    got = strikes.strike_updates(table, counts(spark, [("a", 3), ("b", 2)]))
    assert rows(got) == [("b", 1000.0, *prices(1000, 2), 2)]


def test_sync_salaries(spark):
    timeline = spark.createDataFrame(
        [
            (1, 1000.0, "ACTIVE"),
            (2, 500.0, "ACTIVE"),
            (2, 600.0, "ACTIVE"),  # two open rows: the best paid counts
            (3, 700.0, "ACTIVE"),
            (4, 800.0, "INACTIVE"),
            (5, None, "ACTIVE"),
            (6, 10.0, "ACTIVE"),
        ],
        "emp_id bigint, salary double, status string",
    )
    table = strike_rows(
        spark,
        [("1", 1000.0, [900.0], 1), ("2", 500.0, [450.0], 1), ("5", 50.0, [45.0], 1), ("6", None, [], None)],
    )
    assert rows(strikes.sync_salaries(timeline, table)) == [
        ("2", 600.0, *prices(600, 1), 1),
        ("3", 700.0, *[None] * 10, 0),
        ("5", None, *[None] * 10, 1),
        ("6", 10.0, *[None] * 10, 0),
    ]


def test_steps_are_doubles_with_two_decimals(spark):
    got = strikes.strike_ladder_full(strike_rows(spark, [("a", 0.05, [], 0)]), counts(spark, [("a", 10)]))
    assert dict(got.dtypes)["strike_1"] == "double"
    assert rows(got, *STRIKE_STEPS) == [tuple(prices("0.05", 10))]
