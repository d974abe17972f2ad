import datetime as dt
import os

from helpers import day, rows
from rosterline import schemas
from rosterline.operators.strikes import strike_decay
from rosterline.plans import jobs
from rosterline.sources import files

SECONDS = 86_400


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def epoch(text):
    return (day(text) - dt.date(1970, 1, 1)).days * SECONDS


def test_load_employees(spark, folder):
    source, table = folder + "/raw", folder + "/employees"
    put(source, "a.csv", "name,age,emp_id", "ann,30,1", "ann,30,1", "bob,0,2", "cy,x,3")
    seen = []
    for _ in range(2):  # the same day again replaces that day
        assert jobs.load_employees(spark, source, table, dt.date(2024, 5, 1), lambda df: seen.append(rows(df)))
    assert seen == [[(1, "ann", 30)]] * 2
    assert spark.read.parquet(table).count() == 1
    assert os.path.isdir(f"{table}/year=2024/month=05/day=01")
    put(folder + "/bad", "a.csv", "name,age,emp_id", "bob,0,2")
    assert jobs.load_employees(spark, folder + "/bad", table, dt.date(2024, 5, 2), lambda df: seen.append(rows(df)))
    assert seen[-1] == []


def test_a_corrected_load_replaces_the_day(spark, folder):
    table, day_one = folder + "/employees", dt.date(2024, 5, 1)
    put(folder + "/first", "a.csv", "name,age,emp_id", "ann,30,1", "bob,40,2")
    put(folder + "/other", "a.csv", "name,age,emp_id", "cy,50,3")
    put(folder + "/fewer", "a.csv", "name,age,emp_id", "bob,40,2")
    put(folder + "/none", "a.csv", "name,age,emp_id", "bob,0,2")
    jobs.load_employees(spark, folder + "/other", table, dt.date(2024, 4, 30))
    for source, want in (("first", [(1,), (2,), (3,)]), ("fewer", [(2,), (3,)]), ("none", [(3,)])):
        handed = []
        jobs.load_employees(spark, f"{folder}/{source}", table, day_one, lambda df, to=handed: to.extend(rows(df, "emp_id")))
        assert rows(spark.read.parquet(table), "emp_id") == want
        assert sorted([*handed, (3,)]) == want


def test_a_corrected_leave_load_withdraws_months(spark, folder):
    calendar = spark.createDataFrame([], "date date")
    timeline = spark.createDataFrame([(1, "ACTIVE")], "emp_id bigint, status string")
    events, ledger, at = folder + "/events", folder + "/ledger", dt.datetime(2024, 4, 1, 7)
    put(folder + "/d0", "a.csv", "emp_id,date,status", "1,2024-07-01,ACTIVE", "1,2024-06-03,ACTIVE")
    jobs.refresh_leaves(spark, folder + "/d0", calendar, timeline, events, ledger, dt.datetime(2024, 3, 1, 7))
    loads = {
        "both": ["1,2024-05-02,ACTIVE", "1,2024-06-04,ACTIVE", "1,2024-06-03,CANCELLED"],
        "may": ["1,2024-05-02,ACTIVE"],
        "nobody": ["9,2024-05-02,ACTIVE"],
    }
    want = {
        "both": [("2024-05-02", "ACTIVE"), ("2024-06-03", "CANCELLED"), ("2024-06-04", "ACTIVE"), ("2024-07-01", "ACTIVE")],
        "may": [("2024-05-02", "ACTIVE"), ("2024-06-03", "ACTIVE"), ("2024-07-01", "ACTIVE")],
        "nobody": [("2024-06-03", "ACTIVE"), ("2024-07-01", "ACTIVE")],
    }
    for name, lines in loads.items():
        put(f"{folder}/{name}", "a.csv", "emp_id,date,status", *lines)
        jobs.refresh_leaves(spark, f"{folder}/{name}", calendar, timeline, events, ledger, at)
        stored = files.read_or_empty(spark, ledger, schemas.LEAVE_LEDGER)
        assert [(str(d), s) for d, s in rows(stored, "date", "status")] == want[name]


def test_a_corrected_quota_withdraws_texts(spark, folder):
    leave = spark.createDataFrame([(1, "ACTIVE", 2024, 5)] * 9, "emp_id bigint, status string, year int, month int")
    for quota in (10, 100):
        jobs.report_quota(
            spark,
            leave,
            spark.createDataFrame([(1, quota, 2024)], schemas.QUOTA),
            *[f"{folder}/{name}" for name in ("usage", "tracking", "texts")],
            2024,
            12,
            dt.date(2024, 5, 31),
        )
        texts = spark.read.text(f"{folder}/texts/run_date=2024-05-31").collect()
        assert bool(texts) == (quota == 10)
        assert spark.read.schema(schemas.ALERTED).parquet(f"{folder}/tracking").count() == (quota == 10)


def test_targets_are_merged_as_versions(spark, folder):
    def load(version, previous, *data):
        rows_in = spark.createDataFrame(
            [(e, d, day(s), None, p, "ACTIVE") for e, d, s, p in data], schemas.TIMELINE
        )
        jobs.merge_into_target(spark, rows_in, folder + "/target", version, previous)
        return rows(
            spark.read.schema(schemas.TIMELINE).parquet(f"{folder}/target/version={version}"),
            "emp_id", "designation", "salary",
        )

    assert load("1", None, (1, "eng", "2024-01-01", 1.0), (2, "ops", "2024-01-01", 2.0)) == [(1, "eng", 1.0), (2, "ops", 2.0)]
    got = load("2", "1", (1, None, "2024-01-01", 9.0), (3, "hr", "2024-01-01", 3.0))
    assert got == [(1, "eng", 9.0), (2, "ops", 2.0), (3, "hr", 3.0)]


def test_headcounts_are_merged_by_designation(spark, folder):
    def load(version, previous, *designations):
        timeline = spark.createDataFrame(
            [(i, d, "ACTIVE") for i, d in enumerate(designations)], "emp_id bigint, designation string, status string"
        )
        jobs.merge_headcount(spark, timeline, folder + "/heads", version, previous)
        return rows(spark.read.parquet(f"{folder}/heads/version={version}"), "designation", "active_employees")

    assert load("1", None, "eng", "eng", "ops") == [("eng", 2), ("ops", 1)]
    assert load("2", "1", "eng", "hr") == [("eng", 1), ("hr", 1), ("ops", 1)]


def test_empty_input_is_skipped(spark, folder):
    put(folder + "/raw", "a.csv", "name,age,emp_id")
    assert not jobs.load_employees(spark, folder + "/raw", folder + "/t", dt.date(2024, 5, 1))
    assert not os.path.exists(folder + "/t")


def test_load_calendar_and_quota_twice(spark, folder):
    put(folder + "/cal", "a.csv", "reason,date", "A,2024-7-19", "B,2023-12-09")
    put(folder + "/quota", "a.csv", "emp_id,leave_quota,year", "1,10,2024", "1,10,2024", "2,,2024")
    for _ in range(2):
        assert jobs.load_calendar(spark, folder + "/cal", folder + "/calendar")
        assert jobs.load_quota(spark, folder + "/quota", folder + "/quotas")
    calendar = files.read_or_empty(spark, folder + "/calendar", schemas.CALENDAR)
    assert rows(calendar, "reason", "date") == [("A", day("2024-07-19")), ("B", day("2023-12-09"))]
    assert rows(files.read_or_empty(spark, folder + "/quotas", schemas.QUOTA)) == [(1, 10, 2024)]


def test_timeline_and_strikes_over_several_days(spark, folder):
    source, root = folder + "/raw", folder + "/timeline"
    header = "emp_id,designation,start_date,end_date,salary"
    put(source, "1.csv", header, f"1,eng,{epoch('2024-01-01')},,100", f"2,ops,{epoch('2024-01-01')},,50")
    struck = spark.createDataFrame([], schemas.STRUCK)
    assert jobs.refresh_timeline(spark, source, struck, root, "d1", None, dt.date(2024, 5, 1))
    put(source, "2.csv", header, f"1,lead,{epoch('2024-03-01')},,120", f"3,ops,{epoch('2024-03-01')},,55")
    struck = spark.createDataFrame([("2",)], schemas.STRUCK)
    seen = []
    assert jobs.refresh_timeline(
        spark, source, struck, root, "d2", "d1", dt.date(2024, 5, 2), lambda df: seen.append(df)
    )
    want = [
        (1, "eng", day("2024-01-01"), day("2024-03-01"), 100.0, "INACTIVE"),
        (1, "lead", day("2024-03-01"), None, 120.0, "ACTIVE"),
        (2, "ops", day("2024-01-01"), day("2024-05-02"), 50.0, "INACTIVE"),
        (3, "ops", day("2024-03-01"), None, 55.0, "ACTIVE"),
    ]
    assert rows(seen[0]) == want
    # A day later nothing new arrived: nothing moves, not even the strike-out date.
    jobs.refresh_timeline(spark, source, struck, root, "d3", "d2", dt.date(2024, 5, 3), lambda df: seen.append(df))
    assert rows(seen[1]) == want

    states = []
    jobs.sync_strikes(spark, seen[1], folder + "/strikes", "d3", None, lambda df: states.append(df))
    assert rows(states[0], "employee_id", "salary", "no_of_strikes") == [("1", 120.0, 0), ("3", 55.0, 0)]
    raised = seen[1].replace(120.0, 130.0, ["salary"])
    jobs.sync_strikes(spark, raised, folder + "/strikes", "d4", "d3", lambda df: states.append(df))
    assert rows(states[1], "employee_id", "salary") == [("1", 130.0), ("3", 55.0)]

    jobs.report_headcount(seen[1], folder + "/heads", dt.date(2024, 5, 3))
    jobs.report_headcount(seen[1], folder + "/heads", dt.date(2024, 5, 4))
    assert rows(spark.read.parquet(folder + "/heads"), "designation", "active_employees").count(("ops", 1)) == 2


def test_leaves_to_reports(spark, folder):
    calendar = spark.createDataFrame([(day("2024-05-06"),)], "date date")
    timeline = spark.createDataFrame([(1, "ACTIVE"), (2, "ACTIVE")], "emp_id bigint, status string")
    events, ledger = folder + "/events", folder + "/ledger"

    def load(name, at, *lines):
        source = f"{folder}/{name}"
        put(source, "a.csv", "emp_id,date,status", *lines)
        for _ in range(2):  # loading a day twice counts its votes once
            assert jobs.refresh_leaves(spark, source, calendar, timeline, events, ledger, at)
        return rows(files.read_or_empty(spark, ledger, schemas.LEAVE_LEDGER), "emp_id", "date", "status", "ingest_date")

    first = load(
        "d1",
        dt.datetime(2024, 4, 1, 7),
        "1,2024-05-02,ACTIVE",
        "1,2024-05-03,ACTIVE",
        "1,2024-05-04,ACTIVE",
        "1,2024-05-06,ACTIVE",
        "2,2024-06-03,ACTIVE",
        "9,2024-05-02,ACTIVE",
    )
    assert first == [
        (1, day("2024-05-02"), "ACTIVE", "2024-04-01"),
        (1, day("2024-05-03"), "ACTIVE", "2024-04-01"),
        (2, day("2024-06-03"), "ACTIVE", "2024-04-01"),
    ]
    second = load("d2", dt.datetime(2024, 4, 2, 7), "1,2024-05-03,CANCELLED")
    assert second == [
        (1, day("2024-05-02"), "ACTIVE", "2024-04-01"),
        (1, day("2024-05-03"), "CANCELLED", "2024-04-02"),
        (2, day("2024-06-03"), "ACTIVE", "2024-04-01"),
    ]

    stored = files.read_or_empty(spark, ledger, schemas.LEAVE_LEDGER)
    quota = spark.createDataFrame([(1, 1, 2024), (2, 10, 2024)], schemas.QUOTA)

    def alert(run):
        jobs.report_quota(
            spark, stored, quota, folder + "/usage", folder + "/tracking", folder + "/alerts", 2024, 12, run
        )
        path = f"{folder}/alerts/run_date={run}"
        return "".join(r.value for r in spark.read.text(path).collect()) if os.path.isdir(path) else ""

    for _ in range(2):
        assert "Employee ID: 1" in alert(dt.date(2024, 5, 1))
    assert alert(dt.date(2024, 5, 2)) == ""  # alerted the day before
    assert rows(spark.read.parquet(folder + "/tracking"), "emp_id") == [(1,)]

    jobs.report_upcoming(stored, calendar, folder + "/upcoming", dt.date(2024, 5, 1), pct=1)
    assert rows(spark.read.parquet(folder + "/upcoming"), "emp_id", "upcoming_leaves_count") == [(1, 2)]


def test_strike_decay(spark, folder):
    strikes = spark.createDataFrame(
        [("a", 1000.0, 900.0, 810.0, *[None] * 8, 2), ("b", 1000.0, 900.0, *[None] * 9, 1), ("c", 1.0, *[None] * 10, 0)],
        schemas.STRIKES,
    )
    flags = spark.createDataFrame(
        [("a", "2024-01-30"), ("b", "2023-01-01")], "employee_id string, start_date string"
    ).selectExpr("employee_id", "cast(start_date AS timestamp) AS start_date")
    got = strike_decay(strikes, flags, dt.datetime(2024, 1, 31))
    assert rows(got) == [("a", 1000.0, 900.0, *[None] * 9, 1), ("b", 1000.0, *[None] * 10, 0)]
