"""Jobs read their source once; whether there is input comes from the write."""

import datetime as dt
import os
import re

import pytest

from helpers import rows
from rosterline import schemas
from rosterline.plans import jobs
from rosterline.sources import sinks
from rosterline.sources.versions import VersionedTable
from test_jobs import put

AT = dt.date(2024, 5, 1)
HEADERS = {
    "employees": "name,age,emp_id",
    "quota": "emp_id,leave_quota,year",
    "calendar": "reason,date",
    "timeline": "emp_id,designation,start_date,end_date,salary",
    "touched": "emp_id,designation,start_date,end_date,salary",
    "leaves": "emp_id,date,status",
    "votes": "emp_id,date,status",
}
LINES = {
    "employees": ["ann,30,1", "bob,40,2"],
    "quota": ["1,10,2024", "2,20,2024"],
    "calendar": ["A,2024-7-19"],
    "timeline": ["1,eng,1700000000,,100", "1,lead,1710000000,,120"],
    "touched": ["1,eng,1700000000,,100", "1,lead,1710000000,,120"],
    "leaves": ["1,2024-05-02,ACTIVE", "1,2024-05-03,ACTIVE"],
    "votes": ["1,2024-05-02,ACTIVE", "1,2024-05-03,ACTIVE"],
}


def run(spark, job, source, folder):
    table, at = f"{folder}/{job}", dt.datetime(2024, 4, 1, 7)
    struck = spark.createDataFrame([], schemas.STRUCK)
    calendar = spark.createDataFrame([], "date date")
    active = spark.createDataFrame([(1, "ACTIVE")], "emp_id bigint, status string")
    if job == "employees":
        return jobs.load_employees(spark, source, table, AT)
    if job == "quota":
        return jobs.load_quota(spark, source, table)
    if job == "calendar":
        return jobs.load_calendar(spark, source, table)
    if job == "timeline":
        return jobs.refresh_timeline(spark, source, struck, table, "1", None, AT)
    if job == "leaves":
        return jobs.refresh_leaves(spark, source, calendar, active, f"{table}/events", f"{table}/ledger", at)
    read = spark.read.option("header", True)
    if job == "touched":
        stored = VersionedTable(table, schemas.TIMELINE, "emp_id", 4)
        return jobs.refresh_touched(read.schema(schemas.TIMEFRAME_RAW).csv(source), struck, stored, "1", AT)
    ledger = VersionedTable(f"{table}/ledger", schemas.LEAVE_LEDGER, "emp_id", 4)
    raw = read.schema(schemas.LEAVE_RAW).csv(source)
    return jobs.refresh_leave_votes(raw, calendar, active, f"{table}/votes", ledger, at)


def csv_scans(spark, since):
    """Scans of CSV in the final plans of all executions from the id `since` on, and the next id.

    Spark keeps the latest executions only, so after many tests their number stays the same.
    """
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    kept = {e.executionId(): e for e in (found.apply(i) for i in range(found.size()))}
    texts = [e.physicalPlanDescription() for i, e in kept.items() if i >= since]
    final = [text.split("== Initial Plan ==")[0] for text in texts]
    return sum(len(re.findall(r"^[^(\n]*Scan csv", text, re.M)) for text in final), max(kept, default=-1) + 1


@pytest.mark.parametrize("job", HEADERS)
def test_a_source_is_scanned_once(spark, folder, job):
    put(f"{folder}/raw", "a.csv", HEADERS[job], *LINES[job])
    before = csv_scans(spark, 0)[1]
    assert run(spark, job, f"{folder}/raw", folder)
    assert csv_scans(spark, before)[0] == 1


@pytest.mark.parametrize("job", HEADERS)
def test_without_input_nothing_changes(spark, folder, job):
    put(f"{folder}/raw", "a.csv", HEADERS[job], *LINES[job])
    put(f"{folder}/none", "a.csv", *([] if job == "calendar" else [HEADERS[job]]))

    def data():
        found = [(base, name) for base, _, names in os.walk(f"{folder}/{job}") for name in names]
        return sorted((b, n, os.path.getmtime(f"{b}/{n}")) for b, n in found if n.startswith("part-") and "_staging" not in b)

    assert not run(spark, job, f"{folder}/none", folder)
    assert data() == []
    run(spark, job, f"{folder}/raw", folder)
    stored = data()
    assert stored
    assert not run(spark, job, f"{folder}/none", folder)
    assert data() == stored


@pytest.mark.parametrize("by", [(), ("k",)])
def test_writes_count_their_rows(spark, folder, by):
    df = spark.range(1000, numPartitions=7).selectExpr("id", "id % 3 AS k")
    assert sinks.overwrite_parquet(df, folder + "/t", by) == 1000
    assert sinks.append_parquet(df.filter("id < 10"), folder + "/t", by) == 10
    assert spark.read.parquet(folder + "/t").count() == 1010
    nobody = df.groupBy("k").count().join(df.filter("id < 0"), "k", "left_semi")
    assert sinks.overwrite_parquet(nobody, folder + "/none", by) == 0
    assert sinks.overwrite_parquet(spark.createDataFrame([], "id int, k int"), folder + "/empty", by) == 0
    staged, n = sinks.stage_counted(df.filter("id < 5"), folder + "/s")
    assert n == staged.count() == 5


def test_a_write_that_breaks_leaves_the_day(spark, folder):
    day_one = {"year": "2024", "month": "05"}
    good = spark.createDataFrame([(1, "a")], "id int, name string")
    bad = good.selectExpr("id", "raise_error('broken') AS name")
    sinks.replace_partition(good, folder + "/t", day_one)
    with pytest.raises(Exception, match="broken"):
        sinks.replace_partition(bad, folder + "/t", day_one)
    assert rows(spark.read.parquet(folder + "/t"), "id", "name") == [(1, "a")]
    sinks.replace_partition(good.withColumn("id", good.id + 1), folder + "/t", day_one)
    assert rows(spark.read.parquet(folder + "/t"), "id", "name") == [(2, "a")]
    assert sorted(os.listdir(folder + "/t")) == ["year=2024"]
