"""Published versions, refreshes that rewrite touched buckets, and files taken once from an inbox."""

import datetime as dt
import os
from collections import Counter

import pytest

from helpers import day, rows
from rosterline import schemas
from rosterline.plans import jobs
from rosterline.sources import files
from rosterline.sources.versions import EMPTY, VersionConflict, VersionedTable

DAY = dt.date(2024, 6, 1)
SECONDS = 86_400


def data_files(folder):
    """Every data file with the time it was written."""
    return {
        os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
        for d, _, names in os.walk(f"{folder}/table/data")
        for n in names
        if n.startswith("part-")
    }


def table_of(folder, buckets=8):
    return VersionedTable(f"{folder}/table", schemas.TIMELINE, "emp_id", buckets, ["status"])


def raw(spark, *data):
    """(employee, designation, start, salary) as a raw load."""
    lines = [(str(e), d, (day(s) - dt.date(1970, 1, 1)).days * float(SECONDS), None, p) for e, d, s, p in data]
    return spark.createDataFrame(lines, schemas.TIMEFRAME_RAW)


def nobody(spark, *ids):
    return spark.createDataFrame([(str(i),) for i in ids], schemas.STRUCK)


EVERYONE = [(e, "eng", "2024-01-01", 100.0 + e) for e in range(40)]


def read(spark, table, version=None):
    return rows(table.read(spark, version), "emp_id", "designation", "start_date", "end_date", "salary", "status")


def test_a_refresh_rewrites_only_touched_buckets(spark, folder):
    table = table_of(folder)
    assert jobs.refresh_touched(raw(spark, *EVERYONE), nobody(spark), table, "1", DAY)
    before = data_files(folder)
    handed = []
    raise_of_seven = [(7, "eng", "2024-02-01", 900.0)]
    jobs.refresh_touched(raw(spark, *raise_of_seven), nobody(spark), table, "2", DAY, lambda df: handed.extend(rows(df, "emp_id")))
    after = data_files(folder)
    bucket = table.touched(raw(spark, *raise_of_seven))
    assert {f: after[f] for f in before} == before  # nothing that was there has changed
    new = set(after) - set(before)
    assert len(bucket) == 1 and new and {f"bucket={b}" for b in bucket} == {f.split("/")[-3] for f in new}
    own = rows(table.read(spark, buckets=bucket), "emp_id")
    assert handed == own and (7,) in own and len(own) < 20
    seven = [r for r in read(spark, table) if r[0] == 7]
    assert [(r[2], r[3], r[5]) for r in seven] == [
        (day("2024-01-01"), day("2024-02-01"), "INACTIVE"),
        (day("2024-02-01"), None, "ACTIVE"),
    ]
    assert len(read(spark, table)) == 41
    assert read(spark, table, table.named(spark, "1")) == read(spark, table, table.versions(spark)[0])


def test_refreshes_equal_the_rewriting_job(spark, folder):
    loads = [EVERYONE, [(e, "ops", "2024-03-01", 50.0 * e) for e in range(0, 60, 7)], [(3, "hr", "2024-02-01", 1.0), (3, "hr", "2024-02-01", 2.0)]]
    table, previous = table_of(folder), None
    for i, load in enumerate(loads):
        struck = nobody(spark, *range(0, i * 10, 5))
        jobs.refresh_touched(raw(spark, *load), struck, table, str(i), DAY)
        os.makedirs(f"{folder}/csv{i}")
        raw(spark, *load).write.mode("append").option("header", True).csv(f"{folder}/csv{i}")
        jobs.refresh_timeline(spark, f"{folder}/csv{i}", struck, f"{folder}/whole", str(i), previous, DAY)
        previous = str(i)
        whole = spark.read.schema(schemas.TIMELINE).parquet(f"{folder}/whole/version={i}")
        assert read(spark, table) == rows(whole, "emp_id", "designation", "start_date", "end_date", "salary", "status")


def test_repeating_a_load_rewrites_nothing(spark, folder):
    table = table_of(folder)
    jobs.refresh_touched(raw(spark, *EVERYONE), nobody(spark), table, "1", DAY)
    more = raw(spark, (7, "eng", "2024-02-01", 900.0))
    jobs.refresh_touched(more, nobody(spark), table, "2", DAY)
    want, before = read(spark, table), data_files(folder)
    jobs.refresh_touched(more, nobody(spark), table, "3", DAY)
    assert (read(spark, table), data_files(folder)) == (want, before)
    # The same version again starts from what was before it.
    jobs.refresh_touched(raw(spark, (8, "eng", "2024-02-01", 800.0)), nobody(spark), table, "3", DAY)
    assert [r[0] for r in read(spark, table) if r[2] == day("2024-02-01")] == [7, 8]
    jobs.refresh_touched(raw(spark, (9, "eng", "2024-02-01", 800.0)), nobody(spark), table, "3", DAY)
    assert [r[0] for r in read(spark, table) if r[2] == day("2024-02-01")] == [7, 9]


def test_a_load_without_rows_is_no_version(spark, folder):
    table = table_of(folder)
    assert not jobs.refresh_touched(raw(spark), nobody(spark), table, "1", DAY)
    assert table.current(spark) == EMPTY and read(spark, table) == []
    jobs.refresh_touched(raw(spark, *EVERYONE), nobody(spark), table, "1", DAY)
    assert not jobs.refresh_touched(raw(spark), nobody(spark), table, "2", DAY)
    assert table.current(spark).name == "1"


def test_a_broken_write_leaves_the_old_version(spark, folder, monkeypatch):
    table = table_of(folder)
    jobs.refresh_touched(raw(spark, *EVERYONE), nobody(spark), table, "1", DAY)
    want = read(spark, table)
    change = raw(spark, *[(e, "ops", "2024-05-01", 1.0) for e in range(40)])

    def broken(self, spark, version):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_commit", broken)
        with pytest.raises(OSError, match="lost"):
            jobs.refresh_touched(change, nobody(spark), table, "2", DAY)
    os.makedirs(f"{folder}/table/data/load=2-half/bucket=1/status=ACTIVE")  # half a load, never published
    assert len(os.listdir(f"{folder}/table/data")) >= 3
    assert read(spark, table) == want and table.current(spark).name == "1"
    jobs.refresh_touched(change, nobody(spark), table, "2", DAY)
    assert Counter(r[5] for r in read(spark, table)) == {"ACTIVE": 40, "INACTIVE": 40}


def test_versions_exclude_each_other(spark, folder, monkeypatch):
    table = table_of(folder)
    rows_in = table.read(spark, EMPTY)
    first = table.publish(rows_in, "1")
    with monkeypatch.context() as patch:  # two loads that start from the same version
        patch.setattr(VersionedTable, "current", lambda self, spark: EMPTY)
        with pytest.raises(VersionConflict):
            table.publish(rows_in, "2")
    assert [v.name for v in table.versions(spark)] == ["1"] and table.current(spark) == first


def test_rows_outside_the_replaced_buckets_are_refused(spark, folder):
    table = table_of(folder)
    whole = spark.createDataFrame([(e, "eng", day("2024-01-01"), None, 1.0, "ACTIVE") for e in range(40)], schemas.TIMELINE)
    base = table.publish(whole, "1")
    with pytest.raises(ValueError, match="not replaced"):
        table.publish(whole, "2", base, [0])
    emptied = table.publish(whole.filter("false"), "2", base, [0, 1])
    assert set(emptied.loads) == set(range(8)) - {0, 1}
    assert table.touched(table.read(spark)) == set(range(8)) - {0, 1}


def test_cleaning_keeps_what_versions_use(spark, folder):
    table = table_of(folder)
    jobs.refresh_touched(raw(spark, *EVERYONE), nobody(spark), table, "1", DAY)
    for i in range(2, 5):
        jobs.refresh_touched(raw(spark, (7, "eng", f"2024-02-0{i}", 900.0 + i)), nobody(spark), table, str(i), DAY)
    want = [read(spark, table, v) for v in table.versions(spark)[-2:]]
    assert len(table.clean(spark, keep=2)) == 1  # the load of version 2, whose bucket 3 and 4 have replaced
    assert [read(spark, table, v) for v in table.versions(spark)] == want
    assert table.clean(spark, keep=2) == []


def test_strike_outs_rewrite_the_buckets_they_close(spark, folder):
    table = table_of(folder)
    jobs.refresh_touched(raw(spark, *EVERYONE), nobody(spark), table, "1", DAY)
    before = data_files(folder)
    jobs.close_touched(spark, nobody(spark, 5, 999, "no id"), table, "2", DAY)
    new = set(data_files(folder)) - set(before)
    assert len({f.split("/")[-3] for f in new}) == 1
    closed = [r for r in read(spark, table) if r[5] == "INACTIVE"]
    assert [(r[0], r[3]) for r in closed] == [(5, DAY)]
    jobs.close_touched(spark, nobody(spark, 5), table, "3", dt.date(2024, 7, 1))
    assert [r for r in read(spark, table) if r[5] == "INACTIVE"] == closed
    assert set(data_files(folder)) == set(before) | new


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("emp_id,designation,start_date,end_date,salary\n" + "".join(f"{line}\n" for line in lines))


def load_inbox(spark, folder, table, **options):
    jobs.refresh_from_inbox(
        spark, f"{folder}/inbox", f"{folder}/archive", f"{folder}/cp", nobody(spark), table, DAY, **options
    )


def test_files_are_merged_once_and_archived(spark, folder):
    table = table_of(folder)
    put(f"{folder}/inbox", "a b.csv", f"1,eng,{19_700 * SECONDS},,10", f"2,ops,{19_700 * SECONDS},,20")
    put(f"{folder}/inbox", "c.csv", f"1,eng,{19_800 * SECONDS},,30")
    load_inbox(spark, folder, table, max_files=1)
    assert len(table.versions(spark)) == 2 and os.listdir(f"{folder}/inbox") == []
    assert Counter(r[0] for r in read(spark, table)) == {1: 2, 2: 1}
    put(f"{folder}/inbox", "d.csv", f"3,hr,{19_800 * SECONDS},,5")
    load_inbox(spark, folder, table)
    load_inbox(spark, folder, table)
    assert len(table.versions(spark)) == 3
    archived = [n for _, _, names in os.walk(f"{folder}/archive") for n in names if n.endswith(".csv")]
    assert sorted(archived) == ["a b.csv", "c.csv", "d.csv"]


@pytest.mark.parametrize("at", ["archive_files", "_commit"])
def test_a_failed_batch_is_finished_by_the_next_run(spark, folder, monkeypatch, at):
    """Once the failure strikes after the version is published, once before."""
    table = table_of(folder)
    put(f"{folder}/inbox", "a.csv", f"1,eng,{19_700 * SECONDS},,10")

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs.incremental if at == "archive_files" else VersionedTable, at, fails)
        with pytest.raises(Exception, match="lost"):
            load_inbox(spark, folder, table)
    assert os.path.exists(f"{folder}/inbox/a.csv")
    assert len(table.versions(spark)) == (at == "archive_files")
    put(f"{folder}/inbox", "b.csv", f"1,eng,{19_800 * SECONDS},,30")
    load_inbox(spark, folder, table)
    assert len(table.versions(spark)) == 2 and os.listdir(f"{folder}/inbox") == []
    assert len(read(spark, table)) == 2


def test_the_source_is_read_once(spark, folder, monkeypatch):
    """A job that has staged rows does not ask its source again."""
    put(f"{folder}/raw", "a.csv", f"1,eng,{19_700 * SECONDS},,10")
    source, asked = files.read_csv(spark, f"{folder}/raw", schemas.TIMEFRAME_RAW), []
    frame, is_empty = type(source), type(source).isEmpty
    monkeypatch.setattr(frame, "isEmpty", lambda self: asked.append(self) or is_empty(self))
    assert jobs.refresh_touched(source, nobody(spark), table_of(folder), "1", DAY)
    assert all(df is not source for df in asked)
