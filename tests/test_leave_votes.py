"""Leave settled from votes kept by load day equals leave settled from all records."""

import datetime as dt
import random

import pytest

from helpers import day, rows
from rosterline import schemas
from rosterline.operators import leaves
from rosterline.plans import jobs
from rosterline.sources import sinks
from rosterline.sources.versions import VersionedTable


def loads_of(seed, n):
    """Loads as (load day, records): some days again and corrected, some statuses without a vote."""
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        records = [
            (str(rng.randint(1, 12)), day(f"2024-0{rng.randint(3, 5)}-{rng.randint(11, 14)}"), rng.choice(["ACTIVE", "CANCELLED", "OTHER"]))
            for _ in range(rng.randint(0, 40))
        ]
        found.append((rng.randint(1, 4), records))
    return found


class Loader:
    def __init__(self, spark, folder):
        self.spark = spark
        self.votes = f"{folder}/votes"
        self.ledger = VersionedTable(f"{folder}/ledger", schemas.LEAVE_LEDGER, "emp_id", 4)
        self.calendar = spark.createDataFrame([], "date date")
        self.timeline = spark.createDataFrame([(i, "ACTIVE") for i in range(1, 12)], "emp_id bigint, status string")

    def load(self, load_day, records):
        raw = self.spark.createDataFrame(records, schemas.LEAVE_RAW)
        at = dt.datetime(2024, 6, load_day, 7)
        return jobs.refresh_leave_votes(raw, self.calendar, self.timeline, self.votes, self.ledger, at)

    def whole(self, current):
        """The ledger from the records of every day as they stand."""
        events = None
        for load_day, records in current.items():
            raw = self.spark.createDataFrame(records, schemas.LEAVE_RAW)
            typed = raw.withColumn("emp_id", raw.emp_id.try_cast("bigint"))
            own = leaves.with_ingest(leaves.leave_events(typed, self.calendar, self.timeline), dt.datetime(2024, 6, load_day, 7))
            events = own if events is None else events.unionByName(own)
        return rows(leaves.settle(events), "emp_id", "date", "status", "ingest_date")

    def found(self):
        return rows(self.ledger.read(self.spark), "emp_id", "date", "status", "ingest_date")


def test_votes_add_up_to_the_settled_records(spark):
    records = spark.createDataFrame(
        [(e, day("2024-05-02"), s, d, dt.datetime(2024, 5, int(d[-2:]))) for e, s, d in [(1, "ACTIVE", "2024-05-01"), (1, "ACTIVE", "2024-05-02"), (1, "CANCELLED", "2024-05-03"), (2, "CANCELLED", "2024-05-01"), (3, "OTHER", "2024-05-01"), (None, "ACTIVE", "2024-05-01")]],
        schemas.LEAVE_EVENT,
    )
    parts = leaves.leave_votes(records.filter("ingest_date < '2024-05-02'")).unionByName(
        leaves.leave_votes(records.filter("ingest_date >= '2024-05-02'"))
    )
    columns = ["emp_id", "status", "ingest_date"]
    assert rows(leaves.settle_votes(leaves.merge_votes(parts)), *columns) == rows(leaves.settle(records), *columns)


def test_loads_and_corrections_equal_settling_all(spark, folder):
    loader, current = Loader(spark, folder), {}
    for load_day, records in loads_of(1, 6):
        loaded = loader.load(load_day, records)
        assert loaded == bool(records)
        if loaded:
            current[load_day] = records
        assert loader.found() == loader.whole(current)


@pytest.mark.parametrize("at", ["replace_partition", "publish"])
def test_a_load_that_broke_off_is_finished_by_the_next(spark, folder, monkeypatch, at):
    """The votes of a day are replaced, but the ledger is not: the correction comes once more."""
    loader = Loader(spark, folder)
    first = [("1", day("2024-05-02"), "ACTIVE"), ("2", day("2024-05-02"), "ACTIVE")]
    loader.load(1, first)
    corrected = [("2", day("2024-05-03"), "ACTIVE")]

    def fails(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks if at == "replace_partition" else VersionedTable, at, fails)
        with pytest.raises(OSError):
            loader.load(1, corrected)
    assert loader.found() == loader.whole({1: first})
    loader.load(1, corrected)
    assert loader.found() == loader.whole({1: corrected}) == [(2, day("2024-05-03"), "ACTIVE", "2024-06-01")]


def test_a_load_rewrites_the_buckets_of_its_employees(spark, folder):
    loader = Loader(spark, folder)
    loader.load(1, [(str(e), day("2024-05-02"), "ACTIVE") for e in range(1, 12)])
    before = loader.ledger.current(spark).loads
    loader.load(2, [("1", day("2024-05-02"), "CANCELLED")])
    after = loader.ledger.current(spark).loads
    assert sum(before[b] != after.get(b) for b in before) == 1
