"""Targets that take each batch once, rejected input, and parts of a database table."""

import datetime as dt
import sqlite3

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import rows
from rosterline import schemas
from rosterline.sources import jdbc, rejected
from rosterline.streaming.once import SqlLedger, Target, changes_once, take_once
from rosterline.streaming.strike_stream import StrikeState, apply_batch

NOW = dt.datetime(2024, 1, 31)


class Database:
    """A database in this process, with staging that can break off after some rows."""

    def __init__(self, *tables):
        self.db = sqlite3.connect(":memory:", isolation_level=None)
        for table in tables:
            self.db.execute(table)
        self.fail_after = None
        self.fail_commit = False
        self.ledger = SqlLedger("taken", "flags' stream", self.query, self.transact)
        self.db.execute(self.ledger.definition())

    def query(self, sql):
        return self.db.execute(sql).fetchall()

    def transact(self, statements):
        self.db.execute("BEGIN")
        try:
            for i, sql in enumerate(statements):
                if self.fail_commit and i == len(statements) - 1:
                    raise OSError("lost")
                # This database takes ON after FROM for a join unless a condition stands between.
                self.db.execute(sql.replace(" ON CONFLICT", " WHERE true ON CONFLICT"))
            self.db.execute("COMMIT")
        except BaseException:
            self.db.execute("ROLLBACK")
            raise

    def stage(self, df, table):
        self.db.execute(f"DROP TABLE IF EXISTS {table}")
        self.db.execute(f"CREATE TABLE {table} ({', '.join(df.columns)})")
        for i, row in enumerate(df.collect()):
            if self.fail_after is not None and i >= self.fail_after:
                raise OSError("lost")
            self.db.execute(f"INSERT INTO {table} VALUES ({', '.join('?' * len(row))})", [str(v) for v in row])


FLAGS = "CREATE TABLE flags (employee_id, start_date)"
STRIKES = f"CREATE TABLE strikes ({', '.join(['employee_id PRIMARY KEY', *schemas.STRIKES.fieldNames()[1:]])})"


def batch_of(spark, *names):
    return spark.createDataFrame([(n, dt.datetime(2024, 1, 20)) for n in names], schemas.FLAG)


@pytest.mark.parametrize("failure", ["staging", "commit", "after"])
def test_a_batch_that_breaks_off_is_taken_once(spark, folder, failure):
    """Half of a batch staged, a transaction that fails at its end, and a batch seen again after all went well."""
    database = Database(FLAGS, STRIKES)
    forward = take_once(
        {"flags": Target("flags"), "strikes": Target("strikes", "employee_id")}, database.stage, database.ledger
    )
    state = StrikeState(f"{folder}/state")
    state.seed(spark, spark.createDataFrame([(n, 1000.0, *[None] * 10, 0) for n in "abc"], schemas.STRIKES))
    apply_batch(state, batch_of(spark, "a", "b"), 0, NOW, forward=forward)
    second = batch_of(spark, "a", "a", "b", "c")
    database.fail_after = 2 if failure == "staging" else None
    database.fail_commit = failure == "commit"
    if failure == "after":
        apply_batch(state, second, 1, NOW, forward=forward)
    else:
        with pytest.raises(OSError, match="lost"):
            apply_batch(state, second, 1, NOW, forward=forward)
        assert len(database.query("SELECT * FROM flags")) == 2 and not database.ledger.has(1)
    database.fail_after, database.fail_commit = None, False
    apply_batch(state, second, 1, NOW, forward=forward)  # the batch comes again
    found = database.query("SELECT employee_id, count(*) FROM flags GROUP BY 1 ORDER BY 1")
    assert found == [("a", 3), ("b", 2), ("c", 1)]
    assert database.query("SELECT employee_id, no_of_strikes FROM strikes ORDER BY 1") == [("a", "3"), ("b", "2"), ("c", "1")]
    assert database.query("SELECT batch FROM taken ORDER BY 1") == [(0,), (1,)]


def test_one_table_per_batch(spark):
    database = Database("CREATE TABLE strikes (employee_id PRIMARY KEY, no_of_strikes)")
    forward = changes_once(Target("strikes", "employee_id"), database.stage, database.ledger)
    for batch, (name, n) in enumerate([("a", 1), ("b", 1), ("a", 2)]):
        for _ in range(2):
            forward(spark.createDataFrame([(name, n)], "employee_id string, no_of_strikes int"), batch)
    assert database.query("SELECT * FROM strikes ORDER BY 1") == [("a", "2"), ("b", "1")]


def test_two_drivers_cannot_take_the_same_batch():
    database = Database(FLAGS)
    database.ledger.commit(4, [])
    with pytest.raises(sqlite3.IntegrityError):
        database.ledger.commit(4, ["INSERT INTO flags VALUES ('x', 'y')"])
    assert database.query("SELECT * FROM flags") == []
    assert not SqlLedger("taken", "other", database.query, database.transact).has(4)


def test_names_are_names():
    for name in ("a; DROP TABLE b", "a b", "", "1a", "a.b.c"):
        with pytest.raises(ValueError):
            Target(name).move("staged", ["x"])
        with pytest.raises(ValueError):
            SqlLedger(name, "s", list, list).has(1)


# --- Rejected input


def test_csv_rows_kept_and_rejected_are_all_rows(spark, folder):
    lines = ["name,age,emp_id", "ann,30,1", "bob,x,2", "cy,17,3", "dan,40", "eve,50,5,more", '"f,g",60,6', ",70,7", "hal,,8"]
    (path := f"{folder}/raw.csv")
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    read = rejected.read_csv_checked(spark, path, schemas.EMPLOYEE)
    rules = {"no name": F.col("name").isNotNull(), "under age": F.col("age") >= 18}
    for _ in range(2):  # a repeated load replaces its directory
        kept = rejected.quarantine(read, f"{folder}/marked", f"{folder}/away", {"day": "1"}, rules)
    away = rows(rejected.read_quarantine(spark, f"{folder}/away", ["day"]), "reject_reason", "reject_record")
    assert rows(kept, "name", "age", "emp_id") == [("ann", 30, 1), ("f,g", 60, 6)]
    assert kept.columns == ["name", "age", "emp_id"]
    assert [a for a in away if a[0] == "malformed"] == [("malformed", "bob,x,2"), ("malformed", "dan,40"), ("malformed", "eve,50,5,more")]
    assert [a[0] for a in away if a[0] != "malformed"] == ["no name", "under age", "under age"]
    assert kept.count() + len(away) == len(lines) - 1


def test_messages_that_are_no_messages(spark):
    values = ['{"sender":"a","receiver":"b","message":"c"}', '{"sender":"a","rec', None, " ", "[1]", "7", '{"sender":"a","receiver":"b"}', '{"sender":null,"receiver":"b","message":"c"}', '{"sender":{"x":1},"receiver":"b","message":"c","more":2}']
    df = spark.createDataFrame([(i, v and bytearray(v.encode())) for i, v in enumerate(values)], "id int, value binary")
    found = rejected.parse_messages_checked(df, keep=["id"]).collect()
    reasons = {r.id: r.reject_reason for r in found}
    assert len(found) == len(values)
    assert {i: r for i, r in reasons.items() if i not in (4, 5)} == {
        0: None, 1: "malformed", 2: "empty", 3: "empty", 6: "no message", 7: "no sender", 8: None,
    }
    assert reasons[4] and reasons[5]
    assert all((r.reject_record is None) == (r.reject_reason is None or r.id == 2) for r in found)


def test_rules_alone_reject_rows(spark, folder):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "a int, b int")
    kept = rejected.quarantine(df, f"{folder}/m", f"{folder}/q", {"day": "1"}, {"b": F.col("b") > 0})
    assert rows(kept) == [(1, 5)]
    assert rows(rejected.read_quarantine(spark, f"{folder}/q"), "reject_record", "reject_reason") == [('{"a":2}', "b"), ('{"a":3,"b":-1}', "b")]
    none = rejected.quarantine(df.filter("false"), f"{folder}/m", f"{folder}/q", {"day": "1"}, {"b": F.col("b") > 0})
    assert none.count() == 0 and rejected.read_quarantine(spark, f"{folder}/q").count() == 0


# --- Parts of a database table


def parts_met(kind, values, predicates):
    """For each value the number of predicates it meets."""
    db = duckdb.connect()
    db.execute(f"CREATE TABLE t (k {kind})")
    db.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    met = " + ".join(f"coalesce(CAST({p} AS INT), 0)" for p in predicates)
    return db.execute(f"SELECT {met} FROM t").fetchall()


@pytest.mark.parametrize("parts", [1, 2, 7, 16])
def test_remainders_meet_every_row_once(parts):
    values = [None, 0, -1, 1, -7, 7, -13, 2**62, -(2**62), *range(-50, 50)]
    predicates = jdbc.hash_predicates("k", parts)
    assert len(predicates) == parts
    assert set(parts_met("BIGINT", values, predicates)) == {(1,)}


@pytest.mark.parametrize(
    "kind, splits, values",
    [
        ("BIGINT", [], [None, 1]),
        ("BIGINT", jdbc.even_splits(-3, 90, 7), [None, *range(-10, 100)]),
        ("DATE", [dt.date(2024, 1, 1), dt.date(2024, 2, 1)], [None, dt.date(2023, 5, 5), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2025, 1, 1)]),
        ("TIMESTAMP", [dt.datetime(2024, 1, 1, 12)], [None, dt.datetime(2024, 1, 1, 11, 59), dt.datetime(2024, 1, 1, 12)]),
        ("VARCHAR", ["d", "o'n"], [None, "", "a", "d", "n", "o'n", "z"]),
    ],
)
def test_ranges_meet_every_row_once(kind, splits, values):
    predicates = jdbc.range_predicates("k", splits)
    assert len(predicates) == len(splits) + 1
    assert set(parts_met(kind, values, predicates)) == {(1,)}


def test_splits():
    assert jdbc.even_splits(0, 99, 4) == [25, 50, 75]
    assert jdbc.even_splits(5, 6, 10) == [6]
    assert jdbc.even_splits(5, 5, 3) == []
    with pytest.raises(ValueError):
        jdbc.range_predicates("k", [2, 1])
    with pytest.raises(TypeError):
        jdbc.range_predicates("k", [None])
