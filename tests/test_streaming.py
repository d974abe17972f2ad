import datetime as dt
import json
import os
import re

from pyspark.sql import functions as F

from helpers import plan, rows
from rosterline import schemas
from rosterline.operators import strikes
from rosterline.plans import jobs
from rosterline.sources import sinks
from rosterline.streaming.incremental import distinct_sink, incremental_csv
from rosterline.streaming.strike_stream import StrikeState, apply_batch, start_strike_stream

NOW = dt.datetime(2024, 1, 31)
STEPS = [None] * 10


def seed_rows(spark, *names):
    return spark.createDataFrame([(n, 1000.0, *STEPS, 0) for n in names], schemas.STRIKES)


def flag_rows(spark, *data):
    return spark.createDataFrame(
        [(e, t) for e, t in data], "employee_id string, start_date string"
    ).withColumn("start_date", F.col("start_date").cast("timestamp"))


def counted(state, spark, batch):
    return rows(state.strikes_before(spark, batch), "employee_id", "no_of_strikes", "strike_1", "strike_2")


def test_batches_add_up_and_compaction_changes_nothing(spark, folder):
    batches = [[("a", "2024-01-20 00:00:00")] * (i % 3) + [("b", "2024-01-25 00:00:00")] for i in range(5)]
    results = []
    for every in (2, 100):
        state = StrikeState(f"{folder}/{every}", compact_every=every)
        state.seed(spark, seed_rows(spark, "a", "b", "c"))
        for i, data in enumerate(batches):
            apply_batch(state, flag_rows(spark, *data), i, NOW)
        results.append((rows(state.strikes_before(spark, 5)), rows(state.struck(spark, 5))))
        assert os.path.exists(f"{folder}/{every}/strikes_full/batch={every}") == (every < 5)
    assert results[0] == results[1]
    whole = flag_rows(spark, *[f for data in batches for f in data])
    counts = strikes.rolling_flag_count(whole, NOW)
    want = {r.employee_id: min(r.strike_count, 10) for r in counts.collect()}
    got = {r[0]: r[-1] for r in results[0][0]}
    assert got == {**want, "c": 0}


def test_repeated_batch_changes_nothing(spark, folder):
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"))
    apply_batch(state, flag_rows(spark, ("a", "2024-01-20 00:00:00")), 0, NOW)
    again = flag_rows(spark, ("a", "2024-01-21 00:00:00"), ("a", "2024-01-21 00:00:00"))
    apply_batch(state, again, 1, NOW)
    first = counted(state, spark, 2)
    apply_batch(state, again, 1, NOW)
    assert counted(state, spark, 2) == first == [("a", 3, 900.0, 810.0)]


def test_flags_of_unknown_employees_are_kept_but_not_priced(spark, folder):
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"))
    apply_batch(state, flag_rows(spark, ("x", "2024-01-20 00:00:00")), 0, NOW)
    assert rows(state.flags_before(spark, 1), "employee_id") == [("x",)]
    assert counted(state, spark, 1) == [("a", 0, None, None)]


def test_expired_history_does_not_count(spark, folder):
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"), flag_rows(spark, ("a", "2023-12-31 23:59:59"), ("a", "2024-01-01 00:00:00")))
    apply_batch(state, flag_rows(spark, ("a", "2024-01-30 00:00:00")), 0, NOW)
    assert counted(state, spark, 1) == [("a", 2, 900.0, 810.0)]


def test_struck_out_employees_stop_changing(spark, folder):
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"))
    seen = []
    apply_batch(
        state,
        flag_rows(spark, *[("a", "2024-01-20 00:00:00")] * 12),
        0,
        NOW,
        forward=lambda tables, batch: seen.append((batch, rows(tables["struck"]), tables["flags"].count())),
    )
    apply_batch(state, flag_rows(spark, ("a", "2024-01-21 00:00:00")), 1, NOW)
    assert seen == [(0, [("a",)], 12)]
    assert rows(state.struck(spark, 2)) == [("a",)]
    assert rows(state.strikes_before(spark, 2), "no_of_strikes") == [(10,)]


def test_stream_of_files_equals_one_batch(spark, folder):
    texts = ["pay me", "pay him", "hello", "PAY", None, "me"]
    all_rows = [
        {"id": i, "value": json.dumps({"sender": f"e{i % 4}", "receiver": "r", "message": texts[i % 6]})}
        for i in range(60)
    ]
    vocab = spark.createDataFrame([("PAY",), ("ME",), ("HELLO",)], "word string")
    marked = spark.createDataFrame([("PAY",)], "word string")

    def run(name, parts):
        source = f"{folder}/{name}/in"
        os.makedirs(source)
        for p in range(parts):
            with open(f"{source}/{p}.json", "w") as out:
                out.writelines(json.dumps(r) + "\n" for r in all_rows[p::parts])
        state = StrikeState(f"{folder}/{name}/state", compact_every=2)
        state.seed(spark, seed_rows(spark, *[f"e{i}" for i in range(5)]))
        stream = spark.readStream.schema("id long, value string").option("maxFilesPerTrigger", 1).json(source)
        query = start_strike_stream(
            stream, vocab, marked, state, f"{folder}/{name}/cp", ["id"], clock=lambda: NOW, interval=None
        )
        query.awaitTermination()
        last = query.lastProgress["batchId"]
        assert last == parts - 1
        return rows(state.strikes_before(spark, last + 1)), rows(state.struck(spark, last + 1))

    assert run("many", 4) == run("one", 1)


def test_compaction_removes_what_it_has_replaced(spark, folder):
    state = StrikeState(f"{folder}/state", compact_every=2)
    state.seed(spark, seed_rows(spark, "a", "b"))
    for batch in range(7):
        apply_batch(state, flag_rows(spark, ("a", "2024-01-20 00:00:00")), batch, NOW)
    assert sorted(os.listdir(f"{folder}/state/flags")) == [f"batch={b}" for b in (4, 5, 6)]
    assert sorted(os.listdir(f"{folder}/state/strikes_full")) == ["batch=4", "batch=6"]
    assert rows(state.strikes_before(spark, 7), "employee_id", "no_of_strikes") == [("a", 7), ("b", 0)]


def test_batch_without_flags_writes_no_strikes(spark, folder):
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"))
    seen = []
    apply_batch(state, flag_rows(spark).limit(0), 0, NOW, forward=lambda *_: seen.append(1))
    assert not seen and not os.path.exists(f"{folder}/state/strikes/batch=0")
    apply_batch(state, flag_rows(spark, ("a", "2024-01-20 00:00:00")), 1, NOW)
    assert counted(state, spark, 2) == [("a", 1, 900.0, None)]


def test_batch_reads_the_buckets_of_its_employees(spark, folder):
    state = StrikeState(f"{folder}/state", buckets=8)
    state.seed(spark, seed_rows(spark, *[f"e{i}" for i in range(40)]))
    one = state.strikes_before(spark, 0, among=flag_rows(spark, ("e7", "2024-01-20 00:00:00")))
    assert rows(one, "employee_id") == [("e7",)]
    assert re.search(r"PartitionFilters: \[bucket#\d+ (IN|=)|PartitionFilters: \[isnotnull\(bucket", plan(one))


def test_old_flags_are_stored_and_passed_on_but_do_not_count(spark, folder):
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"))
    seen = []
    old_and_new = flag_rows(spark, ("a", "2023-11-01 00:00:00"), ("a", "2024-01-20 00:00:00"))
    apply_batch(state, old_and_new, 0, NOW, forward=lambda tables, _: seen.append(tables["flags"].count()))
    assert seen == [2] and state.flags_before(spark, 1).count() == 2
    assert counted(state, spark, 1) == [("a", 1, 900.0, None)]


def test_decay_goes_into_the_state(spark, folder):
    state = StrikeState(f"{folder}/state", compact_every=2)
    state.seed(spark, seed_rows(spark, "a", "b"))
    apply_batch(state, flag_rows(spark, ("a", "2024-01-05 00:00:00"), ("b", "2024-01-25 00:00:00")), 0, NOW)
    later = dt.datetime(2024, 2, 10)
    for _ in range(2):  # again changes nothing more
        state.decay(spark, 0, later)
        assert counted(state, spark, 1) == [("a", 0, None, None), ("b", 1, 900.0, None)]
    apply_batch(state, flag_rows(spark, ("a", "2024-02-09 00:00:00")), 1, later)
    assert counted(state, spark, 2) == [("a", 1, 900.0, None), ("b", 1, 900.0, None)]


def test_event_time_dates_the_flags(spark, folder):
    source = f"{folder}/in"
    os.makedirs(source)
    sent = ["2023-12-01 00:00:00", "2024-01-15 00:00:00", "2024-01-16 00:00:00"]
    with open(f"{source}/a.json", "w") as out:
        for i, at in enumerate(sent):
            value = json.dumps({"sender": "a", "receiver": "r", "message": "pay"})
            out.write(json.dumps({"id": i, "at": at, "value": value}) + "\n")
    words = spark.createDataFrame([("PAY",)], "word string")
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "a"))
    stream = spark.readStream.schema("id long, at timestamp, value string").json(source)
    start_strike_stream(
        stream, words, words, state, f"{folder}/cp", ["id"], clock=lambda: NOW, event_time="at", interval=None
    ).awaitTermination()
    assert counted(state, spark, 1) == [("a", 2, 900.0, 810.0)]
    assert [str(r[0]) for r in rows(state.flags_before(spark, 1), "start_date")] == sent


def test_strike_outs_close_the_timeline(spark, folder):
    timeline = spark.createDataFrame(
        [(1, "eng", dt.date(2024, 1, 1), None, 1000.0, "ACTIVE"), (2, "ops", dt.date(2024, 1, 1), None, 1.0, "ACTIVE")],
        schemas.TIMELINE,
    )
    sinks.write_version(timeline, f"{folder}/timeline", "0", ["status"])
    state = StrikeState(f"{folder}/state")
    state.seed(spark, seed_rows(spark, "1", "2"))

    def close(tables, batch):
        jobs.close_struck_out(
            spark, tables["struck"], f"{folder}/timeline", f"{batch + 1}", f"{batch}", NOW.date()
        )

    apply_batch(state, flag_rows(spark, *[("1", "2024-01-20 00:00:00")] * 10), 0, NOW, forward=close)
    closed = spark.read.schema(schemas.TIMELINE).parquet(f"{folder}/timeline/version=1")
    assert rows(closed, "emp_id", "end_date", "status") == [(1, NOW.date(), "INACTIVE"), (2, None, "ACTIVE")]


def test_rows_do_not_depend_on_files_per_batch(spark, folder):
    source = f"{folder}/raw"
    os.makedirs(source)
    for name, lines in {"1": ["a,30,1", "b,5,2"], "2": ["a,30,1", "c,6,3"], "3": ["b,5,2", "a,30,1", "d,x,4"]}.items():
        with open(f"{source}/{name}.csv", "w") as out:
            out.write("name,age,emp_id\n" + "\n".join(lines) + "\n")
    for most in (1, 2, None):
        table = f"{folder}/table{most}"
        sink = distinct_sink(table, schemas.EMPLOYEE, ["emp_id", "name", "age"], lambda df: df.dropna())
        for _ in range(2):
            incremental_csv(
                spark, source, schemas.EMPLOYEE, sink, f"{folder}/cp{most}", max_files=most
            ).awaitTermination()
        assert rows(spark.read.parquet(table), "name", "age", "emp_id") == [("a", 30, 1), ("b", 5, 2), ("c", 6, 3)]


def test_incremental_csv_loads_each_file_once_and_archives(spark, folder):
    source, archive, out = f"{folder}/raw", f"{folder}/done", f"{folder}/out"
    os.makedirs(source)

    def put(name, *lines):
        with open(f"{source}/{name}", "w") as f:
            f.write("name,age,emp_id\n" + "\n".join(lines) + "\n")

    def load():
        incremental_csv(
            spark,
            source,
            schemas.EMPLOYEE,
            lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"),
            f"{folder}/cp",
            archive,
        ).awaitTermination()
        return rows(spark.read.parquet(out), "name", "age", "emp_id")

    put("1.csv", "a,30,1", "b,x,2")
    assert load() == [("a", 30, 1), ("b", None, 2)]
    put("2.csv", "c,40,3")
    want = [("a", 30, 1), ("b", None, 2), ("c", 40, 3)]
    assert load() == want
    put("3.csv", "d,50,4")
    assert load() == sorted([*want, ("d", 50, 4)], key=repr)
    archived = [name for _, _, names in os.walk(archive) for name in names if name.endswith(".csv")]
    assert "1.csv" in archived
