"""Check queries that write a given table to files and read it back through sources, sinks and jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline import schemas
from rosterline.operators import cleaning, messages, reports
from rosterline.plans import jobs
from rosterline.sources import files, rejected, sinks
from rosterline.sources.versions import VersionedTable
from rosterline.streaming.incremental import distinct_sink, incremental_csv
from rosterline.testbed import tables as t

FIRST_DAY, SECOND_DAY = dt.date(2024, 5, 1), dt.date(2024, 5, 2)


def _csv(df: DataFrame, path: str) -> str:
    df.write.mode("append").option("header", True).csv(path)
    return path


def _people(spark, sf):
    return t.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 18).alias("age"),
        F.col("c_custkey").alias("emp_id"),
        F.col("c_acctbal").alias("balance"),
    )


def csv_with_schema(spark, sf):
    path = _csv(_people(spark, sf).drop("balance"), f"{t.scratch(spark)}/raw")
    return files.read_csv(spark, path, schemas.EMPLOYEE)


def csv_without_header(spark, sf):
    """Order dates as a holiday load; the header lines of the files drop out in cleaning."""
    days = t.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("reason"), F.date_format("o_orderdate", "yyyy-M-d").alias("date")
    )
    path = _csv(days, f"{t.scratch(spark)}/raw")
    return cleaning.clean_calendar(files.read_csv(spark, path, schemas.CALENDAR_RAW, header=False))


def csv_strings(spark, sf):
    return files.read_csv_strings(spark, _csv(_people(spark, sf), f"{t.scratch(spark)}/raw"))


def csv_append(spark, sf):
    """Two loads appended as CSV and read back with their types."""
    path = f"{t.scratch(spark)}/rows"
    for load in (t.FIRST_LOAD, t.SECOND_LOAD):
        sinks.append_csv(t.timeframe(spark, sf, load).drop("end_date"), path)
    kept = [f for f in schemas.TIMEFRAME_RAW.fields if f.name != "end_date"]
    return files.read_csv(spark, path, T.StructType(kept))


def word_files(spark, sf):
    """Benchmark items as JSON arrays of words, one on a line, read back as one list."""
    path = f"{t.scratch(spark)}/words"
    found = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    t.table(spark, sf, "benchmark").select(F.to_json(found).alias("value")).write.text(path)
    return files.read_words(spark, path)


def read_or_default(spark, sf):
    """Struck-out ids from a table that exists and from one that does not."""
    folder = t.scratch(spark)
    sinks.overwrite_parquet(t.struck(spark, sf), f"{folder}/there")
    there, missing = (files.read_or_empty(spark, f"{folder}/{x}", schemas.STRUCK) for x in ("there", "missing"))
    return there.unionByName(missing)


def append_partitioned(spark, sf):
    """Quotas appended year by year; the second load brings nothing new."""
    folder = t.scratch(spark)
    path = _csv(t.quota(spark, sf).select(*schemas.QUOTA.fieldNames()), f"{folder}/raw")
    for _ in range(2):
        jobs.load_quota(spark, path, f"{folder}/quota")
    return files.read_or_empty(spark, f"{folder}/quota", schemas.QUOTA)


def append_batches(spark, sf):
    """Three appended parts of the orders, as one table."""
    path = f"{t.scratch(spark)}/orders"
    for status in ("F", "O", "P"):
        sinks.append_parquet(t.timeframe(spark, sf, [status]), path)
    return spark.read.schema(t.timeframe(spark, sf).schema).parquet(path)


def overwrite_dates(spark, sf):
    """Events by day; the days of the clicks are written again with clicks alone."""
    path = f"{t.scratch(spark)}/events"
    day = F.date_format("ts", "yyyy-MM-dd")
    events = t.table(spark, sf, "events").select("event_id", "event_type", day.alias("day"))
    sinks.overwrite_partitions(events, path, ["day"])
    even = events.filter((F.col("event_type") == "click") & (F.substring("day", 10, 1).cast("int") % 2 == 0))
    sinks.overwrite_partitions(even, path, ["day"])
    return spark.read.schema(events.schema).parquet(path)


def overwrite_table(spark, sf):
    path = f"{t.scratch(spark)}/table"
    sinks.overwrite_parquet(t.employees(spark, sf), path)
    sinks.overwrite_parquet(t.employees(spark, sf).filter(F.col("balance") > 0), path)
    return spark.read.parquet(path)


def input_files(spark, sf):
    """Customers by nation: each row knows the file it came from."""
    path = f"{t.scratch(spark)}/nations"
    sinks.append_parquet(t.table(spark, sf, "customer").select("c_custkey", "c_nationkey"), path, ["c_nationkey"])
    named = files.with_lineage(spark.read.parquet(path))
    nation = F.regexp_extract("source_file", "c_nationkey=([0-9]+)/", 1).cast("int")
    return named.select("c_custkey", nation.alias("nation"))


def pruned_usage(spark, sf):
    """Quota usage from a ledger whose other months cannot be read: it fails unless they are pruned."""
    booked, ledger = t.bookings(spark, sf), f"{t.scratch(spark)}/ledger"
    sinks.append_parquet(booked, ledger, ["year", "month"])
    wanted = (F.col("year") == t.LEAVE_YEAR) & (F.col("month") < t.BEFORE_MONTH)
    others = booked.select("year", "month").distinct().filter(~wanted)
    broken = others.select(F.lit("not parquet").alias("value"), "year", "month")
    broken.write.mode("append").partitionBy("year", "month").text(ledger)
    stored = spark.read.schema(booked.schema).parquet(ledger)
    return reports.quota_usage(stored, t.quota(spark, sf), t.LEAVE_YEAR, t.BEFORE_MONTH)


def load_csv_once(spark, sf):
    """Customers written twice as raw CSV files, loaded a few files at a time and cleaned."""
    folder = t.scratch(spark)
    for _ in range(2):
        _csv(t.employees(spark, sf), f"{folder}/raw")
    schema = t.employees(spark, sf).schema
    keys = ["emp_id", "name", "balance"]
    sink = distinct_sink(
        f"{folder}/clean", schema, keys, lambda rows: cleaning.clean_required(rows, keys, ["balance"], keys)
    )
    for _ in range(2):  # the second run finds nothing new
        incremental_csv(
            spark, f"{folder}/raw", schema, sink, f"{folder}/checkpoint", max_files=3
        ).awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/clean").select(*keys)


def quarantine_employees(spark, sf):
    """Customers as CSV, some with an age in words or too low: those kept, and those turned away with the reason."""
    folder = t.scratch(spark)
    age = F.when(F.col("emp_id") % 7 == 0, "n/a").otherwise(F.col("age").cast("string"))
    path = _csv(_people(spark, sf).select("name", age.alias("age"), "emp_id"), f"{folder}/raw")
    read = rejected.read_csv_checked(spark, path, schemas.EMPLOYEE)
    table = f"{folder}/quarantine"
    kept = rejected.quarantine(
        read, f"{folder}/marked", table, {"load_date": f"{FIRST_DAY}"}, {"under age": F.col("age") >= 20}
    )
    away = rejected.read_quarantine(spark, table, ["load_date"])
    told = away.filter(F.col(rejected.REASON) == rejected.MALFORMED).select(
        F.lit(None).cast("bigint").alias("emp_id"),
        F.col(rejected.REASON).alias("reason"),
        F.col(rejected.RECORD).alias("record"),
    )
    young = away.filter(F.col(rejected.REASON) == "under age").select(
        F.get_json_object(rejected.RECORD, "$.emp_id").cast("bigint").alias("emp_id"),
        F.col(rejected.REASON).alias("reason"),
        F.lit(None).cast("string").alias("record"),
    )
    none = F.lit(None).cast("string")
    return kept.select("emp_id", none.alias("reason"), none.alias("record")).unionByName(told).unionByName(young)


def quarantine_messages(spark, sf):
    """Messages of which some are cut short, empty or without a text, each with the reason."""
    value, turn = F.col("value").cast("string"), F.col("turn") + F.col("conv_id")
    spoilt = (
        F.when(turn % 11 == 0, F.expr("substr(CAST(value AS STRING), 1, length(CAST(value AS STRING)) - 1)"))
        .when(turn % 11 == 1, " ")
        .when(turn % 11 == 2, '{"sender":"x","receiver":"y"}')
        .otherwise(value)
    )
    sent = t.json_messages(spark, sf).withColumn("value", spoilt.cast("binary"))
    parsed = rejected.parse_messages_checked(sent, keep=["conv_id", "turn"])
    return parsed.select("conv_id", "turn", "message", F.col(rejected.REASON).alias("reason"))


def reload_employees(spark, sf):
    """A day of employees loaded, corrected and loaded again, next to another day."""
    folder = t.scratch(spark)
    people, table = _people(spark, sf), f"{folder}/employees"
    rows = people.drop("balance")
    jobs.load_employees(spark, _csv(rows, f"{folder}/other"), table, SECOND_DAY)
    jobs.load_employees(spark, _csv(rows, f"{folder}/first"), table, FIRST_DAY)
    corrected = people.filter(F.col("balance") > 0).drop("balance")
    jobs.load_employees(spark, _csv(corrected, f"{folder}/corrected"), table, FIRST_DAY)
    # Days written with a leading zero are read back as numbers.
    return spark.read.parquet(table).select("emp_id", "name", "age", F.col("day").cast("int").alias("load_day"))


def reload_leaves(spark, sf):
    """A day of leave loaded, corrected and loaded again: later years are withdrawn."""
    folder = t.scratch(spark)
    booked = t.bookings(spark, sf)
    everyone = booked.select("emp_id", F.lit("ACTIVE").alias("status")).distinct()
    tables = [f"{folder}/events", f"{folder}/ledger"]
    early = booked.filter(F.col("year") < t.LEAVE_YEAR)
    for name, rows in (("first", booked), ("corrected", early)):
        raw = _csv(rows.select("emp_id", "date", "status"), f"{folder}/{name}")
        jobs.refresh_leaves(
            spark, raw, t.closed_days(spark, sf), everyone, *tables, dt.datetime(2024, 5, 1, 7)
        )
    return files.read_or_empty(spark, tables[1], schemas.LEAVE_LEDGER).drop("ingest_timestamp")


def reload_leave_votes(spark, sf):
    """`reload_leaves` from votes kept by day, the correction loaded twice."""
    folder = t.scratch(spark)
    booked = t.bookings(spark, sf)
    everyone = booked.select("emp_id", F.lit("ACTIVE").alias("status")).distinct()
    ledger = VersionedTable(f"{folder}/ledger", schemas.LEAVE_LEDGER, "emp_id", 16)
    early = booked.filter(F.col("year") < t.LEAVE_YEAR)
    for rows in (booked, early, early):
        raw = rows.select(F.col("emp_id").cast("string").alias("emp_id"), "date", "status")
        jobs.refresh_leave_votes(
            raw, t.closed_days(spark, sf), everyone, f"{folder}/votes", ledger, dt.datetime(2024, 5, 1, 7)
        )
    return ledger.read(spark).drop("ingest_timestamp")


def _versioned(folder: str) -> VersionedTable:
    return VersionedTable(f"{folder}/timeline", schemas.TIMELINE, "emp_id", 16, ["status"])


def refresh_touched(spark, sf):
    """The second load merged into the first by touched buckets, twice, with people struck out since."""
    folder = t.scratch(spark)
    table, struck = _versioned(folder), t.struck(spark, sf)
    first = _csv(t.timeframe(spark, sf, t.FIRST_LOAD), f"{folder}/first")
    second = _csv(t.timeframe(spark, sf, t.SECOND_LOAD), f"{folder}/second")
    for version, path, ids in (("1", first, struck.filter("false")), ("2", second, struck), ("3", second, struck)):
        raw = files.read_csv(spark, path, schemas.TIMEFRAME_RAW)
        jobs.refresh_touched(raw, ids, table, version, t.STRUCK_ON)
    return table.read(spark)


def timeline_inbox(spark, sf):
    """Both loads as files in an inbox, merged as they arrive; with them the number of files left."""
    folder = t.scratch(spark)
    table, struck = _versioned(folder), t.struck(spark, sf)
    for load in (t.FIRST_LOAD, t.SECOND_LOAD):
        _csv(t.timeframe(spark, sf, load), f"{folder}/inbox")
        jobs.refresh_from_inbox(
            spark, f"{folder}/inbox", f"{folder}/archive", f"{folder}/checkpoint", struck, table, t.STRUCK_ON
        )
    left = files.read_csv(spark, f"{folder}/inbox", schemas.TIMEFRAME_RAW)
    names = left.agg(F.count_distinct(F.col("_metadata.file_path"))).first()[0]
    return table.read(spark).withColumn("files_left", F.lit(names).cast("bigint"))


def merge_headcount(spark, sf):
    """Headcounts of the first load, and over them those of the second without one designation."""
    folder = t.scratch(spark)
    second = t.timeline(spark, sf, t.SECOND_LOAD).filter(F.col("designation") != "1-URGENT")
    jobs.merge_headcount(spark, t.timeline(spark, sf, t.FIRST_LOAD), folder, "1", None)
    jobs.merge_headcount(spark, second, folder, "2", "1")
    return spark.read.parquet(f"{folder}/version=2")


def merge_into_target(spark, sf):
    """The second load merged into a stored target that holds the first."""
    folder = t.scratch(spark)
    specified = F.when(F.col("designation") != "4-NOT SPECIFIED", F.col("designation"))
    second = t.timeline(spark, sf, t.SECOND_LOAD).withColumn("designation", specified)
    jobs.merge_into_target(spark, t.timeline(spark, sf, t.FIRST_LOAD), folder, "1", None)
    jobs.merge_into_target(spark, second, folder, "2", "1")
    return spark.read.schema(schemas.TIMELINE).parquet(f"{folder}/version=2")


def empty_input(spark, sf):
    """Loads without rows are skipped: the table holds what was loaded before."""
    folder = t.scratch(spark)
    rows, table = _people(spark, sf).drop("balance"), f"{folder}/employees"
    jobs.load_employees(spark, _csv(rows, f"{folder}/full"), table, FIRST_DAY)
    jobs.load_employees(spark, _csv(rows.limit(0), f"{folder}/empty"), table, FIRST_DAY)
    return spark.read.parquet(table).select("emp_id", "name", "age")


def encoded_and_parsed(spark, sf):
    """Messages encoded for a topic and parsed from it again."""
    sent = messages.encode_messages(t.messages(spark, sf)).withColumn("value", F.col("value").cast("binary"))
    return messages.parse_messages(sent, keep=["key"]).select("sender", "receiver", "message")


ALL = [
    csv_with_schema,
    csv_without_header,
    csv_strings,
    csv_append,
    word_files,
    read_or_default,
    append_partitioned,
    append_batches,
    overwrite_dates,
    overwrite_table,
    input_files,
    pruned_usage,
    load_csv_once,
    quarantine_employees,
    quarantine_messages,
    reload_employees,
    reload_leaves,
    reload_leave_votes,
    refresh_touched,
    timeline_inbox,
    merge_headcount,
    merge_into_target,
    empty_input,
    encoded_and_parsed,
]
