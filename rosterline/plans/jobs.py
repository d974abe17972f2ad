"""The batch jobs: read, derive, write.

Paths, dates and further sinks come from the caller. A `Sink` gets the rows a job
has written, read back from storage, so a database copy never evaluates the plan a
second time. A job without input returns False and changes nothing.

Whether there is input shows in the number of rows that the write counts: a source is
looked at again, for a first row, only where nothing came of it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline import schemas
from rosterline.functions.rows import same
from rosterline.operators import cleaning, keyed, leaves, reports, strikes, timeline
from rosterline.sources import files, sinks
from rosterline.sources.versions import Version, VersionedTable
from rosterline.streaming import incremental

Sink = Callable[[DataFrame], None]


def _no_sink(df: DataFrame) -> None:
    """Default sink: the written files are the result."""


def load_employees(
    spark: SparkSession, source: str, table: str, as_of: dt.date, sink: Sink = _no_sink
) -> bool:
    """Employee CSV files into a table partitioned by load date."""
    raw = files.read_csv(spark, source, schemas.EMPLOYEE)
    keys = ["emp_id", "name", "age"]
    clean = cleaning.stamp_load_date(cleaning.clean_required(raw, keys, ["age"], keys), as_of)
    day = {"year": f"{as_of:%Y}", "month": f"{as_of:%m}", "day": f"{as_of:%d}"}
    ready = sinks.prepare_partition(clean, table, day)
    if not ready.rows and raw.isEmpty():
        sinks.discard(spark, ready)
        return False
    path = sinks.put_in_place(spark, ready)
    sink(files.read_or_empty(spark, path, schemas.EMPLOYEE).select(*keys))
    return True


def load_calendar(spark: SparkSession, source: str, table: str, sink: Sink = _no_sink) -> bool:
    """Holiday CSV files (their header line, if any, is dropped) into yearly partitions."""
    raw = files.read_csv(spark, source, schemas.CALENDAR_RAW, header=False)
    return _load_yearly(spark, raw, cleaning.clean_calendar, table, schemas.CALENDAR, sink)


def load_quota(spark: SparkSession, source: str, table: str, sink: Sink = _no_sink) -> bool:
    """Leave quota CSV files into yearly partitions."""
    raw = files.read_csv(spark, source, schemas.QUOTA)
    return _load_yearly(spark, raw, cleaning.clean_quota, table, schemas.QUOTA, sink)


def _load_yearly(spark, raw, clean, table, schema, sink) -> bool:
    """Append the rows a yearly table does not hold yet, so a load can be repeated."""
    rows = clean(raw).select(*schema.fieldNames())
    known = files.read_or_empty(spark, table, schema)
    added = sinks.append_parquet(keyed.new_rows_only(rows, known, rows.columns), table, ["year"])
    if not added and raw.isEmpty():
        return False
    sink(spark.read.schema(schema).parquet(table))
    return True


def refresh_timeline(
    spark: SparkSession,
    source: str,
    struck: DataFrame,
    root: str,
    version: str,
    previous: str | None,
    as_of: dt.date,
    sink: Sink = _no_sink,
) -> bool:
    """Merge new timeframe files into the last version of the timeline, as a new version.

    The load and its fresh rows are staged below `root`, since the merge reads each
    of them several times.
    """
    raw = files.read_csv(spark, source, schemas.TIMEFRAME_RAW)
    typed = raw.withColumn("emp_id", F.col("emp_id").try_cast("bigint"))
    new = timeline.timeline_build(typed, struck).select(*schemas.TIMELINE.fieldNames())
    load, loaded = sinks.stage_counted(new, f"{root}/_staging/load")
    if not loaded and raw.isEmpty():
        return False
    if previous is None:
        merged = timeline.rebuild_chain(load)
    else:
        existing = spark.read.schema(schemas.TIMELINE).parquet(f"{root}/version={previous}")
        fresh = sinks.stage(timeline.fresh_rows(existing, load), f"{root}/_staging/fresh")
        merged = timeline.merge_fresh(existing, fresh)
    sink(sinks.write_version(timeline.deactivate_ids(merged, struck, as_of), root, version, ["status"]))
    return True


def refresh_touched(
    raw: DataFrame,
    struck: DataFrame,
    table: VersionedTable,
    version: str,
    as_of: dt.date,
    sink: Sink = _no_sink,
) -> bool:
    """`refresh_timeline` that rewrites only the buckets in which a row changes.

    These are the buckets of employees with fresh rows, and of struck-out ones with an open
    row; repeating a load therefore rewrites nothing. The sink gets the rewritten buckets.
    """
    spark = raw.sparkSession
    typed = raw.withColumn("emp_id", F.col("emp_id").try_cast("bigint"))
    staging = f"{table.root.rstrip('/')}/_staging"
    built = timeline.timeline_build(typed, struck).select(*schemas.TIMELINE.fieldNames())
    load, loaded = sinks.stage_counted(built, f"{staging}/load")
    if not loaded and raw.isEmpty():
        return False
    base = table.before(spark, version)
    if not base.number:
        published = table.publish(timeline.rebuild_chain(load), version)
        sink(table.read(spark, published))
        return True
    stored = table.read(spark, base, table.touched(load))
    fresh = sinks.stage(timeline.fresh_rows(stored, load), f"{staging}/fresh")
    touched = table.touched(fresh) | _open_buckets(spark, struck, table, base)
    merged = timeline.merge_fresh(table.read(spark, base, touched), fresh)
    published = table.publish(timeline.deactivate_ids(merged, struck, as_of), version, base, touched)
    sink(table.read(spark, published, touched))
    return True


def _open_buckets(spark: SparkSession, struck: DataFrame, table: VersionedTable, base: Version) -> set[int]:
    """Buckets with an open row of a struck-out employee."""
    rows = table.read(spark, base).filter(F.col("status") == timeline.ACTIVE).select("emp_id")
    return table.touched(keyed.only_ids(rows, struck, "emp_id", "employee_id"))


def close_touched(
    spark: SparkSession,
    struck: DataFrame,
    table: VersionedTable,
    version: str,
    as_of: dt.date,
    sink: Sink = _no_sink,
) -> None:
    """`close_struck_out` that rewrites only the buckets with a row to close."""
    base = table.before(spark, version)
    touched = _open_buckets(spark, struck, table, base)
    closed = timeline.deactivate_ids(table.read(spark, base, touched), struck, as_of)
    published = table.publish(closed, version, base, touched)
    sink(table.read(spark, published, touched))


def refresh_from_inbox(
    spark: SparkSession,
    inbox: str,
    archive: str,
    checkpoint: str,
    struck: DataFrame,
    table: VersionedTable,
    as_of: dt.date,
    sink: Sink = _no_sink,
    max_files: int | None = None,
) -> None:
    """Merge the timeframe files that have arrived, each once, and move them to the archive.

    Every batch of files is a version of its own, named by the batch, and its files are moved
    once that version is published. After a failure a batch comes again: if its version is
    there only the moving is left to do, else it is merged anew.
    """

    def load(rows: DataFrame, batch: int) -> None:
        name = f"files-{batch}"
        if table.before(spark, name).number == table.current(spark).number:  # not published yet
            incremental.list_files(rows, "source_file", listed, batch)
            refresh_touched(rows.drop("source_file"), struck, table, name, as_of, sink)
        incremental.archive_files(spark, listed, batch, archive)

    listed = f"{checkpoint.rstrip('/')}-files"
    incremental.incremental_csv(
        spark, inbox, schemas.TIMEFRAME_RAW, load, checkpoint, max_files=max_files, lineage="source_file"
    ).awaitTermination()


def refresh_leaves(
    spark: SparkSession,
    source: str,
    calendar: DataFrame,
    timeline_rows: DataFrame,
    events: str,
    ledger: str,
    as_of: dt.datetime,
    sink: Sink = _no_sink,
) -> bool:
    """Add leave files to the record table and settle the months they touch again.

    Records are kept as they came in, by load day and month; loading a day again
    replaces the day's directory. The months that it held before or holds now are
    settled again and replaced, also those left without rows; others are not read.
    """
    raw = files.read_csv(spark, source, schemas.LEAVE_RAW)
    typed = raw.withColumn("emp_id", F.col("emp_id").try_cast("bigint"))
    kept = leaves.with_ingest(leaves.leave_events(typed, calendar, timeline_rows), as_of)
    dated = kept.withColumns({"year": F.year("date"), "month": F.month("date")})
    day, months = f"{as_of:%Y-%m-%d}", ["year", "month"]

    def months_of(df: DataFrame) -> set[tuple[int, int]]:
        """The months of some records: a row per calendar month."""
        return {(r.year, r.month) for r in df.select(*months).distinct().collect()}

    ready = sinks.prepare_partition(dated, events, {"ingest_date": day}, months)
    if not ready.rows and raw.isEmpty():
        sinks.discard(spark, ready)
        return False
    stored = files.read_or_empty(spark, events, schemas.LEAVE_LEDGER)
    before = months_of(stored.filter(F.col("ingest_date") == day))
    sinks.put_in_place(spark, ready)
    stored = files.read_or_empty(spark, events, schemas.LEAVE_LEDGER)
    touched = before | months_of(stored.filter(F.col("ingest_date") == day))
    if touched:
        within = F.concat_ws("-", *months).isin(*[f"{year}-{month}" for year, month in touched])
        pruned = F.col("year").isin(*{year for year, _ in touched}) & within
        records = stored.filter(pruned).select(*schemas.LEAVE_EVENT.fieldNames())
        settled = leaves.settle(records).withColumns({"year": F.year("date"), "month": F.month("date")})
        sinks.overwrite_partitions(settled, ledger, months)
        emptied = touched - months_of(stored.filter(pruned))
        sinks.remove_partitions(spark, ledger, [{"year": str(y), "month": str(m)} for y, m in emptied])
    sink(files.read_or_empty(spark, ledger, schemas.LEAVE_LEDGER))
    return True


def refresh_leave_votes(
    raw: DataFrame,
    calendar: DataFrame,
    timeline_rows: DataFrame,
    votes: str,
    ledger: VersionedTable,
    as_of: dt.datetime,
    sink: Sink = _no_sink,
) -> bool:
    """`refresh_leaves` from votes kept by load day, so that no earlier record is read again.

    A load adds its votes per employee and day; one that corrects a day replaces that day's
    votes. Settled again are the employees and days that it has votes for or had before, from
    the votes of all days in their buckets. Which these are is written down first, so that
    a load that broke off is finished by the next one of its day. The sink gets the
    rewritten buckets of the ledger.
    """
    spark, day = raw.sparkSession, f"{as_of:%Y-%m-%d}"
    root, keys = votes.rstrip("/"), leaves.VOTE_KEYS
    typed = raw.withColumn("emp_id", F.col("emp_id").try_cast("bigint"))
    kept = leaves.with_ingest(leaves.leave_events(typed, calendar, timeline_rows), as_of)
    new, counted = sinks.stage_counted(leaves.leave_votes(kept), f"{root}/_staging/{day}")
    if not counted and raw.isEmpty():
        return False
    stored = T.StructType([*schemas.LEAVE_VOTES.fields, *_PLACE.fields])
    old = files.read_or_empty(spark, f"{root}/days", stored).filter(F.col("ingest_day") == day)
    changed = T.StructType([schemas.LEAVE_VOTES[key] for key in keys])
    pending = sinks.partition_path(f"{root}/pending", {"day": day})
    touched = old.select(*keys).unionByName(new.select(*keys)).distinct()
    touched.write.mode("append").parquet(pending)
    touched = spark.read.schema(changed).parquet(pending).distinct()
    placed = new.withColumn("bucket", ledger.bucket())
    sinks.replace_partition(placed, f"{root}/days", {"ingest_day": day}, ["bucket"])

    buckets = ledger.touched(touched)
    known = files.read_or_empty(spark, f"{root}/days", stored).filter(F.col("bucket").isin(*buckets))
    settled = leaves.settle_votes(leaves.merge_votes(_of_keys(known, touched, keys, "left_semi")))
    dated = settled.withColumns({"year": F.year("date"), "month": F.month("date")})
    base = ledger.current(spark)
    others = _of_keys(ledger.read(spark, base, buckets), touched, keys, "left_anti")
    rows = others.unionByName(dated.select(*others.columns))
    published = ledger.publish(rows, day, base, buckets)
    sinks.remove_partitions(spark, f"{root}/pending", [{"day": day}])
    sink(ledger.read(spark, published, buckets))
    return True


_PLACE = T.StructType([T.StructField("ingest_day", T.StringType()), T.StructField("bucket", T.IntegerType())])


def _of_keys(rows: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is listed, or is not; NULL keys match."""
    return rows.alias("r").join(keys.alias("k"), same("r", "k", list(names)), how)


def report_headcount(
    timeline_rows: DataFrame, table: str, run_date: dt.date, sink: Sink = _no_sink
) -> None:
    """Active employees per designation, one partition per run date."""
    rows = reports.active_by_group(timeline_rows)
    _write_run(rows, table, run_date, sink)


def report_upcoming(
    ledger: DataFrame, calendar: DataFrame, table: str, as_of: dt.date, sink: Sink = _no_sink, **options
) -> None:
    """Employees with much leave ahead, one partition per run date."""
    rows = reports.upcoming_leave_alerts(ledger, calendar, as_of, **options).drop("run_date")
    _write_run(rows, table, as_of, sink)


def _write_run(rows: DataFrame, table: str, run_date: dt.date, sink: Sink) -> None:
    day = f"{run_date:%Y-%m-%d}"
    path = f"{table.rstrip('/')}/run_date={day}"
    rows.write.mode("overwrite").parquet(path)
    sink(rows.sparkSession.read.schema(rows.schema).parquet(path).withColumn("run_date", F.lit(day)))


def report_quota(
    spark: SparkSession,
    ledger: DataFrame,
    quota: DataFrame,
    usage_table: str,
    tracking: str,
    texts: str,
    year: int,
    before_month: int,
    run_date: dt.date,
    threshold: float = reports.QUOTA_THRESHOLD,
) -> None:
    """Employees above the quota threshold; an alert text for those not alerted before.

    Texts and tracking have one directory per run date. A run looks at earlier dates
    only; repeating it replaces its own directories, also with nothing.
    """
    day = f"{run_date:%Y-%m-%d}"
    flagged = reports.quota_alerts(reports.quota_usage(ledger, quota, year, before_month), threshold)
    flagged.write.mode("overwrite").parquet(usage_table)
    stored = spark.read.schema(flagged.schema).parquet(usage_table)

    tracked = T.StructType([*schemas.ALERTED.fields, T.StructField("run_date", T.StringType())])
    already = files.read_or_empty(spark, tracking, tracked).filter(F.col("run_date") < day)
    fresh = reports.new_alerts(stored, already)
    sinks.write_alerts(reports.alert_text(fresh, run_date), texts, day)
    ids = fresh.select(F.col("emp_id").cast("bigint").alias("emp_id")).distinct()
    ids.write.mode("overwrite").parquet(f"{tracking.rstrip('/')}/run_date={day}")


def sync_strikes(
    spark: SparkSession,
    timeline_rows: DataFrame,
    root: str,
    version: str,
    previous: str | None,
    sink: Sink = _no_sink,
) -> None:
    """Bring salary changes of the timeline into the strike table, as a new version."""
    if previous is None:
        current = spark.createDataFrame([], schemas.STRIKES)
    else:
        current = spark.read.schema(schemas.STRIKES).parquet(f"{root}/version={previous}")
    updates = sinks.stage(strikes.sync_salaries(timeline_rows, current), f"{root}/_staging/updates")
    sink(sinks.write_version(keyed.upsert_on_key(current, updates, "employee_id"), root, version))


def merge_into_target(
    spark: SparkSession,
    staging: DataFrame,
    root: str,
    version: str,
    previous: str | None,
    keys: Sequence[str] = ("emp_id", "start_date", "end_date"),
    by: Sequence[str] = ("status",),
    sink: Sink = _no_sink,
) -> None:
    """Merge rows into the last version of a target, as a new version.

    Per column the new value counts, and the stored one where the new one is NULL. Both
    sides are used twice, so the new rows are staged.
    """
    rows = keyed.distinct_rows(staging, list(keys))
    if previous is not None:
        target = spark.read.schema(staging.schema).parquet(f"{root}/version={previous}")
        staged = sinks.stage(rows, f"{root}/_staging/merge")
        rows = keyed.merge_first_non_null(staged, target, list(keys)).select(*staging.columns)
    sink(sinks.write_version(rows, root, version, list(by)))


def merge_headcount(
    spark: SparkSession,
    timeline_rows: DataFrame,
    root: str,
    version: str,
    previous: str | None,
    sink: Sink = _no_sink,
) -> None:
    """Bring headcounts into a table with one row per designation, as a new version."""
    heads = reports.active_by_group(timeline_rows)
    merge_into_target(spark, heads, root, version, previous, ["designation"], (), sink)


def close_struck_out(
    spark: SparkSession,
    struck: DataFrame,
    root: str,
    version: str,
    previous: str,
    as_of: dt.date,
    sink: Sink = _no_sink,
) -> None:
    """Close the timeline rows of employees that a strike batch has struck out."""
    rows = spark.read.schema(schemas.TIMELINE).parquet(f"{root}/version={previous}")
    sink(sinks.write_version(timeline.deactivate_ids(rows, struck, as_of), root, version, ["status"]))
