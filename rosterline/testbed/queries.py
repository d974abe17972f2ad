"""One query per operator over the check tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.dates import SECONDS_PER_DAY
from rosterline.operators import cleaning, keyed, leaves, messages, reports, strikes, timeline
from rosterline.session import configure
from rosterline.sources.sinks import stage
from rosterline.streaming.keyed_strikes import (
    current_strikes,
    read_flags,
    start_flag_stream,
    start_keyed_strikes,
)
from rosterline.streaming.strike_stream import StrikeState, start_strike_stream, strike_batch
from rosterline.testbed import roundtrips
from rosterline.testbed import tables as t

LOAD_DAY = dt.date(2024, 5, 1)
TIES = ["salary", "designation", "order_id", "line_no"]


def clean_required(spark, sf):
    return cleaning.clean_required(
        t.employees(spark, sf), ["emp_id", "name", "balance"], ["balance"], ["emp_id", "name", "balance"]
    )


def stamp_load_date(spark, sf):
    return cleaning.stamp_load_date(clean_required(spark, sf), LOAD_DAY)


def clean_calendar(spark, sf):
    return cleaning.clean_calendar(
        t.table(spark, sf, "orders").select(
            F.col("o_orderpriority").alias("reason"), F.col("o_orderdate").alias("date")
        )
    )


def clean_quota(spark, sf):
    return cleaning.clean_quota(t.quota(spark, sf))


def epoch_to_dates(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    events = t.table(spark, sf, "events").select("event_id", seconds.alias("day"))
    return cleaning.epoch_to_dates(events, ["day"])


def dedupe_max(spark, sf):
    rows = t.assignments(spark, sf).select("emp_id", "start_date", "designation", "salary")
    return keyed.dedupe_max(rows, ["emp_id", "start_date"], "salary")


def fill_open_end(spark, sf):
    return timeline.fill_open_end(
        t.assignments(spark, sf), "emp_id", "start_date", "end_date", TIES, F.col("start_date")
    )


def chain_intervals(spark, sf):
    return timeline.chain_intervals(
        t.assignments(spark, sf), "emp_id", "start_date", "end_date", TIES, F.col("start_date")
    )


def interval_status(spark, sf):
    return timeline.interval_status(t.assignments(spark, sf))


def exclude_ids(spark, sf):
    return keyed.exclude_ids(t.timeframe(spark, sf), t.struck(spark, sf), "emp_id")


def new_rows_only(spark, sf):
    return keyed.new_rows_only(
        t.timeframe(spark, sf, t.SECOND_LOAD),
        t.timeframe(spark, sf, t.FIRST_LOAD),
        ["emp_id", "start_date", "end_date", "salary"],
    )


def timeline_silver(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    raw = t.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("emp_id"),
        F.col("event_type").alias("designation"),
        seconds.cast("string").alias("start_date"),
        F.when(F.col("event_type") == "signup", seconds + 7 * SECONDS_PER_DAY)
        .cast("string")
        .alias("end_date"),
        F.col("value").cast("string").alias("salary"),
    )
    return timeline.timeline_silver(raw)


def timeline_build(spark, sf):
    return t.timeline(spark, sf)


def timeline_build_overlapping(spark, sf):
    rows = t.assignments(spark, sf).drop("order_id", "line_no")
    return timeline.timeline_from_dates(rows, t.struck(spark, sf))


def timeline_build_keep_ends(spark, sf):
    rows = t.assignments(spark, sf).drop("order_id", "line_no")
    return timeline.timeline_from_dates(rows, t.struck(spark, sf), keep_ends=True)


def timeline_merge(spark, sf):
    return timeline.timeline_merge(t.timeline(spark, sf, t.FIRST_LOAD), t.timeline(spark, sf, t.SECOND_LOAD))


def deactivate_ids(spark, sf):
    everyone = timeline.timeline_build(t.timeframe(spark, sf), t.struck(spark, sf).filter("false"))
    return timeline.deactivate_ids(everyone, t.struck(spark, sf), t.STRUCK_ON)


def merge_first_non_null(spark, sf):
    specified = F.when(F.col("designation") != "4-NOT SPECIFIED", F.col("designation"))
    staging = t.timeline(spark, sf, t.SECOND_LOAD).withColumn("designation", specified)
    target = t.timeline(spark, sf, t.FIRST_LOAD)
    folder = t.scratch(spark)  # both sides are used twice
    return keyed.merge_first_non_null(
        stage(staging, f"{folder}/staging"), stage(target, f"{folder}/target"), ["emp_id", "start_date", "end_date"]
    )


def upsert_on_key(spark, sf):
    suppliers = t.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("emp_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return keyed.upsert_on_key(t.employees(spark, sf), suppliers, "emp_id")


def update_listed(spark, sf):
    return keyed.update_listed(
        t.timeline(spark, sf),
        t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("employee_id")),
        "emp_id",
        {"status": F.lit("INACTIVE")},
    )


def drop_weekends(spark, sf):
    return leaves.drop_weekends(t.leaves(spark, sf))


def drop_holidays(spark, sf):
    return leaves.drop_holidays(t.leaves(spark, sf), t.holidays(spark, sf))


def keep_active(spark, sf):
    return leaves.keep_active(t.leaves(spark, sf), deactivate_ids(spark, sf))


def leave_verdict(spark, sf):
    return leaves.leave_verdict(t.leaves(spark, sf))


def latest_per_key(spark, sf):
    return keyed.latest_per_key(t.leaves(spark, sf), ["emp_id", "date"], "ingest_timestamp")


def leave_ledger(spark, sf):
    raw = t.leaves(spark, sf, ["error", "view", "purchase"])
    history = t.leaves(spark, sf, ["click", "signup"]).withColumns(
        {"year": F.year("date"), "month": F.month("date")}
    )
    return leaves.leave_ledger(raw, t.holidays(spark, sf), deactivate_ids(spark, sf), history)


def active_by_group(spark, sf):
    return reports.active_by_group(t.timeline(spark, sf))


def quota_usage(spark, sf):
    return reports.quota_usage(t.bookings(spark, sf), t.quota(spark, sf), t.LEAVE_YEAR, t.BEFORE_MONTH)


def quota_alerts(spark, sf):
    return reports.quota_alerts(quota_usage(spark, sf))


def alerted_before(spark, sf):
    return t.struck(spark, sf).select(F.col("employee_id").cast("bigint").alias("emp_id"))


def new_alerts(spark, sf):
    return reports.new_alerts(quota_alerts(spark, sf), alerted_before(spark, sf))


def alerted_union(spark, sf):
    return reports.alerted_union(alerted_before(spark, sf), new_alerts(spark, sf))


def alert_text(spark, sf):
    return reports.alert_text(new_alerts(spark, sf), LOAD_DAY).withColumnRenamed("value", "alert")


def working_days(spark, sf):
    day = F.to_date("o_orderdate")
    first, last = t.table(spark, sf, "orders").agg(F.min(day), F.max(day)).first()
    return reports.working_days(spark, first, last, t.closed_days(spark, sf))


def upcoming_leave_counts(spark, sf):
    return reports.upcoming_leave_counts(
        t.bookings(spark, sf),
        t.closed_days(spark, sf),
        t.LEAVE_FROM,
        t.LEAVE_UNTIL,
        end_inclusive=True,
        statuses=["ACTIVE"],
    )


def upcoming_leave_alerts(spark, sf):
    return reports.upcoming_leave_alerts(
        t.bookings(spark, sf), t.closed_days(spark, sf), t.LEAVE_FROM, 1.5, t.LEAVE_UNTIL
    )


def parse_messages(spark, sf):
    return messages.parse_messages(t.json_messages(spark, sf), keep=["conv_id", "turn"])


def flag_messages(spark, sf):
    return messages.flag_messages(
        t.messages(spark, sf), t.vocabulary(spark, sf), t.marked_words(spark, sf), ["conv_id", "turn"]
    )


def encode_messages(spark, sf):
    return messages.encode_messages(t.messages(spark, sf)).withColumnRenamed("key", "sender")


def rolling_flag_count(spark, sf):
    return t.counts(spark, sf)


def trailing_flag_count(spark, sf):
    return strikes.trailing_flag_count(t.flags(spark, sf), 7)


def strike_ladder_full(spark, sf):
    return strikes.strike_ladder_full(t.unstruck(spark, sf), t.counts(spark, sf))


def strike_ladder_incremental(spark, sf):
    return strikes.strike_ladder_incremental(t.raised_strikes(spark, sf), t.counts(spark, sf))


def drop_capped(spark, sf):
    return strikes.drop_capped(t.counts(spark, sf), t.strikes(spark, sf))


def changed_rows(spark, sf):
    new = strikes.strike_ladder_full(t.strikes(spark, sf), t.counts(spark, sf))
    return keyed.changed_rows(new, t.strikes(spark, sf), "employee_id")


def sync_salaries(spark, sf):
    return strikes.sync_salaries(t.timeline(spark, sf), t.strikes(spark, sf))


def newly_capped(spark, sf):
    return strikes.newly_capped(changed_rows(spark, sf))


def strike_updates(spark, sf):
    counts = t.counts(spark, sf)
    return strikes.strike_updates(t.raised_strikes(spark, sf), counts, incremental=True)


def strike_batch_update(spark, sf):
    known = t.flags(spark, sf)
    middle = F.lit(str(t.MID_JANUARY)).cast("timestamp_ntz")
    return strike_batch(
        known.filter(F.col("start_date") >= middle),
        known.filter(F.col("start_date") < middle),
        t.strikes(spark, sf),
        t.AS_OF,
    )


def strike_stream(spark, sf):
    """Conversations as a stream of several files, with the state compacted on the way.

    Messages are dated over sixty days, so a third of the flags has expired.
    """
    folder = t.scratch(spark)
    state = StrikeState(f"{folder}/state", compact_every=2)
    state.seed(spark, t.unstruck(spark, sf))
    days = F.make_dt_interval(((F.col("conv_id") * 7 + F.col("turn") * 13) % 60).cast("int"))
    at = (F.lit("2023-12-20").cast("timestamp_ntz") + days).cast("timestamp")
    sent = t.json_messages(spark, sf).withColumn("at", at)
    for part in range(5):
        sent.filter(F.col("turn") % 5 == part).write.mode("append").parquet(f"{folder}/sent")
    fifth = -(-len(spark.read.schema(sent.schema).parquet(f"{folder}/sent").inputFiles()) // 5)
    source = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", fifth).parquet(f"{folder}/sent")
    query = start_strike_stream(
        source,
        t.vocabulary(spark, sf),
        t.marked_words(spark, sf),
        state,
        f"{folder}/checkpoint",
        ["conv_id", "turn"],
        clock=lambda: t.AS_OF,
        event_time="at",
        interval=None,
    )
    query.awaitTermination()
    return state.strikes_before(spark, query.lastProgress["batchId"] + 1)


def strike_keyed_stream(spark, sf):
    """Conversations as two streams, of which the second run brings late and repeated messages.

    The first run has most messages of the first 45 days, the second a part of them again,
    those left out, and all later ones. What is older than the clock of the first run is late.
    """
    folder, position = t.scratch(spark), ["conv_id", "turn"]
    offset = ((F.col("conv_id") * 7 + F.col("turn") * 13) % 60).cast("int")
    at = (F.lit("2023-12-20").cast("timestamp_ntz") + F.make_dt_interval(offset)).cast("timestamp")
    sent = t.json_messages(spark, sf).withColumns({"at": at, "day": offset})
    early, third = F.col("day") < 45, F.col("turn") % 3
    runs = [sent.filter(early & (third != 0)), sent.filter(~early | (third != 2))]
    schema = sent.drop("day").schema
    strikes = t.unstruck(spark, sf)
    vocab = stage(t.vocabulary(spark, sf), f"{folder}/vocabulary")
    marked = stage(t.marked_words(spark, sf), f"{folder}/marked")
    for rows in runs:
        rows.drop("day").write.mode("append").parquet(f"{folder}/sent")
        start_flag_stream(
            spark.readStream.schema(schema).parquet(f"{folder}/sent"),
            vocab,
            marked,
            f"{folder}/flags",
            f"{folder}/flagging",
            position,
            "at",
            interval=None,
        ).awaitTermination()
        start_keyed_strikes(
            read_flags(spark, f"{folder}/flags", "conv_id bigint, turn bigint"),
            strikes,
            f"{folder}/changes",
            f"{folder}/striking",
            position,
            "2 days",
            None,
        ).awaitTermination()
    return current_strikes(spark, f"{folder}/changes", strikes)


ALL = [
    clean_required,
    stamp_load_date,
    clean_calendar,
    clean_quota,
    epoch_to_dates,
    dedupe_max,
    fill_open_end,
    chain_intervals,
    interval_status,
    exclude_ids,
    new_rows_only,
    timeline_silver,
    timeline_build,
    timeline_build_overlapping,
    timeline_build_keep_ends,
    timeline_merge,
    deactivate_ids,
    merge_first_non_null,
    upsert_on_key,
    update_listed,
    drop_weekends,
    drop_holidays,
    keep_active,
    leave_verdict,
    latest_per_key,
    leave_ledger,
    active_by_group,
    quota_usage,
    quota_alerts,
    new_alerts,
    alerted_union,
    alert_text,
    working_days,
    upcoming_leave_counts,
    upcoming_leave_alerts,
    parse_messages,
    flag_messages,
    encode_messages,
    rolling_flag_count,
    trailing_flag_count,
    strike_ladder_full,
    strike_ladder_incremental,
    drop_capped,
    changed_rows,
    sync_salaries,
    newly_capped,
    strike_updates,
    strike_batch_update,
    strike_stream,
    strike_keyed_stream,
    *roundtrips.ALL,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(query):
        return lambda spark, sf: query(configure(spark), sf)

    return {query.__name__: runner(query) for query in ALL}


