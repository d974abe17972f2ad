"""Leave records: working days only, settled by vote per employee and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import instant, is_weekend
from rosterline.functions.rows import others
from rosterline.operators.keyed import only_ids

# The two states of a leave record.
ACTIVE, CANCELLED = "ACTIVE", "CANCELLED"


def drop_weekends(df: DataFrame, date: str = "date") -> DataFrame:
    """Keep Monday to Friday; a row without a date is no working day either."""
    return df.filter(~is_weekend(F.col(date)))


def calendar_days(calendar: DataFrame, date: str = "date") -> DataFrame:
    """Distinct non-NULL calendar days of a table, as one DATE column `_day`."""
    days = calendar.select(F.to_date(date).alias("_day"))
    return days.filter(F.col("_day").isNotNull()).distinct()


def drop_holidays(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Drop rows that fall on a calendar day.

    Spark broadcasts the days when they are few, as calendar days are, and shuffles where
    dirty dates make them many.
    """
    return df.join(calendar_days(calendar), F.to_date(date) == F.col("_day"), "left_anti")


def keep_active(df: DataFrame, timeline: DataFrame, key: str = "emp_id") -> DataFrame:
    """Rows of employees that have an ACTIVE timeline row."""
    return only_ids(df, timeline.filter(F.col("status") == ACTIVE), key, key)


def _is(status: str) -> Column:
    return F.col("status") == status


def _verdict() -> Column:
    """More ACTIVE than CANCELLED votes keep the leave; a tie or no vote cancels it."""
    return F.when(F.col("cancelled_count") >= F.col("active_count"), CANCELLED).otherwise(ACTIVE)


def _votes() -> list[Column]:
    return [
        F.count_if(_is(CANCELLED)).alias("cancelled_count"),
        F.count_if(_is(ACTIVE)).alias("active_count"),
    ]


def leave_verdict(df: DataFrame) -> DataFrame:
    """Votes and final status per employee and day."""
    return df.groupBy("emp_id", "date").agg(*_votes()).withColumn("final_status", _verdict())


def settle(records: DataFrame, ts: str = "ingest_timestamp") -> DataFrame:
    """Per employee and day the newest record that carries the winning status.

    One aggregate counts the votes and keeps the newest row of either status, so
    neither a self join nor a window is needed and the rows of a busy employee are
    combined before the exchange.
    """
    keys = ["emp_id", "date"]
    rest = [ts, *others(records, [*keys, "status", ts])]
    newest = [
        F.max(F.when(_is(status), F.struct(*rest))).alias(f"_{status}") for status in (ACTIVE, CANCELLED)
    ]
    winner = F.when(_verdict() == CANCELLED, F.col(f"_{CANCELLED}")).otherwise(F.col(f"_{ACTIVE}"))
    return (
        records.groupBy(*keys)
        .agg(*_votes(), *newest)
        .select(*keys, _verdict().alias("status"), winner.alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select(*[F.col(f"_row.{c}") if c in rest else F.col(c) for c in records.columns])
    )


VOTE_KEYS = ["emp_id", "date"]
_NEWEST = {ACTIVE: "newest_active", CANCELLED: "newest_cancelled"}


def leave_votes(records: DataFrame, ts: str = "ingest_timestamp") -> DataFrame:
    """Votes per employee and day as a partial result: both counts, and the newest row of either status.

    Partial results of several loads add up with `merge_votes`, so records need not be read
    again when others come in.
    """
    rest = [ts, *others(records, [*VOTE_KEYS, "status", ts])]
    newest = [F.max(F.when(_is(status), F.struct(*rest))).alias(name) for status, name in _NEWEST.items()]
    return records.groupBy(*VOTE_KEYS).agg(*_votes(), *newest)


def merge_votes(votes: DataFrame) -> DataFrame:
    """Partial results of several loads as one per employee and day."""
    counts = [F.sum(c).alias(c) for c in ("cancelled_count", "active_count")]
    return votes.groupBy(*VOTE_KEYS).agg(*counts, *[F.max(name).alias(name) for name in _NEWEST.values()])


def settle_votes(votes: DataFrame) -> DataFrame:
    """What `settle` makes of the records behind merged votes."""
    verdict = _verdict()
    winner = F.when(verdict == CANCELLED, F.col(_NEWEST[CANCELLED])).otherwise(F.col(_NEWEST[ACTIVE]))
    return (
        votes.select(*VOTE_KEYS, verdict.alias("status"), winner.alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select(*VOTE_KEYS, "status", "_row.*")
    )


def with_ingest(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Stamp the load day and the load time."""
    return df.withColumns(
        {"ingest_date": F.lit(f"{as_of:%Y-%m-%d}"), "ingest_timestamp": instant(as_of)}
    )


def leave_events(raw: DataFrame, calendar: DataFrame, timeline: DataFrame) -> DataFrame:
    """Leave records of active employees on working days."""
    return keep_active(drop_holidays(drop_weekends(raw), calendar), timeline)


def leave_ledger(
    raw: DataFrame, calendar: DataFrame, timeline: DataFrame, history: DataFrame | None = None
) -> DataFrame:
    """Settled leave per employee and day, with `year` and `month`.

    `raw` and `history` are leave records with `ingest_date` and `ingest_timestamp`;
    `history` holds earlier records as they came in (not settled ones) and may carry
    the partition columns of the table it is read from.
    """
    records = leave_events(raw, calendar, timeline)
    if history is not None:
        records = records.unionByName(history.select(*records.columns))
    return settle(records).withColumns({"year": F.year("date"), "month": F.month("date")})
