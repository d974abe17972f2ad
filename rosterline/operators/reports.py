"""Headcount and leave reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.dates import date_spine, is_weekend
from rosterline.operators.keyed import exclude_ids
from rosterline.operators.leaves import calendar_days

# Alert thresholds in percent and the five lines of an alert text.
QUOTA_THRESHOLD = 80
UPCOMING_THRESHOLD = 8
ALERT_TEXT = (
    "Employee ID: %s\n"
    "Leave Taken: %d\n"
    "Leave Quota: %d\n"
    "Usage: %.2f%%\n"
    "Report Date: %s\n"
)


def active_by_group(timeline: DataFrame, group: str = "designation") -> DataFrame:
    """Active rows per designation, zero where none is active.

    One conditional count keeps designations without active rows, and counts a NULL
    designation like any other.
    """
    active = (F.col("status") == "ACTIVE") & F.col("emp_id").isNotNull()
    return timeline.groupBy(group).agg(F.count_if(active).alias("active_employees"))


def quota_usage(leaves: DataFrame, quota: DataFrame, year: int, before_month: int) -> DataFrame:
    """Leave taken in `year` before `before_month` against that year's quota.

    Filters the ledger's partition columns `year` and `month`, so only those
    directories are read. A zero or missing quota gives a NULL percentage.
    """
    taken = (
        leaves.filter(
            (F.col("year") == year) & (F.col("month") < before_month) & (F.col("status") == "ACTIVE")
        )
        .groupBy("emp_id")
        .agg(F.count(F.lit(1)).alias("leaves_taken"))
    )
    return usage_of(taken, quota, year)


def usage_of(taken: DataFrame, quota: DataFrame, year: int) -> DataFrame:
    """Percentage of the quota used, for counted leave (emp_id, leaves_taken)."""
    yearly = quota.filter(F.col("year") == year).select(
        F.col("emp_id").try_cast(taken.schema["emp_id"].dataType).alias("_emp"),
        F.col("leave_quota").cast("int").alias("leave_quota"),
    )
    share = F.try_divide(F.col("leaves_taken"), F.col("leave_quota")) * 100
    return taken.join(yearly, F.col("emp_id") == F.col("_emp"), "left").select(
        "emp_id", "leaves_taken", "leave_quota", F.round(share, 2).alias("leave_percent")
    )


def quota_alerts(usage: DataFrame, threshold: float = QUOTA_THRESHOLD) -> DataFrame:
    """Usage strictly above the threshold."""
    return usage.filter(F.col("leave_percent") > threshold)


def new_alerts(alerts: DataFrame, already: DataFrame) -> DataFrame:
    """Alerts of employees not alerted before."""
    return exclude_ids(alerts, already, "emp_id", "emp_id")


def alerted_union(already: DataFrame, alerts: DataFrame) -> DataFrame:
    """All employees alerted so far, each once."""
    return already.select("emp_id").unionByName(alerts.select("emp_id")).distinct()


def alert_text(alerts: DataFrame, run_date: dt.date) -> DataFrame:
    """The text of each alert, with its employee and run date."""
    day = F.lit(f"{run_date:%Y-%m-%d}")
    text = F.format_string(
        ALERT_TEXT, F.col("emp_id").cast("string"), "leaves_taken", "leave_quota", "leave_percent", day
    )
    return alerts.select("emp_id", day.alias("run_date"), text.alias("value"))


def working_days(spark: SparkSession, first: dt.date, last: dt.date, calendar: DataFrame) -> DataFrame:
    """Calendar days from `first` to `last` that are neither weekend nor holiday."""
    weekdays = date_spine(spark, first, last).filter(~is_weekend(F.col("date")))
    return weekdays.join(calendar_days(calendar), F.col("date") == F.col("_day"), "left_anti")


def upcoming_leave_counts(
    leaves: DataFrame,
    calendar: DataFrame,
    as_of: dt.date,
    until: dt.date,
    end_inclusive: bool = False,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct working days of leave per employee, with their share of all working days.

    By default leave on the last day is not counted while that day is part of the
    total, and records of every status count.
    """
    spark = leaves.sparkSession
    days = working_days(spark, as_of, until, calendar)
    day = F.to_date("date")
    within = (day >= F.lit(as_of)) & ((day <= F.lit(until)) if end_inclusive else (day < F.lit(until)))
    booked = leaves.filter(within)
    if "year" in leaves.columns:  # the ledger's partition column: read only these years
        booked = booked.filter(F.col("year").between(as_of.year, until.year))
    if statuses is not None:
        booked = booked.filter(F.col("status").isin(*statuses))
    # At most one row per calendar day between two dates, so the broadcast is bounded.
    on_working_day = booked.select("emp_id", day.alias("leave_date")).join(
        F.broadcast(days.withColumnRenamed("date", "_working")),
        F.col("leave_date") == F.col("_working"),
        "left_semi",
    )
    total = days.agg(F.count(F.lit(1))).scalar()
    return (
        on_working_day.groupBy("emp_id")
        .agg(F.count_distinct("leave_date").alias("upcoming_leaves_count"))
        .withColumn("leave_percent", F.try_divide(F.col("upcoming_leaves_count"), total) * 100)
    )


def upcoming_leave_alerts(
    leaves: DataFrame,
    calendar: DataFrame,
    as_of: dt.date,
    pct: float = UPCOMING_THRESHOLD,
    until: dt.date | None = None,
    end_inclusive: bool = False,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Employees whose upcoming leave exceeds `pct` percent of the working days left.

    `until` defaults to the last day of the year of `as_of`.
    """
    last = until or dt.date(as_of.year, 12, 31)
    counts = upcoming_leave_counts(leaves, calendar, as_of, last, end_inclusive, statuses)
    return counts.filter(F.col("leave_percent") > pct).select(
        "emp_id", "upcoming_leaves_count", F.lit(f"{as_of:%Y-%m-%d}").alias("run_date")
    )
