"""The check tables read as workforce data.

Customers are employees, orders their designation and salary history, events their
leave records and flags, conversations their messages.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.text import words
from rosterline.operators.keyed import dedupe_max
from rosterline.operators.strikes import rolling_flag_count, strike_ladder_full
from rosterline.operators.timeline import timeline_build
from rosterline.schemas import STRIKE_STEPS
from rosterline.session import shared_folder

STRUCK_ON = dt.date(2002, 1, 1)
# Flags lie in January 2024: at `AS_OF` those of the first days have expired.
MID_JANUARY = dt.datetime(2024, 1, 16)
AS_OF = dt.datetime(2024, 2, 10)
# Orders run from 1995 to 2001: leave is looked at in the middle.
LEAVE_YEAR, BEFORE_MONTH = 1998, 7
LEAVE_FROM, LEAVE_UNTIL = dt.date(1998, 3, 2), dt.date(1998, 9, 30)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the one that all executors share."""
    return f"{shared_folder(spark)}/rosterline-{uuid.uuid4().hex}"


def employees(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )


def struck(spark, sf):
    """Ids on the strike-out list: customers in debt."""
    debtors = table(spark, sf, "customer").filter(F.col("c_acctbal") < 0)
    return debtors.select(F.col("c_custkey").cast("string").alias("employee_id"))


def timeframe(spark, sf, statuses=None):
    """Orders as a raw timeframe load: epoch seconds, no end dates."""
    orders = table(spark, sf, "orders")
    if statuses:
        orders = orders.filter(F.col("o_orderstatus").isin(*statuses))
    return orders.select(
        F.col("o_custkey").alias("emp_id"),
        F.col("o_orderpriority").alias("designation"),
        (F.unix_date(F.to_date("o_orderdate")) * 86400.0).alias("start_date"),
        F.lit(None).cast("double").alias("end_date"),
        F.col("o_totalprice").alias("salary"),
    )


# Two loads that share the open orders.
FIRST_LOAD, SECOND_LOAD = ("F", "O"), ("O", "P")


def timeline(spark, sf, statuses=None):
    return timeline_build(timeframe(spark, sf, statuses), struck(spark, sf))


def assignments(spark, sf):
    """Line items as dated assignments with many equal starts and some open ends."""
    start = F.to_date("l_shipdate")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("emp_id"),
        F.col("l_returnflag").alias("designation"),
        start.alias("start_date"),
        F.when(F.col("l_linestatus") == "F", F.date_add(start, F.col("l_quantity").cast("int"))).alias(
            "end_date"
        ),
        F.col("l_extendedprice").alias("salary"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
    )


def leave_status():
    return (
        F.when(F.col("event_type") == "error", "CANCELLED")
        .when(F.col("event_type").isin("click", "view"), "ACTIVE")
        .otherwise("PENDING")
    )


def leaves(spark, sf, types=None):
    """Events as leave records that came in at their own time."""
    events = table(spark, sf, "events")
    if types:
        events = events.filter(F.col("event_type").isin(*types))
    return events.select(
        F.col("user_id").alias("emp_id"),
        F.to_date("ts").alias("date"),
        leave_status().alias("status"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"),
        F.col("ts").alias("ingest_timestamp"),
    )


def holidays(spark, sf):
    """Days on which signups outnumber purchases by more than a tenth."""
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("date"))
        .agg(
            F.count_if(F.col("event_type") == "signup").alias("signups"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        )
        .filter(F.col("signups") > F.col("purchases") * 1.1)
        .select("date")
    )


def bookings(spark, sf):
    """Orders as settled leave of several years, with the ledger's partition columns."""
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("emp_id"),
        day.alias("date"),
        F.when(F.col("o_orderstatus") == "P", "CANCELLED").otherwise("ACTIVE").alias("status"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )


def closed_days(spark, sf):
    """Days with a number of orders that three divides."""
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date"))
    return days.agg(F.count(F.lit(1)).alias("n")).filter("n % 3 = 0").select("date")


def quota(spark, sf):
    """Quotas of two years; the second is larger by one."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("emp_id"),
        F.explode(F.sequence(F.col("c_nationkey"), F.col("c_nationkey") + 1)).alias("leave_quota"),
        (F.col("leave_quota") - F.col("c_nationkey") + LEAVE_YEAR).alias("year"),
    )


def messages(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.col("conv_id").cast("string").alias("sender"),
        F.col("role").alias("receiver"),
        F.col("text").alias("message"),
    )


def json_messages(spark, sf):
    """Messages as they arrive: JSON bytes with the keys of the record."""
    value = F.to_json(F.struct("sender", "receiver", "message")).cast("binary")
    return messages(spark, sf).select("conv_id", "turn", value.alias("value"))


def marked_words(spark, sf):
    """Words of the benchmark items."""
    found = table(spark, sf, "benchmark").select(F.explode(words(F.col("text"))).alias("word"))
    return found.distinct()


def vocabulary(spark, sf):
    """Words of the documents."""
    found = table(spark, sf, "documents").select(F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    return found.distinct()


def flags(spark, sf):
    """Error events as flags."""
    return (
        table(spark, sf, "events")
        .filter(F.col("event_type") == "error")
        .select(F.col("user_id").cast("string").alias("employee_id"), F.col("ts").alias("start_date"))
    )


def unstruck(spark, sf):
    """A strike row without strikes for every customer."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("employee_id"),
        F.col("c_acctbal").alias("salary"),
        *[F.lit(None).cast("double").alias(step) for step in STRIKE_STEPS],
        F.lit(0).alias("no_of_strikes"),
    )


def counts(spark, sf, before=None):
    known = flags(spark, sf)
    if before is not None:
        known = known.filter(F.col("start_date") < F.lit(before.isoformat(sep=" ")).cast("timestamp_ntz"))
    return rolling_flag_count(known, before or AS_OF)


def strikes(spark, sf):
    """Strike rows in mid January, of the employees flagged by then."""
    return strike_ladder_full(unstruck(spark, sf), counts(spark, sf, MID_JANUARY))


def raised_strikes(spark, sf):
    """The strike rows of mid January with the salary of the employee's best paid order."""
    best = dedupe_max(
        timeframe(spark, sf).select(F.col("emp_id").cast("string").alias("employee_id"), "salary"),
        ["employee_id"],
        "salary",
    )
    return strikes(spark, sf).drop("salary").join(best, "employee_id").select(*unstruck(spark, sf).columns)
