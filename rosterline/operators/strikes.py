"""The strike ladder: flags in the last 30 days lower an employee's salary by steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.functions.dates import instant
from rosterline.functions.money import step_price
from rosterline.functions.rows import differs, same
from rosterline.operators.keyed import dedupe_max, exclude_ids
from rosterline.schemas import STRIKE_CAP, STRIKE_STEPS, STRIKES

# Fixed value: flags count for 30 days.
FLAG_DAYS = 30


def recent_flags(flags: DataFrame, as_of: dt.datetime, days: int = FLAG_DAYS) -> DataFrame:
    """Flags not older than `days` before `as_of`."""
    since = instant(as_of - dt.timedelta(days=days), flags.schema["start_date"].dataType)
    return flags.filter(F.col("start_date") >= since)


def rolling_flag_count(flags: DataFrame, as_of: dt.datetime, days: int = FLAG_DAYS) -> DataFrame:
    """Flags per employee in the window ending now; combined map-side."""
    return recent_flags(flags, as_of, days).groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("strike_count")
    )


def trailing_flag_count(flags: DataFrame, days: int = FLAG_DAYS) -> DataFrame:
    """For every flag, the employee's flags in the `days` up to and including it.

    The same as a RANGE window per employee, in two levels so that a hot employee
    spreads over days. Each flag adds one at its time and takes it away just after it
    has expired. Changes at one instant are summed first, which combines before the
    exchange; whole days are accumulated per employee (a few rows per day), and the
    window over instants runs within one employee and day.
    """
    tick = F.expr("INTERVAL 0.000001 SECOND")
    expiry = F.col("start_date") + F.make_dt_interval(F.lit(days)) + tick
    change = F.array(
        F.struct(F.col("start_date").alias("at"), F.lit(1).alias("by")),
        F.struct(expiry.alias("at"), F.lit(-1).alias("by")),
    )
    steps = (
        flags.select("employee_id", F.explode(change).alias("change"))
        .groupBy("employee_id", F.col("change.at").alias("at"))
        .agg(F.sum("change.by").alias("net"), F.bool_or(F.col("change.by") > 0).alias("flagged"))
        .withColumn("day", F.to_date("at"))
    )
    within = Window.partitionBy("employee_id", "day").orderBy("at")
    inside = steps.withColumn("inside", F.sum("net").over(within))
    per_day = steps.groupBy("employee_id", "day").agg(F.sum("net").alias("net"))
    before = Window.partitionBy("employee_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    opening = per_day.select(
        "employee_id", "day", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("open")
    )
    counted = (
        inside.filter("flagged")
        .alias("i")
        .join(opening.alias("o"), same("i", "o", ["employee_id", "day"]))
        .select("i.employee_id", F.col("i.at").alias("start_date"), (F.col("open") + F.col("inside")).alias("strike_count"))
    )
    # One row per flag again; a hot instant is split like any hot key of a join.
    keyed = flags.select("employee_id", "start_date").alias("f")
    return keyed.join(counted.alias("c"), same("f", "c", ["employee_id", "start_date"])).select(
        "f.employee_id", "f.start_date", "c.strike_count"
    )


def _capped(count: str) -> Column:
    return F.least(F.col(count), F.lit(STRIKE_CAP)).cast("int")


def _ladder(strikes: DataFrame, counts: DataFrame, price_step) -> DataFrame:
    """Strike rows that have a count, each step set by `price_step(i)`."""
    counted = counts.select(F.col("employee_id").alias("_emp"), _capped("strike_count").alias("_count"))
    joined = strikes.join(counted, F.col("employee_id") == F.col("_emp"))
    steps = [price_step(i).alias(step) for i, step in enumerate(STRIKE_STEPS, 1)]
    return joined.select("employee_id", "salary", *steps, F.col("_count").alias("no_of_strikes"))


def _full_step(i: int) -> Column:
    return F.when(F.col("_count") >= i, step_price(F.col("salary"), i))


def _incremental_step(i: int) -> Column:
    reached_before = F.coalesce("no_of_strikes", F.lit(0)) >= i
    kept = F.when(reached_before, F.col(STRIKE_STEPS[i - 1])).otherwise(step_price(F.col("salary"), i))
    return F.when(F.col("_count") >= i, kept)


def strike_ladder_full(strikes: DataFrame, counts: DataFrame) -> DataFrame:
    """Price every step reached from the current salary; clear the others."""
    return _ladder(strikes, counts, _full_step)


def strike_ladder_incremental(strikes: DataFrame, counts: DataFrame) -> DataFrame:
    """Price only newly reached steps; earlier steps keep their stored value."""
    return _ladder(strikes, counts, _incremental_step)


def at_cap(cap: int = STRIKE_CAP) -> Column:
    """Condition: the employee has used up all strikes."""
    return F.col("no_of_strikes") >= cap


def drop_capped(counts: DataFrame, strikes: DataFrame, cap: int = STRIKE_CAP) -> DataFrame:
    """Counts of employees that have not reached the cap yet."""
    return exclude_ids(counts, strikes.filter(at_cap(cap)), "employee_id")


def newly_capped(updated: DataFrame, cap: int = STRIKE_CAP) -> DataFrame:
    """Ids of updated employees that are now at the cap."""
    return updated.filter(at_cap(cap)).select("employee_id")


def sync_salaries(timeline: DataFrame, strikes: DataFrame) -> DataFrame:
    """Strike rows to upsert after salary changes.

    Employees with a new salary get their reached steps priced again; employees
    without a strike row get one with no steps. Of several ACTIVE rows of an employee
    the best paid counts. One left join serves both cases.
    """
    current = dedupe_max(
        timeline.filter(F.col("status") == "ACTIVE").select(
            F.col("emp_id").cast("string").alias("_emp"), F.col("salary").alias("_salary")
        ),
        ["_emp"],
        "_salary",
    )
    joined = current.alias("c").join(strikes.alias("s"), F.col("_emp") == F.col("employee_id"), "left")
    reached = F.coalesce("no_of_strikes", F.lit(0))
    due = F.col("employee_id").isNull() | ~F.col("_salary").eqNullSafe(F.col("salary"))
    steps = [
        F.when(reached >= i, step_price(F.col("_salary"), i)).alias(step)
        for i, step in enumerate(STRIKE_STEPS, 1)
    ]
    return joined.filter(due).select(
        F.col("_emp").alias("employee_id"),
        F.col("_salary").alias("salary"),
        *steps,
        reached.cast("int").alias("no_of_strikes"),
    )


def strike_updates(strikes: DataFrame, counts: DataFrame, incremental: bool = False) -> DataFrame:
    """Changed strike rows: capped employees left out, ladder applied, unchanged rows dropped.

    The new row is computed next to the old one, so the comparison needs no second
    join.
    """
    price_step = _incremental_step if incremental else _full_step
    counted = counts.select(F.col("employee_id").alias("_emp"), _capped("strike_count").alias("_count"))
    open_rows = strikes.filter(~F.coalesce(at_cap(), F.lit(False)))
    joined = open_rows.join(counted, F.col("employee_id") == F.col("_emp"))
    new = F.struct(
        "employee_id",
        "salary",
        *[price_step(i).alias(step) for i, step in enumerate(STRIKE_STEPS, 1)],
        F.col("_count").alias("no_of_strikes"),
    )
    changed = differs("old", "new", [*STRIKE_STEPS, "no_of_strikes"])
    return (
        joined.select(F.struct(*STRIKES.fieldNames()).alias("old"), new.alias("new"))
        .filter(changed)
        .select("new.*")
    )


def strike_decay(strike_rows: DataFrame, flags: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Strike rows that change because flags have expired.

    The stream only looks at employees it has just flagged; run over all of them,
    employees without a recent flag fall back to zero strikes.
    """
    counts = rolling_flag_count(flags, as_of)
    quiet = exclude_ids(strike_rows, counts, "employee_id").select(
        "employee_id", F.lit(0).cast("bigint").alias("strike_count")
    )
    return strike_updates(strike_rows, counts.unionByName(quiet))


def strike_standing(
    strikes: DataFrame, flags: DataFrame, as_of: dt.datetime, days: int = FLAG_DAYS, cap: int = STRIKE_CAP
) -> DataFrame:
    """Strike rows as the keyed stream leaves them once its clock stands at `as_of`.

    Whoever had `cap` flags within any `days` is struck out and stays so; of all others the
    flags in the last `days` count. Each step reached is priced from the salary.
    """
    struck = (
        trailing_flag_count(flags, days)
        .groupBy("employee_id")
        .agg((F.max("strike_count") >= cap).alias("_struck"))
        .withColumnRenamed("employee_id", "_emp")
    )
    counts = rolling_flag_count(flags, as_of, days).withColumnRenamed("employee_id", "_counted")
    now = F.when(F.col("_struck"), F.lit(cap)).otherwise(F.coalesce("strike_count", F.lit(0)))
    standing = (
        strikes.join(struck, F.col("employee_id") == F.col("_emp"), "left")
        .join(counts, F.col("employee_id") == F.col("_counted"), "left")
        .withColumn("no_of_strikes", now.cast("int"))
    )
    steps = [
        F.when(F.col("no_of_strikes") >= i, step_price(F.col("salary"), i)).alias(step)
        for i, step in enumerate(STRIKE_STEPS, 1)
    ]
    return standing.select("employee_id", "salary", *steps, "no_of_strikes")
