"""Designation and salary timelines: one chain of intervals per employee.

A timeline row is (emp_id, designation, start_date, end_date, salary, status); the
row with no end is the current one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.functions.dates import SECONDS_PER_DAY
from rosterline.functions.rows import others, same
from rosterline.operators.cleaning import epoch_to_dates
from rosterline.operators.keyed import (
    dedupe_max,
    exclude_ids,
    mark_listed,
    new_rows_only,
    only_ids,
)

EMP, START, END, SALARY, STATUS = "emp_id", "start_date", "end_date", "salary", "status"
# The two states of a timeline row.
ACTIVE, INACTIVE = "ACTIVE", "INACTIVE"


def _with_next_start(
    df: DataFrame, key: str, start: str, ties: Sequence[str], slice_by: Column | str | None
) -> DataFrame:
    """Add `_next`, the start of the key's following row by (start, ties).

    Without `slice_by` this is one window per key, right when the rows of a key are
    bounded. With it, the window runs per (key, slice) so a hot key spreads over its
    slices; only the last row of a slice looks further, to the first start of the
    key's next slice, found on one row per (key, slice). A slice named `start` is that
    of `_with_next_day`.
    """
    if isinstance(slice_by, str):
        if slice_by != start:
            raise ValueError(f"a slice by name is {start!r}, not {slice_by!r}")
        return _with_next_day(df, key, start, ties)
    order = [F.col(start), *[F.col(c) for c in ties]]
    if slice_by is None:
        return df.withColumn("_next", F.lead(start).over(Window.partitionBy(key).orderBy(*order)))
    sliced = df.withColumn("_slice", slice_by)
    heads = sliced.groupBy(key, "_slice").agg(F.min(start).alias("_head"))
    by_key = Window.partitionBy(key).orderBy("_slice")
    heads = heads.select(key, "_slice", F.lead("_head").over(by_key).alias("_after"))
    local = Window.partitionBy(key, "_slice").orderBy(*order)
    rows = sliced.withColumns(
        {"_inside": F.lead(start).over(local), "_last": F.lead(F.lit(False), 1, True).over(local)}
    )
    return (
        rows.alias("d")
        .join(heads.alias("h"), same("d", "h", [key, "_slice"]), "left")
        .select(
            "d.*",
            F.when(F.col("d._last"), F.col("h._after")).otherwise(F.col("d._inside")).alias("_next"),
        )
        .drop("_slice", "_inside", "_last")
    )


def _with_next_day(df: DataFrame, key: str, start: str, ties: Sequence[str]) -> DataFrame:
    """`_with_next_start` for starts that a key has few of, like days, and rows may share.

    All rows of a start but the last by `ties` are followed by a row of the same start. The
    last one is an aggregate that combines map-side, and the only window holds one row per
    start, so no task has to take in all rows of a (key, start). `ties` must tell the rows of
    a start apart; several last rows would all get the next start.
    """
    largest = F.max(F.struct(*ties)) if ties else F.lit(True)
    # Grouped as a struct, the days get an exchange of their own for the join, which can then
    # split a hot (key, start).
    days = df.groupBy(F.struct(key, start).alias("_day")).agg(largest.alias("_top"))
    by_key = Window.partitionBy(f"_day.{key}").orderBy(f"_day.{start}")
    days = days.select(
        F.col(f"_day.{key}").alias(key),
        F.col(f"_day.{start}").alias(start),
        "_top",
        F.lead(f"_day.{start}").over(by_key).alias("_after"),
    )
    place = F.struct(*[F.col(f"d.{c}") for c in ties]) if ties else F.lit(True)
    last = place.eqNullSafe(F.col("h._top"))
    return (
        df.alias("d")
        .join(days.alias("h"), same("d", "h", [key, start]), "left")
        .select("d.*", F.when(last, F.col("h._after")).otherwise(F.col(f"d.{start}")).alias("_next"))
    )


def fill_open_end(
    df: DataFrame, key: str, start: str, end: str, ties: Sequence[str] = (), slice_by: Column | str | None = None
) -> DataFrame:
    """Give rows without an end the start of the key's next row; keep other ends."""
    return (
        _with_next_start(df, key, start, ties, slice_by)
        .withColumn(end, F.coalesce(end, "_next"))
        .drop("_next")
    )


def chain_intervals(
    df: DataFrame, key: str, start: str, end: str, ties: Sequence[str] = (), slice_by: Column | str | None = None
) -> DataFrame:
    """Replace every end by the start of the key's next row (NULL for the last)."""
    return (
        _with_next_start(df, key, start, ties, slice_by).withColumn(end, F.col("_next")).drop("_next")
    )


def interval_status(df: DataFrame, end: str = END, status: str = STATUS) -> DataFrame:
    """ACTIVE while the end is open, else INACTIVE."""
    return df.withColumn(status, F.when(F.col(end).isNull(), ACTIVE).otherwise(INACTIVE))


def timeline_silver(raw: DataFrame) -> DataFrame:
    """First-stage timeline: one row per (employee, start second), open ends filled.

    Starts are seconds here, so a hot employee has no small row bound; the chain is
    therefore built per day.
    """
    whole = {c: F.col(c).try_cast("decimal(38,6)").try_cast("bigint") for c in (START, END, SALARY)}
    typed = raw.withColumns({EMP: F.col(EMP).try_cast("bigint"), **whole})
    best = dedupe_max(typed, [EMP, START], SALARY)
    day = F.floor(F.col(START) / SECONDS_PER_DAY)
    filled = fill_open_end(best, EMP, START, END, slice_by=day)
    return interval_status(epoch_to_dates(filled, [START, END]))


def timeline_build(
    raw: DataFrame, struck: DataFrame, id_col: str = "employee_id", keep_ends: bool = False
) -> DataFrame:
    """Timeline of a raw load, without struck-out employees.

    Every end becomes the next start; with `keep_ends` only open ends do. The dedupe comes
    first: it combines map-side and leaves at most one row per (start day, end day) of an
    employee, which keeps a hot employee from reaching the anti join at full size. The
    chain runs per start day: a window holds one row per day of an employee, and a hot
    (employee, day) is spread over tasks.
    """
    dated = epoch_to_dates(raw, [START, END])
    return timeline_from_dates(dated, struck, id_col, keep_ends)


def timeline_from_dates(
    dated: DataFrame, struck: DataFrame, id_col: str = "employee_id", keep_ends: bool = False
) -> DataFrame:
    """`timeline_build` for input whose start and end are dates already."""
    best = dedupe_max(dated, [EMP, START, END], SALARY)
    kept = exclude_ids(best, struck, EMP, id_col)
    ties = [SALARY, *others(kept, [EMP, START, SALARY])]
    link = fill_open_end if keep_ends else chain_intervals
    return interval_status(link(kept, EMP, START, END, ties, START))


def rebuild_chain(rows: DataFrame) -> DataFrame:
    """Chain the rows of whole employees again, one row per resulting interval.

    Of several rows starting the same day the best paid takes the real interval; the
    others would all become the same zero-length interval, of which the best paid
    stays. So two rows per (employee, start day) decide the result, and Spark limits
    to those two before the exchange. That bounds the window over an employee by
    twice the calendar days. Rows without a start have no day; of those the best paid
    stays too.
    """
    ties = [SALARY, *others(rows, [EMP, START, END, STATUS, SALARY])]
    ranked = Window.partitionBy(EMP, START).orderBy(*[F.col(c).desc() for c in [*ties, END]])
    top = rows.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= 2)
    by_start = Window.partitionBy(EMP).orderBy(F.col(START), F.col("_rank").desc())
    chained = top.withColumn(END, F.lead(START).over(by_start)).drop("_rank")
    return dedupe_max(interval_status(chained).select(*rows.columns), [EMP, START, END], SALARY)


def fresh_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of a new load whose (employee, start, salary) is not stored yet.

    Only stored rows of employees in the load are compared.
    """
    stored = only_ids(existing, new, EMP, EMP)
    return new_rows_only(new.select(*existing.columns), stored, [EMP, START, SALARY])


def merge_fresh(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored timeline plus fresh rows, chained again for the employees that have any.

    All other employees pass through, unshuffled when the list of touched ids is
    small enough for Spark to broadcast. `fresh` is used three times, so a job should
    store it first.
    """
    rebuilt = rebuild_chain(only_ids(existing, fresh, EMP, EMP).unionByName(fresh))
    return exclude_ids(existing, fresh, EMP, EMP).unionByName(rebuilt)


def timeline_merge(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored timeline plus a new load; repeating a load changes nothing."""
    return merge_fresh(existing, fresh_rows(existing, new))


def deactivate_ids(
    timeline: DataFrame, ids: DataFrame, as_of: dt.date, id_col: str = "employee_id"
) -> DataFrame:
    """Close the current row of listed employees on `as_of`.

    Rows that are closed already keep their end, so running it again later does not
    move the date of the first strike-out.
    """
    marked = mark_listed(timeline, ids, EMP, id_col, "_hit")
    closing = F.col("_hit") & (F.col(STATUS) == ACTIVE)
    updated = {
        STATUS: F.when(closing, F.lit(INACTIVE)).otherwise(F.col(STATUS)),
        END: F.when(closing, F.lit(as_of).cast("date")).otherwise(F.col(END)),
    }
    return marked.select(*[updated[c].alias(c) if c in updated else F.col(c) for c in timeline.columns])
