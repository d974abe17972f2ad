"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86_400
# 0001-01-01 and 9999-12-31 as days since 1970-01-01.
FIRST_DAY, LAST_DAY = -719_162, 2_932_896


def epoch_date(seconds: Column) -> Column:
    """UTC calendar date of a count of seconds since 1970-01-01.

    Whole-day arithmetic, so the result never depends on the session time zone. A count
    beyond the years 1 to 9999 gives NULL.
    """
    day = F.floor(seconds.try_cast("bigint") / SECONDS_PER_DAY)
    return F.when(day.between(FIRST_DAY, LAST_DAY), F.date_from_unix_date(day.try_cast("int")))


def instant(at: dt.datetime, like: T.DataType | str = "timestamp") -> Column:
    """A point in time as a literal of the given timestamp type; naive means UTC."""
    if at.tzinfo is not None:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast(like)


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday (`dayofweek` counts from Sunday = 1)."""
    return F.dayofweek(day).isin(1, 7)


def date_spine(spark: SparkSession, first: dt.date, last: dt.date, column: str = "date") -> DataFrame:
    """One row per calendar day from `first` to `last`, both included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias(column))
