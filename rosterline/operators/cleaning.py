"""Cleaning of raw master data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import epoch_date
from rosterline.operators.keyed import distinct_rows


def clean_required(
    df: DataFrame, required: Sequence[str], positive: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Drop rows with NULL in a required column or a value not above zero, then dedupe."""
    kept = df.dropna(subset=list(required))
    for column in positive:
        kept = kept.filter(F.col(column) > 0)
    return distinct_rows(kept, keys)


def stamp_load_date(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Add the load date as zero-padded `year`, `month` and `day` strings."""
    return df.withColumns(
        {
            "year": F.lit(f"{as_of:%Y}"),
            "month": F.lit(f"{as_of:%m}"),
            "day": F.lit(f"{as_of:%d}"),
        }
    )


def clean_calendar(df: DataFrame) -> DataFrame:
    """Distinct holidays with a real date, the date as DATE, plus its year.

    A header line read as data has no valid date and drops out here.
    """
    return (
        df.select(*[F.to_date(c).alias(c) if c == "date" else F.col(c) for c in df.columns])
        .filter(F.col("date").isNotNull())
        .distinct()
        .withColumn("year", F.year("date"))
    )


def clean_quota(df: DataFrame) -> DataFrame:
    """Distinct (emp_id, leave_quota, year) triples without NULLs."""
    keys = ["emp_id", "leave_quota", "year"]
    return distinct_rows(df.dropna(subset=keys), keys)


def epoch_to_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn columns of epoch seconds into DATE."""
    return df.withColumns({c: epoch_date(F.col(c)) for c in columns})
