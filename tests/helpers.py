"""Small helpers to state rows in tests."""

from __future__ import annotations

import datetime as dt


def day(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """All rows as sorted tuples of the named columns (all columns by default)."""
    frame = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
