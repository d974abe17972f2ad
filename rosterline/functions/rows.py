"""Whole-row helpers: null-safe matching and comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(left: str, right: str, columns: Iterable[str]) -> Column:
    """True when the two aliased sides agree on every column, NULL matching NULL."""
    return reduce(
        Column.__and__,
        (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns),
    )


def differs(left: str, right: str, columns: Iterable[str]) -> Column:
    """True when the two aliased sides disagree on any column, NULL being a value.

    Compared column by column: a digest of concatenated values would skip NULLs
    and let shifted values collide.
    """
    return ~same(left, right, columns)


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on null-safe keys, returning the left columns."""
    return left.alias("l").join(right.alias("r"), same("l", "r", keys), how)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, as the small side of a join whose other side may have a hot key.

    Grouped as one struct, so the join does not reuse the partitioning of the
    grouping but gets an exchange of its own for these few rows. Adaptive execution
    splits a hot key only where both inputs of a join come straight from an exchange.
    """
    return df.select(F.struct(*keys).alias("_key")).distinct().select("_key.*")


def others(df: DataFrame, keys: Iterable[str]) -> list[str]:
    """Columns of `df` that are not in `keys`, in order."""
    taken = set(keys)
    return [c for c in df.columns if c not in taken]
