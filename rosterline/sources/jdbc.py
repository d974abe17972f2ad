"""Relational tables over JDBC. Every connection setting comes from the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table; with a numeric split column and its bounds, in that many parallel scans.

    The bounds only place the splits: rows outside them are read all the same. Instead
    `predicates`, as from `hash_predicates` or `range_predicates`, name the parts: one scan
    for each, and no bounds to know.
    """
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    if split_column is None or bounds is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )


def hash_predicates(column: str, parts: int) -> list[str]:
    """Conditions that deal the rows of a whole-number key out by remainder, each to one part.

    Together they hold for every row: negative remainders are counted with their positive
    ones, and rows without a key come with the first part.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    if parts == 1:
        return ["1 = 1"]
    found = [f"({column} % {parts} = 0 OR {column} IS NULL)"]
    found += [f"({column} % {parts} = {i} OR {column} % {parts} = {i - parts})" for i in range(1, parts)]
    return found


def sql_literal(value: object) -> str:
    """A number, text, date or time as SQL."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"{value!r} cannot split a key")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, splits: Sequence[object]) -> list[str]:
    """Conditions for the ranges between ascending splits, with those below the first and above the last.

    Each row meets one of them; rows without a key come with the first.
    """
    cuts = [sql_literal(v) for v in splits]
    if any(not a < b for a, b in zip(splits, splits[1:], strict=False)):
        raise ValueError("splits must ascend")
    if not cuts:
        return ["1 = 1"]
    inner = [f"({column} >= {a} AND {column} < {b})" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *inner, f"({column} >= {cuts[-1]})"]


def even_splits(low: int, high: int, parts: int) -> list[int]:
    """Splits that cut the whole numbers from `low` to `high` into so many even ranges, fewer if there are fewer."""
    if parts < 1 or high < low:
        raise ValueError("there must be a part, and a range")
    return sorted({low + (high - low + 1) * i // parts for i in range(1, parts)} - {low})


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str]) -> DataFrame:
    """The result of a query that the database evaluates."""
    return spark.read.jdbc(url, f"({query}) AS pushed", properties=properties)


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str) -> None:
    """Append to a table or, with mode `overwrite`, replace its rows and keep its definition."""
    df.write.option("truncate", mode == "overwrite").jdbc(url, table, mode=mode, properties=properties)


def upsert_statement(table: str, staging: str, key: str, columns: Sequence[str]) -> str:
    """SQL that moves staged rows into a table, replacing those with the same key."""
    listed = ", ".join(columns)
    assigned = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return (
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} "
        f"ON CONFLICT ({key}) DO UPDATE SET {assigned}"
    )


def upsert_table(
    df: DataFrame,
    url: str,
    table: str,
    staging: str,
    key: str,
    properties: dict[str, str],
    execute: Callable[[str], object],
) -> None:
    """Write the rows to a staging table in parallel, then let the database merge them.

    `execute` runs one statement on the caller's own connection.
    """
    write_table(df, url, staging, properties, "overwrite")
    execute(upsert_statement(table, staging, key, df.columns))
