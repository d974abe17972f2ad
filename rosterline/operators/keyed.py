"""Operators that work by key on any table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.functions.rows import differs, distinct_keys, match, others, same


def _largest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by `order`, then by the remaining columns.

    Spark limits each key to its first row before the exchange as well, so the copies
    of a hot key never meet in one task. Ordering by the remaining columns makes ties
    deterministic.
    """
    ranking = [F.col(c).desc() for c in [*order, *others(df, [*keys, *order])]]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_rank", first).filter(F.col("_rank") == 1).drop("_rank")


def dedupe_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keep the row with the largest `value` per key (NULL is smallest)."""
    return _largest_row(df, keys, [value])


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Keep the newest row per key by `ts`."""
    return _largest_row(df, keys, [ts])


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; where other columns disagree the largest values win."""
    rest = others(df, keys)
    return _largest_row(df, keys, rest) if rest else df.dropDuplicates(list(keys))


def id_list(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Distinct ids as column `_listed`, in the type of the key they are joined to.

    Spark broadcasts the list only when its size is below the session's threshold and
    otherwise joins by shuffle, splitting a hot key of the large side.
    """
    typed = F.col(id_col).try_cast(df.schema[key].dataType)
    return distinct_keys(ids.select(typed.alias("_listed")), ["_listed"])


def exclude_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "employee_id") -> DataFrame:
    """Drop the rows whose key is listed in `ids`."""
    listed = id_list(df, key, ids, id_col)
    return df.join(listed, F.col(key) == F.col("_listed"), "left_anti")


def only_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "employee_id") -> DataFrame:
    """Keep the rows whose key is listed in `ids`."""
    listed = id_list(df, key, ids, id_col)
    return df.join(listed, F.col(key) == F.col("_listed"), "left_semi")


def new_rows_only(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose key is not in `existing`; NULL keys match NULL keys."""
    return match(new, distinct_keys(existing, keys), keys, "left_anti")


def merge_first_non_null(staging: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer merge: per column the staging value, else the target value.

    Written as staging LEFT JOIN target plus the target rows staging does not have.
    That is the full outer result, but unlike a full outer join adaptive execution
    can split a hot key on the row-preserving side.
    """
    rest = others(target, keys)
    hit = (
        staging.alias("s")
        .join(target.alias("t"), same("s", "t", keys), "left")
        .select(
            *[F.col(f"s.{k}") for k in keys],
            *[F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) for c in rest],
        )
    )
    kept = match(target, distinct_keys(staging, keys), keys, "left_anti")
    return hit.unionByName(kept.select(*keys, *rest))


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows, failing at run time when a key is NULL or occurs twice.

    The check rides on one aggregate that combines map-side, so a key repeated
    many times is still only one row per map task after the exchange.
    """
    rest = others(df, [key])
    broken = F.raise_error(
        F.format_string(f"key {key}=%s is NULL or occurs more than once", F.col(key).cast("string"))
    )
    fine = F.col(key).isNotNull() & (F.col("_n") == 1)
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
        .select(key, F.when(fine, F.col("_row")).otherwise(broken).alias("_row"))
        .select(*[F.col(c) if c == key else F.col(f"_row.{c}") for c in df.columns])
    )


def upsert_on_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Replace whole rows on a key hit, insert the others.

    Like an SQL upsert it refuses two updates for one key.
    """
    checked = assert_unique(updates.select(*target.columns), key)
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(checked)


def changed_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of `new` whose content differs from the `old` row of the same key."""
    return (
        new.alias("new")
        .join(old.alias("old"), F.col(f"new.{key}") == F.col(f"old.{key}"))
        .filter(differs("new", "old", others(new, [key])))
        .select("new.*")
    )


def mark_listed(df: DataFrame, ids: DataFrame, key: str, id_col: str, flag: str) -> DataFrame:
    """Add a boolean column telling whether the key is listed in `ids`."""
    listed = id_list(df, key, ids, id_col)
    marked = df.join(listed, F.col(key) == F.col("_listed"), "left")
    return marked.withColumn(flag, F.col("_listed").isNotNull()).drop("_listed")


def update_listed(
    df: DataFrame, ids: DataFrame, key: str, values: dict[str, Column], id_col: str = "employee_id"
) -> DataFrame:
    """Keyed update: set columns to new values on the rows whose key is listed."""
    marked = mark_listed(df, ids, key, id_col, "_hit")
    return marked.select(
        *[
            F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )
