"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring rows of one output directory together before a partitioned write.

    A rebalance keeps each task from writing a small file into every directory, and
    adaptive execution splits a directory that is too large for one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df


def _write_counted(df: DataFrame, mode: str, path: str, by: Sequence[str]) -> int:
    """Write rows and return how many there were, counted by the tasks that write them."""
    seen = Observation()
    # Above the rebalance: adaptive execution may drop what is below an exchange without rows.
    rows = gathered(df, by).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode(mode).partitionBy(*by).parquet(path)
    return seen.get["rows"]


def append_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """Add rows to a table; returns their number."""
    return _write_counted(df, "append", path, by)


def overwrite_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """Replace the whole table; returns the number of rows it has now."""
    return _write_counted(df, "overwrite", path, by)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that occur in `df`; earlier ones stay."""
    (
        gathered(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def partition_path(root: str, values: dict[str, str]) -> str:
    """The directory of a partition."""
    return "/".join([root.rstrip("/"), *[f"{name}={value}" for name, value in values.items()]])


class Prepared(NamedTuple):
    """A directory written aside, the one it is to become, and its number of rows."""

    aside: str
    path: str
    rows: int


def prepare_partition(df: DataFrame, root: str, values: dict[str, str], by: Sequence[str] = ()) -> Prepared:
    """Write one directory of a table below `_staging`, where readers of the table do not look.

    `df` may hold the partition's columns; they are in the path.
    """
    aside = partition_path(f"{root.rstrip('/')}/_staging", values)
    return Prepared(aside, partition_path(root, values), overwrite_parquet(df.drop(*values), aside, by))


def put_in_place(spark: SparkSession, prepared: Prepared) -> str:
    """Let a prepared directory take the place of the one of that name, which it returns.

    The old directory stays until the new one is written; in between are a delete and a
    rename. A load that breaks off there is mended by repeating it.
    """
    aside, path = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (prepared.aside, prepared.path))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(path, True)
    system.mkdirs(path.getParent())
    if not system.rename(aside, path):
        raise OSError(f"{prepared.aside} could not be moved to {prepared.path}")
    _remove_empty(system, aside.getParent(), "_staging")
    return prepared.path


def discard(spark: SparkSession, prepared: Prepared) -> None:
    """Remove a prepared directory, and the table's if nothing else is in it."""
    aside = spark._jvm.org.apache.hadoop.fs.Path(prepared.aside)
    system = aside.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(aside, True)
    _remove_empty(system, _remove_empty(system, aside.getParent(), "_staging"), None)


def _remove_empty(system, folder, upto: str | None):
    """Remove a folder and those above it up to one of that name while they are empty.

    Returns the folder above the last one looked at.
    """
    name = None
    while name is None or (upto is not None and name != upto):
        name = folder.getName()
        if system.exists(folder) and not system.listStatus(folder):
            system.delete(folder, False)
        folder = folder.getParent()
    return folder


def replace_partition(df: DataFrame, root: str, values: dict[str, str], by: Sequence[str] = ()) -> str:
    """Replace one directory of a table whole, also when `df` has no rows for it.

    `df` may hold the partition's columns; they are in the path. Returns the directory.
    """
    return put_in_place(df.sparkSession, prepare_partition(df, root, values, by))


def remove_partitions(spark: SparkSession, root: str, partitions: Sequence[dict[str, str]]) -> None:
    """Remove directories of a table that have lost all rows; those that are not there are passed over."""
    for values in partitions:
        path = spark._jvm.org.apache.hadoop.fs.Path(partition_path(root, values))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def write_alerts(texts: DataFrame, path: str, run_date: str) -> None:
    """Alert texts of a run as text files in a directory of its date, which is replaced whole."""
    texts.select("value").write.mode("overwrite").text(partition_path(path, {"run_date": run_date}))


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result and read it back, so later uses only scan it."""
    return stage_counted(df, path)[0]


def stage_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """`stage`, and the number of rows written."""
    rows = overwrite_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def write_version(df: DataFrame, root: str, version: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a table as a new version under `root` and read it back.

    A job that derives a table from its own last version must not overwrite what it
    is still reading. Writing the same version again replaces it, so a job may be
    repeated; whoever reads next names the version to read.
    """
    spark: SparkSession = df.sparkSession
    path = f"{root.rstrip('/')}/version={version}"
    overwrite_parquet(df, path, by)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
