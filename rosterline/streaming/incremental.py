"""Raw files that are each loaded once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rosterline.operators.keyed import distinct_rows, new_rows_only
from rosterline.sources.files import read_or_empty, with_lineage


def incremental_csv(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    archive: str | None = None,
    header: bool = True,
    max_files: int | None = None,
    lineage: str | None = None,
) -> StreamingQuery:
    """Pass the files that arrived since the last run to `sink(rows, batch id)`.

    With `lineage` the rows have a column of that name with the file they are from.
    The checkpoint remembers which files are done. With `archive`, done files are
    moved there by a later run, once their batch is committed. The sink should write
    by batch id, since a batch may be repeated after a failure, and must not depend on
    which files share a batch: `distinct_sink` is such a sink.
    """
    reader = spark.readStream.schema(schema).option("header", header)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.csv(directory)
    return (
        (with_lineage(rows, lineage) if lineage else rows)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_sink(
    table: str, schema: T.StructType, keys: list[str], clean: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """A sink that adds the cleaned rows whose key no earlier batch has brought.

    So the table holds each key once, however files are dealt out to batches; where rows
    of a key differ, the first batch wins and inside it the largest values. Each batch
    replaces its own directory.
    """
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])

    def sink(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        earlier = read_or_empty(spark, table, stored).filter(F.col("batch") < batch)
        fresh = distinct_rows(clean(rows).select(*schema.fieldNames()), keys)
        added = new_rows_only(fresh, earlier.select(*keys), keys)
        added.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch={batch}")

    return sink


def list_files(rows: DataFrame, lineage: str, ledger: str, batch: int) -> None:
    """Write down which files a batch has rows of: a row per file, in a directory of the batch."""
    paths = rows.select(F.col(lineage).alias("path")).distinct()
    paths.write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/batch={batch}")


def archive_files(spark: SparkSession, ledger: str, batch: int, archive: str) -> int:
    """Move the listed files of a batch to a directory of it in the archive; returns how many moved.

    Files that have moved already are passed over, so it may be called again.
    """
    listed = read_or_empty(spark, f"{ledger.rstrip('/')}/batch={batch}", _LISTED)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    target = path_of(f"{archive.rstrip('/')}/batch={batch}")
    moved = 0
    for row in listed.toLocalIterator():
        # File names come encoded as URIs.
        source = path_of(spark._jvm.java.net.URI(row.path))
        system = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(source):
            system.mkdirs(target)
            if not system.rename(source, path_of(target, source.getName())):
                raise OSError(f"{row.path} cannot be moved to {archive}")
            moved += 1
    return moved


_LISTED = T.StructType([T.StructField("path", T.StringType())])
