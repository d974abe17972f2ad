"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV bound to a schema by position; a cell that does not fit becomes NULL."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string."""
    return spark.read.option("header", True).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or no rows when it has not been written yet.

    Only a missing path counts as absent; any other failure is raised.
    """
    wanted = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = wanted.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.globStatus(wanted):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of JSON files that hold arrays of strings, in any layout.

    Files are read by line and so in parts: a JSON string never spans lines, whether its
    array stands on one line or on many.
    """
    strings = F.regexp_extract_all("value", F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'), F.lit(0))
    array = F.concat(F.lit("["), F.array_join(strings, ","), F.lit("]"))
    return (
        spark.read.text(path)
        .select(F.explode(F.from_json(array, "array<string>")).alias("word"))
        .distinct()
    )


def with_lineage(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the input file of each row."""
    return df.withColumn(column, F.col("_metadata.file_path"))
