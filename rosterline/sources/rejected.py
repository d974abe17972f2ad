"""Input that is turned away with its reason instead of vanishing.

Rows read are rows kept plus rows rejected. What is malformed comes with the record as it
was; what breaks a rule comes with the rule's name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.schemas import MESSAGE
from rosterline.sources.sinks import replace_partition, stage

REASON, RECORD = "reject_reason", "reject_record"
MALFORMED, EMPTY = "malformed", "empty"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV bound to a schema by position, with reason and record of lines that do not fit.

    A line is malformed if a cell does not fit its type or cells are missing or too many;
    its cells that do fit are kept.
    """
    bound = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    rows = (
        spark.read.schema(bound)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .csv(path)
    )
    return rows.withColumn(REASON, F.when(F.col(RECORD).isNotNull(), MALFORMED))


def parse_messages_checked(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """`parse_messages` with reason and record of values that are empty, no JSON, or lack a field."""
    fields = MESSAGE.fieldNames()
    bound = T.StructType([*MESSAGE.fields, T.StructField(RECORD, T.StringType())])
    text = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    parsed = df.select(*keep, text.alias("_text"), F.from_json(text, bound, options).alias("_data"))
    reason = F.when(F.coalesce(F.trim("_text"), F.lit("")) == "", EMPTY)
    reason = reason.when(F.col(f"_data.{RECORD}").isNotNull(), MALFORMED)
    for field in fields:
        reason = reason.when(F.col(f"_data.{field}").isNull(), f"no {field}")
    return parsed.select(
        *keep,
        *[F.col(f"_data.{field}").alias(field) for field in fields],
        F.when(reason.isNotNull(), F.col("_text")).alias(RECORD),
        reason.alias(REASON),
    )


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Name the first rule that a row breaks; a rule that is neither true nor false is broken.

    A reason that the row has already stays. Rows without a record get one of all columns.
    """
    columns = [c for c in df.columns if c not in (REASON, RECORD)]
    known = F.col(REASON) if REASON in df.columns else F.lit(None).cast("string")
    record = F.col(RECORD) if RECORD in df.columns else F.lit(None).cast("string")
    reason = F.when(known.isNotNull(), known)
    for name, holds in rules.items():
        reason = reason.when(~F.coalesce(holds, F.lit(False)), name)
    return df.select(*columns, record.alias(RECORD), reason.alias(REASON)).withColumn(
        RECORD, F.when(F.col(REASON).isNotNull(), F.coalesce(RECORD, F.to_json(F.struct(*columns))))
    )


def quarantine(
    df: DataFrame, staging: str, table: str, values: dict[str, str], rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """The rows that are kept; the others go to a directory of a quarantine table, by reason.

    `df` comes from a checked reader, or `rules` say what is to be kept. The input is read
    once: it is staged with its reasons, and both sides read that. A repeated load replaces
    its directory, also with nothing.
    """
    columns = [c for c in df.columns if c not in (REASON, RECORD)]
    marked = stage(with_reasons(df, rules or {}), staging)
    away = marked.filter(F.col(REASON).isNotNull()).select(RECORD, REASON)
    replace_partition(away, table, values, [REASON])
    return marked.filter(F.col(REASON).isNull()).select(*columns)


def read_quarantine(spark: SparkSession, table: str, by: Sequence[str] = ()) -> DataFrame:
    """(record, reason) of a quarantine table, with the columns of its directories."""
    kinds = T.StructType([T.StructField(c, T.StringType()) for c in (RECORD, *by, REASON)])
    return spark.read.schema(kinds).parquet(table)
