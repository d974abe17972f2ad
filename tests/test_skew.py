"""A third of all rows under one key: plans and results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from rosterline.operators import keyed, leaves, messages, strikes, timeline

ROWS = 60_000


@pytest.fixture
def small_partitions(spark):
    """Limits so low that the skew of a small table counts, and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def hot(spark):
    """Rows of which every third belongs to employee 0."""
    return spark.range(0, ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("emp_id"),
        F.col("id").alias("line"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.hash("id") % 300).cast("int")).alias("date"),
    )


def executed(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_id_joins_split_the_hot_key(spark, small_partitions, hot):
    ids = spark.range(500, 700).select(F.col("id").cast("string").alias("employee_id"))
    kept = keyed.exclude_ids(hot, ids, "emp_id")
    assert "skew=true" in executed(kept)
    want = hot.filter((F.col("emp_id") < 500) | (F.col("emp_id") >= 700)).count()
    assert kept.count() == want


def test_merge_splits_the_hot_key(spark, small_partitions, hot):
    target = spark.range(0, 1000).select(
        F.col("id").alias("emp_id"), F.lit(-1).cast("bigint").alias("line"), F.lit(None).cast("date").alias("date")
    )
    merged = keyed.merge_first_non_null(hot, target, ["emp_id"])
    assert "skew=true" in executed(merged)
    assert merged.filter("line >= 0").count() == ROWS
    assert merged.filter("line < 0").count() == 1000 - hot.select("emp_id").distinct().count()


def test_frequent_word_is_split(spark, small_partitions):
    chat = spark.range(0, 20_000, numPartitions=8).select(
        "id",
        F.lit("s").alias("sender"),
        F.concat(F.lit("the w"), (F.col("id") % 5000).cast("string")).alias("message"),
    )
    vocab = spark.range(0, 4000).select(F.concat(F.lit("W"), F.col("id").cast("string")).alias("word"))
    vocab = vocab.unionByName(spark.createDataFrame([("THE",)], "word string"))
    marked = spark.createDataFrame([("W7",), ("W4999",)], "word string")
    flagged = messages.flag_messages(chat, vocab, marked, ["id"])
    assert "skew=true" in executed(flagged)
    assert rows(flagged, "id") == [(i,) for i in sorted((7, 5007, 10007, 15007), key=lambda i: repr((i,)))]




def test_settling_combines_before_the_exchange(spark, hot):
    records = hot.select(
        "emp_id",
        "date",
        F.when(F.col("line") % 2 == 0, "ACTIVE").otherwise("CANCELLED").alias("status"),
        F.col("line").alias("ingest_timestamp"),
    )
    text = plan(leaves.settle(records))
    assert text.index("partial_count") > text.index("Exchange")  # below the exchange in the printed tree
    got = leaves.settle(records).filter("emp_id = 0")
    assert got.count() == hot.filter("emp_id = 0").select("date").distinct().count()


def test_chain_of_a_hot_employee_is_spread_over_days(spark, hot):
    df = hot.withColumn("end", F.lit(None).cast("date"))
    sliced = timeline.chain_intervals(df, "emp_id", "date", "end", ["line"], F.col("date"))
    assert rows(sliced) == rows(timeline.chain_intervals(df, "emp_id", "date", "end", ["line"]))
    assert "windowspecdefinition(emp_id" in plan(sliced) and "_slice" in plan(sliced)


def test_chain_with_given_ends_holds_one_day_in_a_window(spark):
    """One employee, many ends on each start day: the window gets a row per start day."""
    days = spark.range(0, 6000).select(
        F.lit(1).cast("bigint").alias("emp_id"),
        F.lit("eng").alias("designation"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 200).cast("int")).alias("start_date"),
        F.date_add(F.lit(dt.date(2021, 1, 1)), F.col("id").cast("int")).alias("end_date"),
        F.col("id").cast("double").alias("salary"),
    )
    nobody = spark.createDataFrame([], "employee_id string")
    built = timeline.timeline_from_dates(days, nobody)
    assert built.count() == 6000 and built.filter("end_date IS NULL").count() == 1
    assert "max(struct(" in plan(built) and "windowspecdefinition(emp_id" not in plan(built)


def test_chain_splits_a_hot_day(spark, small_partitions):
    """A third of all rows start on one day of one employee; their chain is not one task."""
    spread = F.col("id") % 3 == 0
    lines = spark.range(0, ROWS, numPartitions=8).select(
        F.when(spread, 0).otherwise(F.col("id") % 997).alias("emp_id"),
        F.when(spread, F.lit(dt.date(2020, 1, 5)))
        .otherwise(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 30).cast("int")))
        .alias("date"),
        F.col("id").alias("line"),
        F.when(F.col("id") % 5 == 0, F.lit(dt.date(2030, 1, 1))).alias("end"),
    )
    for operator in (timeline.chain_intervals, timeline.fill_open_end):
        chained = operator(lines, "emp_id", "date", "end", ["line"], "date")
        assert "skew=true" in executed(chained)
        plain = operator(lines, "emp_id", "date", "end", ["line"])
        assert chained.exceptAll(plain).isEmpty() and chained.count() == ROWS


def test_trailing_count_of_a_hot_employee(spark, hot):
    flags = hot.select(F.col("emp_id").cast("string").alias("employee_id"), F.col("date").cast("timestamp_ntz").alias("start_date"))
    daily = {r.date: r.n for r in hot.filter("emp_id = 0").groupBy("date").agg(F.count("*").alias("n")).collect()}
    got = {
        r.start_date.date(): r.strike_count
        for r in strikes.trailing_flag_count(flags, 30).filter("employee_id = '0'").distinct().collect()
    }
    assert got == {
        day: sum(n for other, n in daily.items() if day - dt.timedelta(days=30) <= other <= day) for day in daily
    }
