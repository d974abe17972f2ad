import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from rosterline.operators import keyed


def test_dedupe_max_keeps_largest_and_treats_null_as_smallest(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "a"), (1, 7.0, "b"), (1, None, "c"), (2, None, "x"), (None, 1.0, "n"), (None, 2.0, "m")],
        "k int, v double, w string",
    )
    assert rows(keyed.dedupe_max(df, ["k"], "v")) == rows(
        spark.createDataFrame([(1, 7.0, "b"), (2, None, "x"), (None, 2.0, "m")], df.schema)
    )


def test_ties_are_decided_by_the_other_columns(spark):
    data = [(1, 5.0, "a"), (1, 5.0, "c"), (1, 5.0, "b")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, v double, w string").repartition(3)
        assert rows(keyed.dedupe_max(df, ["k"], "v")) == [(1, 5.0, "c")]


def test_rank_is_limited_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(keyed.dedupe_max(df, ["k"], "v"))
    assert text.index("Exchange") < text.index("Partial")


def test_exclude_ids_across_types_with_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "emp_id bigint")
    ids = spark.createDataFrame([("1",), ("1",), ("not a number",), (None,)], "employee_id string")
    assert rows(keyed.exclude_ids(df, ids, "emp_id")) == [(2,), (None,)]
    assert rows(keyed.only_ids(df, ids, "emp_id")) == [(1,)]


def test_exclude_no_ids_keeps_everything(spark):
    df = spark.createDataFrame([(1,), (2,)], "emp_id bigint")
    ids = spark.createDataFrame([], "employee_id string")
    assert rows(keyed.exclude_ids(df, ids, "emp_id")) == [(1,), (2,)]


def test_new_rows_only_matches_null_keys(spark):
    new = spark.createDataFrame([(1, None, 1.0), (1, "x", 1.0), (2, None, 1.0)], "k int, e string, v double")
    old = spark.createDataFrame([(1, None)], "k int, e string")
    assert rows(keyed.new_rows_only(new, old, ["k", "e"])) == [(1, "x", 1.0), (2, None, 1.0)]


def test_merge_pairs_null_keys_and_prefers_staging(spark):
    schema = "k int, e string, a string, b string"
    staging = spark.createDataFrame([(1, None, "new", None), (2, "x", "s", "s")], schema)
    target = spark.createDataFrame([(1, None, "old", "kept"), (3, None, "t", "t")], schema)
    assert rows(keyed.merge_first_non_null(staging, target, ["k", "e"])) == [
        (1, None, "new", "kept"),
        (2, "x", "s", "s"),
        (3, None, "t", "t"),
    ]


def test_merge_equals_full_outer_join_with_duplicate_keys(spark):
    staging = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    target = spark.createDataFrame([(1, "t"), (2, "u"), (2, "w"), (4, "z")], "k int, v string")
    full = (
        staging.alias("s")
        .join(target.alias("t"), F.col("s.k") == F.col("t.k"), "full")
        .select(F.coalesce("s.k", "t.k").alias("k"), F.coalesce("s.v", "t.v").alias("v"))
    )
    assert rows(keyed.merge_first_non_null(staging, target, ["k"])) == rows(full)


def test_headcount_merge_keeps_target_only_designations(spark):
    staging = spark.createDataFrame([("eng", 3), (None, 1)], "designation string, active_employees long")
    target = spark.createDataFrame([("eng", 2), ("ops", 5), (None, 9)], staging.schema)
    merged = keyed.merge_first_non_null(staging, target, ["designation"])
    assert rows(merged) == [("eng", 3), ("ops", 5), (None, 1)]


def test_upsert_replaces_whole_rows(spark):
    target = spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], "id string, v string, n int")
    updates = spark.createDataFrame([("2", None, 9), ("3", "c", 3)], target.schema)
    assert rows(keyed.upsert_on_key(target, updates, "id")) == [("1", "a", 1), ("2", None, 9), ("3", "c", 3)]


@pytest.mark.parametrize("bad", [[("2", 1), ("2", 2)], [(None, 1)]])
def test_upsert_refuses_duplicate_or_null_keys(spark, bad):
    target = spark.createDataFrame([("1", 1)], "id string, n int")
    updates = spark.createDataFrame(bad, target.schema)
    with pytest.raises(Exception, match="occurs more than once"):
        keyed.upsert_on_key(target, updates, "id").collect()


def test_changed_rows_sees_shifted_nulls(spark):
    # Joined as text without NULLs both rows would read the same.
    old = spark.createDataFrame([("1", "x", None), ("2", "y", "z")], "id string, a string, b string")
    new = spark.createDataFrame([("1", None, "x"), ("2", "y", "z")], old.schema)
    assert rows(keyed.changed_rows(new, old, "id")) == [("1", None, "x")]


def test_update_listed_changes_only_listed_rows(spark):
    df = spark.createDataFrame([(1, "ACTIVE"), (2, "ACTIVE")], "emp_id bigint, status string")
    ids = spark.createDataFrame([("2",), ("2",)], "employee_id string")
    assert rows(keyed.update_listed(df, ids, "emp_id", {"status": F.lit("INACTIVE")})) == [
        (1, "ACTIVE"),
        (2, "INACTIVE"),
    ]


def test_id_lists_are_not_broadcast_beyond_the_threshold(spark):
    df = spark.range(1000).select(F.col("id").alias("emp_id"))
    ids = spark.range(10).select(F.col("id").alias("employee_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(keyed.exclude_ids(df, ids, "emp_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
