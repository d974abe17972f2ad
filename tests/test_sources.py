import json
import os

import pytest
from pyspark.errors import AnalysisException

from helpers import day, plan, rows
from rosterline import schemas
from rosterline.operators import cleaning
from rosterline.sources import files, jdbc, sinks


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    return path


def test_csv_binds_by_position_and_nulls_bad_cells(spark, folder):
    path = put(folder, "e.csv", "x,y,z\nann,30,1\nbob,old,2\n")
    assert rows(files.read_csv(spark, path, schemas.EMPLOYEE)) == [("ann", 30, 1), ("bob", None, 2)]


def test_calendar_without_header_option(spark, folder):
    path = put(folder, "c.csv", "reason,date\nA,2023-7-28\nA,2023-7-28\nB,2024-05-11\n")
    raw = files.read_csv(spark, path, schemas.CALENDAR_RAW, header=False)
    assert raw.count() == 4
    assert rows(cleaning.clean_calendar(raw)) == [("A", day("2023-07-28"), 2023), ("B", day("2024-05-11"), 2024)]


def test_string_csv(spark, folder):
    path = put(folder, "s.csv", "emp_id,salary\n1,10\n")
    assert files.read_csv_strings(spark, path).dtypes == [("emp_id", "string"), ("salary", "string")]


def test_read_or_empty(spark, folder):
    assert rows(files.read_or_empty(spark, folder + "/none", schemas.STRUCK)) == []
    put(folder, "bad/part.parquet", "not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        files.read_or_empty(spark, folder + "/bad", schemas.STRUCK).collect()
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder + "/none")


def test_words_from_json_arrays(spark, folder):
    put(folder, "w/1.json", json.dumps(["A1", "B2", "A1"]))
    put(folder, "w/2.json", json.dumps(["B2", "É"], indent=1))
    assert rows(files.read_words(spark, folder + "/w")) == [("A1",), ("B2",), ("É",)]


def test_lineage(spark, folder):
    path = put(folder, "e.csv", "name,age,emp_id\nann,30,1\n")
    (row,) = files.with_lineage(files.read_csv(spark, path, schemas.EMPLOYEE)).collect()
    assert row.source_file.endswith("e.csv")


def test_partition_overwrite_keeps_other_dates(spark, folder):
    def write(value, run):
        df = spark.createDataFrame([(value, run)], "v int, run_date string")
        sinks.overwrite_partitions(df, folder + "/t", ["run_date"])

    write(1, "2024-05-01")
    write(2, "2024-05-02")
    write(3, "2024-05-02")
    got = spark.read.schema("v int, run_date string").parquet(folder + "/t")
    assert rows(got) == [(1, "2024-05-01"), (3, "2024-05-02")]
    assert "PartitionFilters: [isnotnull(run_date" in plan(got.filter("run_date = '2024-05-01'"))


def test_partitioned_write_makes_one_file_per_directory(spark, folder):
    df = spark.range(1000).selectExpr("id", "id % 3 AS part").repartition(8)
    sinks.append_parquet(df, folder + "/t", ["part"])
    for part in range(3):
        names = [n for n in os.listdir(f"{folder}/t/part={part}") if n.endswith(".parquet")]
        assert len(names) == 1


def test_versions_allow_reading_what_is_replaced(spark, folder):
    first = sinks.write_version(spark.range(3).toDF("id"), folder, "1")
    for _ in range(2):
        second = sinks.write_version(first.selectExpr("id + 1 AS id"), folder, "2")
        assert rows(second) == [(1,), (2,), (3,)]
    assert rows(first) == [(0,), (1,), (2,)]


def test_csv_and_alert_sinks(spark, folder):
    sinks.append_csv(spark.createDataFrame([(1, "a")], "id int, v string"), folder + "/csv")
    sinks.append_csv(spark.createDataFrame([(2, "b")], "id int, v string"), folder + "/csv")
    assert rows(files.read_csv_strings(spark, folder + "/csv")) == [("1", "a"), ("2", "b")]
    texts = spark.createDataFrame([(1, "2024-05-01", "x\ny\n")], "emp_id int, run_date string, value string")
    sinks.write_alerts(texts, folder + "/alerts", "2024-05-01")
    assert [r.value for r in spark.read.text(folder + "/alerts/run_date=2024-05-01").collect()] == ["x", "y", ""]
    sinks.write_alerts(texts.filter("false"), folder + "/alerts", "2024-05-01")
    assert spark.read.text(folder + "/alerts/run_date=2024-05-01").isEmpty()


def test_upsert_statement():
    assert jdbc.upsert_statement("t", "s", "id", ["id", "a", "b"]) == (
        "INSERT INTO t (id, a, b) SELECT id, a, b FROM s ON CONFLICT (id) DO UPDATE SET"
        " a = EXCLUDED.a, b = EXCLUDED.b"
    )


def test_words_in_any_layout_are_read_by_line(spark, folder):
    words = ["a,b", 'say "hi"', "back\\slash", "line\nend", "]", "[x", "é", "", "日本"]
    put(folder, "w/1.json", json.dumps(words, indent=2))
    put(folder, "w/2.json", json.dumps(words, ensure_ascii=False) + "\n" + json.dumps(["more"]))
    put(folder, "w/3.json", "[]")
    found = files.read_words(spark, folder + "/w")
    assert sorted(r[0] for r in found.collect()) == sorted([*words, "more"])
    assert "wholetext" not in plan(found).lower()
