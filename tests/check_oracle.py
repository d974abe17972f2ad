"""Compare check queries with their SQL: `python tests/check_oracle.py SF_DIR [name ...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, sf: str, name: str) -> str:
    """Empty when columns and rows agree, else what differs."""
    frame = contract.queries()[name](spark, sf)
    result = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    wrong = [c for c, kind in frame.dtypes if SQL_TYPES.get(kind) != kinds[c]]
    if wrong:
        return f"types of {wrong}: {frame.dtypes} / {kinds}"
    got, want = rows_of(frame.columns, frame.collect()), rows_of(columns, result.fetchall())
    if got == want:
        return ""
    extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"rows {len(got)} / {len(want)}; only spark {extra}; only sql {missing}"


def main() -> int:
    from rosterline.session import build_session

    sf, names = sys.argv[1], sys.argv[2:] or list(contract.oracle_sql())
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name in names:
        begin = time.time()
        problem = compare(spark, con, sf, name)
        failed += bool(problem)
        print(f"{name:28s} {'ok' if not problem else 'DIFFERS ' + problem} {time.time() - begin:.1f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
