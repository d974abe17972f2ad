"""Database targets that take each batch of a stream once.

A stream may see a batch again after a failure. Rows are first written to a staging table
of the batch, in parallel and as often as it takes; then one transaction moves them to
their table and enters the batch in a ledger next to it. A batch that the ledger has is
passed over. So half a batch never shows, and a whole one never shows twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rosterline.sources.jdbc import upsert_statement

Stage = Callable[[DataFrame, str], None]

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _name(text: str) -> str:
    if not _NAME.fullmatch(text):
        raise ValueError(f"{text!r} is no table or column name")
    return text


@dataclass(frozen=True)
class Target:
    """Where rows go: a row replaces the one with the same `key`; without a key rows are added."""

    table: str
    key: str | None = None

    def move(self, staging: str, columns: Sequence[str]) -> str:
        """SQL that moves staged rows into the table."""
        names = [_name(c) for c in columns]
        if self.key is not None:
            return upsert_statement(_name(self.table), staging, _name(self.key), names)
        listed = ", ".join(names)
        return f"INSERT INTO {_name(self.table)} ({listed}) SELECT {listed} FROM {staging}"


@dataclass(frozen=True)
class SqlLedger:
    """The batches a database has taken, by stream.

    `query` runs a statement and returns its rows; `transact` runs statements in one
    transaction, all or none. The table's primary key is (stream, batch), so of two drivers
    that try the same batch one fails.
    """

    table: str
    stream: str
    query: Callable[[str], Sequence[Sequence[object]]]
    transact: Callable[[Sequence[str]], object]

    @property
    def _stream(self) -> str:
        return "'" + self.stream.replace("'", "''") + "'"

    def definition(self) -> str:
        """SQL for the ledger's table."""
        return (
            f"CREATE TABLE IF NOT EXISTS {_name(self.table)}"
            " (stream VARCHAR(200) NOT NULL, batch BIGINT NOT NULL, PRIMARY KEY (stream, batch))"
        )

    def has(self, batch: int) -> bool:
        found = self.query(
            f"SELECT batch FROM {_name(self.table)} WHERE stream = {self._stream} AND batch = {int(batch)}"
        )
        return len(found) > 0

    def commit(self, batch: int, statements: Sequence[str]) -> None:
        """Run the statements of a batch and enter it, as one transaction."""
        entry = f"INSERT INTO {_name(self.table)} (stream, batch) VALUES ({self._stream}, {int(batch)})"
        self.transact([entry, *statements])


def take_once(
    targets: Mapping[str, Target], stage: Stage, ledger: SqlLedger, staging: str = "staged"
) -> Callable[[Mapping[str, DataFrame], int], None]:
    """A `forward` for strike streams: named tables of a batch to their targets, once.

    `stage(rows, table)` writes rows to a table of that name and replaces what an earlier
    attempt left there, such as `sources.jdbc.write_table` with mode `overwrite`. Tables
    without a target are left out.
    """
    _name(staging)

    def forward(tables: Mapping[str, DataFrame], batch: int) -> None:
        if ledger.has(batch):
            return
        moves = []
        for name, target in targets.items():
            if name in tables:
                stage(tables[name], f"{staging}_{_name(name)}")
                moves.append(target.move(f"{staging}_{name}", tables[name].columns))
        ledger.commit(batch, moves)

    return forward


def changes_once(target: Target, stage: Stage, ledger: SqlLedger, staging: str = "staged"):
    """`take_once` for a stream with one table per batch, such as `start_keyed_strikes`."""
    forward = take_once({"changes": target}, stage, ledger, staging)
    return lambda rows, batch: forward({"changes": rows}, batch)
