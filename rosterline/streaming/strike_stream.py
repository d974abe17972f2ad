"""The strike ladder over a message stream.

State is kept as Parquet, one directory per batch id, so a repeated batch replaces
its own output and reads only what earlier batches wrote. Every batch writes what it
adds; every `compact_every`-th batch also writes the state it started from in full,
and later batches read that plus what was added since. Tables are partitioned by a hash
bucket of the employee, and a batch reads the buckets of the employees it flags. A batch
without flags writes nothing. Batch ids continue with the checkpoint, so one state
belongs to one checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rosterline.functions.dates import instant
from rosterline.operators.keyed import exclude_ids, latest_per_key, only_ids
from rosterline.operators.messages import flag_listed, parse_messages, word_table
from rosterline.operators.strikes import (
    FLAG_DAYS,
    newly_capped,
    recent_flags,
    rolling_flag_count,
    strike_decay,
    strike_updates,
)
from rosterline.schemas import FLAG, STRIKES
from rosterline.sources.files import read_or_empty
from rosterline.sources.sinks import gathered, stage


def strike_batch(
    flags: DataFrame, history: DataFrame, strikes: DataFrame, as_of: dt.datetime, incremental: bool = False
) -> DataFrame:
    """Strike rows changed by a batch of flags, given earlier flags and current rows.

    Only employees flagged in the batch are looked at; their history is found by a
    semi join, never by collecting ids.
    """
    in_window = recent_flags(flags, as_of)
    past = only_ids(history, in_window, "employee_id")
    counts = rolling_flag_count(past.unionByName(in_window), as_of)
    return strike_updates(strikes, counts, incremental)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("employee_id"), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class StrikeState:
    """Where the stream keeps its tables. The number of buckets belongs to the state."""

    root: str
    compact_every: int = 100
    buckets: int = 32

    def _path(self, table: str, batch: int) -> str:
        return f"{self.root.rstrip('/')}/{table}/batch={batch}"

    def base_of(self, batch: int) -> int:
        """The last batch before `batch` that wrote the full state."""
        return max(batch - 1, 0) // self.compact_every * self.compact_every

    def seed(self, spark: SparkSession, strikes: DataFrame, flags: DataFrame | None = None) -> None:
        """Write the state the stream starts from, as the full state of batch 0."""
        known = flags if flags is not None else spark.createDataFrame([], FLAG)
        self.write(strikes.select(*STRIKES.fieldNames()), "strikes_full", 0)
        self.write(known.select(*FLAG.fieldNames()), "flags_full", 0)

    def write(self, df: DataFrame, table: str, batch: int) -> DataFrame:
        """Write one batch of a table by bucket and read it back, cutting the lineage."""
        path = self._path(table, batch)
        bucketed = gathered(df.withColumn("bucket", _bucket(self.buckets)), ["bucket"])
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)

    def _before(
        self, spark: SparkSession, table: str, schema: T.StructType, batch: int, among: DataFrame | None
    ) -> DataFrame:
        """The last full state of a table and what batches added since, with `batch` (-1 for the full).

        With `among` only rows of those employees: their buckets, at most `buckets` numbers,
        prune the directories that are read.
        """
        base = self.base_of(batch)
        bucketed = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        stored = T.StructType([*bucketed.fields, T.StructField("batch", T.LongType())])
        full = read_or_empty(spark, self._path(f"{table}_full", base), bucketed)
        full = full.withColumn("batch", F.lit(-1).cast("bigint"))
        added = read_or_empty(spark, f"{self.root.rstrip('/')}/{table}", stored)
        rows = full.unionByName(added.filter(F.col("batch").between(base, batch - 1)))
        if among is not None:
            found = among.select(_bucket(self.buckets).alias("bucket")).distinct().collect()
            rows = only_ids(rows.filter(F.col("bucket").isin(*[r.bucket for r in found])), among, "employee_id")
        return rows.drop("bucket")

    def _remove(self, spark: SparkSession, table: str, batch: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(self._path(table, batch))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def compact(self, spark: SparkSession, batch: int, as_of: dt.datetime) -> None:
        """Write the state that `batch` starts from in full; expired flags drop out.

        What the full state before the last one rested on is removed. The last one stays,
        so that the batch can be repeated.
        """
        self.write(self.strikes_before(spark, batch), "strikes_full", batch)
        self.write(recent_flags(self.flags_before(spark, batch), as_of), "flags_full", batch)
        last = batch - self.compact_every
        for old in range(max(last - self.compact_every, 0), last):
            for table in ("strikes", "flags", *(["strikes_full", "flags_full"] * (old % self.compact_every == 0))):
                self._remove(spark, table, old)

    def strikes_before(self, spark: SparkSession, batch: int, among: DataFrame | None = None) -> DataFrame:
        """Strike rows as of the start of a batch, of the listed employees or of all."""
        rows = self._before(spark, "strikes", STRIKES, batch, among)
        return latest_per_key(rows, ["employee_id"], "batch").drop("batch")

    def flags_before(self, spark: SparkSession, batch: int, among: DataFrame | None = None) -> DataFrame:
        """Flags known at the start of a batch (full states drop expired ones)."""
        return self._before(spark, "flags", FLAG, batch, among).drop("batch")

    def struck(self, spark: SparkSession, batch: int) -> DataFrame:
        """Everyone struck out at the start of a batch."""
        return newly_capped(self.strikes_before(spark, batch))

    def decay(self, spark: SparkSession, batch: int, as_of: dt.datetime) -> DataFrame:
        """Lower the strikes of employees whose flags have expired, as part of batch `batch`.

        To be run between batches, `batch` being the last one. Returns the rows that changed.
        """
        changed = strike_decay(
            self.strikes_before(spark, batch + 1), self.flags_before(spark, batch + 1), as_of
        )
        changed = self.write(changed.select(*STRIKES.fieldNames()), "decayed", batch)
        own = read_or_empty(spark, self._path("strikes", batch), STRIKES)
        both = exclude_ids(own, changed, "employee_id").unionByName(changed)
        self.write(self.write(both, "merged", batch), "strikes", batch)
        return changed


Forward = Callable[[dict[str, DataFrame], int], None]


def apply_batch(
    state: StrikeState,
    flags: DataFrame,
    batch: int,
    as_of: dt.datetime,
    incremental: bool = False,
    forward: Forward | None = None,
) -> None:
    """Store a batch of flags and everything that follows from it.

    `forward` gets the stored `flags`, `strikes` and `struck` rows of the batch, to
    pass on to a database or to close timelines; it may see a batch again after a
    failure. All flags are stored and passed on, those in the last 30 days count.

    Each result is written once and later steps read what was written, so nothing is
    evaluated twice and flags of this batch cannot be counted twice. A batch without
    flags changes no strikes and stops there.
    """
    spark = flags.sparkSession
    if batch and batch % state.compact_every == 0:
        state.compact(spark, batch, as_of)
    stored = state.write(flags.select(*FLAG.fieldNames()), "flags", batch)
    if stored.isEmpty():
        return
    current = state.strikes_before(spark, batch, among=stored)
    history = state.flags_before(spark, batch, among=stored)
    changed = strike_batch(stored, history, current, as_of, incremental)
    updates = state.write(changed, "strikes", batch)
    if forward is not None:
        forward({"flags": stored, "strikes": updates, "struck": newly_capped(updates)}, batch)


def start_strike_stream(
    messages: DataFrame,
    vocab: DataFrame,
    marked: DataFrame,
    state: StrikeState,
    checkpoint: str,
    keys: list[str],
    value: str = "value",
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc),
    event_time: str | None = None,
    interval: str | None = "30 seconds",
    incremental: bool = False,
    forward: Forward | None = None,
) -> StreamingQuery:
    """Start the stream: parse, flag, count, price and strike out, batch by batch.

    A flag carries the time its batch is processed, or `event_time` when the stream
    has such a column. With `interval` None the query takes what is there and stops.
    The listed words are written to the state once, when the stream starts.
    """
    listed = stage(word_table(vocab, marked), f"{state.root.rstrip('/')}/words")

    def run(batch_df: DataFrame, batch: int) -> None:
        now = clock()
        keep = [*keys, event_time] if event_time else keys
        flagged = flag_listed(parse_messages(batch_df, value, keep), listed, keep)
        when = F.col(event_time).cast("timestamp") if event_time else instant(now)
        timed = flagged.select("employee_id", when.alias("start_date"))
        apply_batch(state, timed, batch, now, incremental, forward)

    writer = messages.writeStream.foreachBatch(run).outputMode("update").option(
        "checkpointLocation", checkpoint
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
