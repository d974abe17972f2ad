"""The strike ladder as keyed state: late and repeated flags, and strikes that expire by themselves.

Two queries. `start_flag_stream` turns messages into flags, each with the record it came
from, and writes them as one directory per batch. `strike_changes` reads those flags as a
stream and keeps one state per employee; a timer for each flag lowers the strikes when the
event-time clock has passed its thirty days, without any new flag and without a call from
outside.

The clock is the watermark: the latest event time seen, less `delay`. What is older than
the clock when it arrives is late and left out, and a record that arrives again within the
delay counts once. An employee is struck out once any thirty days hold as many flags as
there are steps. So the outcome follows from the flags that were in time and from the
clock, not from how they were dealt out to batches: `operators.strikes.strike_standing` is
the same as a batch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from rosterline.functions.money import step_price
from rosterline.operators.keyed import latest_per_key
from rosterline.operators.messages import flag_listed, parse_messages, word_table
from rosterline.operators.strikes import FLAG_DAYS
from rosterline.schemas import FLAG, STRIKE_CAP, STRIKE_STEPS, STRIKES
from rosterline.sources.files import read_or_empty
from rosterline.sources.sinks import replace_partition, stage

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"

_DAY_US = 86_400_000_000
# Flags of one employee read before looking whether they strike out already.
LOOK_EVERY = 1000


def most_within(instants: Counter[int], span: int) -> int:
    """The most flags that any stretch of `span` holds, both ends included."""
    most = held = 0
    ordered = sorted(instants)
    first = 0
    for at in ordered:
        held += instants[at]
        while ordered[first] < at - span:
            held -= instants[ordered[first]]
            first += 1
        most = max(most, held)
    return most


class StrikeProcessor(StatefulProcessor):
    """Per employee: the flags that still count, a salary, and the last row told.

    Nobody who is not struck out has as many flags in thirty days as there are steps, so the
    state of an employee is small however many flags come in; being struck out is one row.
    """

    CHANGE = "employee_id string, salary double, no_of_strikes int, revision bigint"

    def __init__(self, days: int = FLAG_DAYS, cap: int = STRIKE_CAP):
        self.span, self.cap = days * _DAY_US, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._flags = handle.getMapState("flags", "at bigint", "n bigint")
        self._told = handle.getValueState("told", "salary double, no_of_strikes int, revision bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._told.update((initialState.salary, initialState.no_of_strikes or 0, 0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        told = self._state()
        if told[1] >= self.cap:
            return
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        known = Counter({at: n for (at,), (n,) in self._flags.iterator()})
        old = dict(known)
        for i, row in enumerate(rows, 1):
            known[row.at] += 1
            if i % LOOK_EVERY == 0 and most_within(known, self.span) >= self.cap:
                break
        if most_within(known, self.span) >= self.cap:
            for at in old:
                self._handle.deleteTimer(self._expiry(at))
            self._flags.clear()
            yield from self._tell(key, told, self.cap)
            return
        for at, n in known.items():
            if old.get(at) != n and at >= clock - self.span:
                self._flags.updateValue((at,), (n,))
                self._handle.registerTimer(self._expiry(at))
        yield from self._tell(key, told, self._counting(known, clock))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        known = Counter({at: n for (at,), (n,) in self._flags.iterator()})
        for at in known:
            if at < clock - self.span:
                self._flags.removeKey((at,))
        yield from self._tell(key, self._state(), self._counting(known, clock))

    def close(self) -> None:
        """Nothing is open."""

    def _state(self):
        told = self._told.get()
        return told if told is not None else (None, 0, 0)

    def _expiry(self, at: int) -> int:
        """The first millisecond at which a flag no longer counts."""
        return (at + self.span) // 1000 + 1

    def _counting(self, known: Counter[int], clock: int) -> int:
        return sum(n for at, n in known.items() if at >= clock - self.span)

    def _tell(self, key, told, strikes: int) -> Iterator[Row]:
        salary, before, revision = told
        if strikes != before:
            self._told.update((salary, strikes, revision + 1))
            if salary is not None:  # an employee without a strike row has nothing to lower
                yield Row(employee_id=key[0], salary=salary, no_of_strikes=strikes, revision=revision + 1)


def priced(changes: DataFrame) -> DataFrame:
    """Strike rows from salary and number of strikes: the price of every step reached."""
    steps = [
        F.when(F.col("no_of_strikes") >= i, step_price(F.col("salary"), i)).alias(step)
        for i, step in enumerate(STRIKE_STEPS, 1)
    ]
    rest = [c for c in changes.columns if c not in STRIKES.fieldNames()]
    return changes.select("employee_id", "salary", *steps, "no_of_strikes", *rest)


def strike_changes(
    flags: DataFrame,
    strikes: DataFrame,
    position: Sequence[str],
    delay: str = "1 day",
    days: int = FLAG_DAYS,
    cap: int = STRIKE_CAP,
) -> DataFrame:
    """A stream of changed strike rows from a stream of flags, with a `revision` per employee.

    `flags` has `employee_id`, `start_date` and `position`, the columns that name the record a
    flag comes from. `strikes` are the rows that the first batch starts from, one per
    employee. Flags without an employee or time count for nobody.
    """
    timed = flags.filter("employee_id IS NOT NULL AND start_date IS NOT NULL")
    once = timed.withWatermark("start_date", delay).dropDuplicatesWithinWatermark(list(position))
    at = F.unix_micros(F.col("start_date")).alias("at")
    initial = strikes.select("employee_id", "salary", "no_of_strikes").groupBy("employee_id")
    changes = (
        once.select("employee_id", "start_date", at)
        .groupBy("employee_id")
        .transformWithState(
            StrikeProcessor(days, cap), StrikeProcessor.CHANGE, "Append", "EventTime", initial
        )
    )
    return priced(changes)


def _triggered(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_flag_stream(
    messages: DataFrame,
    vocab: DataFrame,
    marked: DataFrame,
    table: str,
    checkpoint: str,
    position: Sequence[str],
    event_time: str,
    value: str = "value",
    interval: str | None = "30 seconds",
) -> StreamingQuery:
    """Write the flags of a message stream with their records, one directory per batch.

    A batch that is repeated replaces its directory. With `interval` None the query takes
    what is there and stops. The listed words are written once, next to the checkpoint.
    """
    listed = stage(word_table(vocab, marked), f"{checkpoint.rstrip('/')}-words")
    keep = [*position, event_time]

    def run(batch_df: DataFrame, batch: int) -> None:
        flagged = flag_listed(parse_messages(batch_df, value, keep), listed, keep)
        when = F.col(event_time).cast("timestamp").alias("start_date")
        replace_partition(flagged.select(*position, "employee_id", when), table, {"batch": str(batch)})

    return _triggered(messages.writeStream.foreachBatch(run), checkpoint, interval)


def read_flags(spark: SparkSession, table: str, position: str) -> DataFrame:
    """The flags of `start_flag_stream` as a stream; `position` declares its columns."""
    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FLAG.fields)
    return spark.readStream.schema(f"{position}, {named}").parquet(table)


def start_keyed_strikes(
    flags: DataFrame,
    strikes: DataFrame,
    table: str,
    checkpoint: str,
    position: Sequence[str],
    delay: str = "1 day",
    interval: str | None = "30 seconds",
    forward: Callable[[DataFrame, int], None] | None = None,
    **options,
) -> StreamingQuery:
    """Write `strike_changes` as one directory per batch and hand each batch on, read back.

    State is kept in RocksDB below the checkpoint. `forward(changes, batch)` may see a batch
    again after a failure; `streaming.once` makes a target take it once.
    """
    spark = flags.sparkSession
    if spark.conf.get(_PROVIDER_KEY) != STATE_PROVIDER:
        spark.conf.set(_PROVIDER_KEY, STATE_PROVIDER)
    changes = strike_changes(flags, strikes, position, delay, **options)

    def run(batch_df: DataFrame, batch: int) -> None:
        path = replace_partition(batch_df, table, {"batch": str(batch)})
        if forward is not None:
            forward(spark.read.schema(batch_df.schema).parquet(path), batch)

    return _triggered(changes.writeStream.foreachBatch(run).outputMode("append"), checkpoint, interval)


def current_strikes(spark: SparkSession, table: str, strikes: DataFrame) -> DataFrame:
    """The strike rows the stream started from, each replaced by its last change."""
    changed = read_or_empty(spark, table, _changes_schema(strikes))
    known = priced(strikes.select("employee_id", "salary", "no_of_strikes")).withColumn("revision", F.lit(0).cast("bigint"))
    return latest_per_key(known.unionByName(changed), ["employee_id"], "revision").drop("revision")


def _changes_schema(strikes: DataFrame):
    return (
        priced(strikes.select("employee_id", "salary", F.col("no_of_strikes").cast("int")))
        .withColumn("revision", F.lit(0).cast("bigint"))
        .schema
    )
