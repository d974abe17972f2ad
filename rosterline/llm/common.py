"""Helpers that several operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Documents are long, so a batch for Python holds few of them.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows that go to Python at once; a smaller setting of the cluster stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, rows)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`.

    Only a local session, whose tasks all see the local disk, may leave the setting
    out; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="checkpoints-")


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Later uses read the files, so neither a lost executor nor a second use computes
    the rows again, and numbers drawn while writing stay as they are.
    """
    path = shared_folder(df.sparkSession)
    for folders in _watched:
        folders.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_watched: list[list[str]] = []


@contextmanager
def staged_folders() -> Iterator[list[str]]:
    """The folders that `staged` starts on inside, in order."""
    folders: list[str] = []
    _watched.append(folders)
    try:
        yield folders
    finally:
        _watched[:] = [other for other in _watched if other is not folders]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing that is still to be computed may read it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_key(id_column: str, text_column: str) -> Column:
    """Tells the rows of a table apart: rows with the same key are the same document twice.

    Two columns of 64 bits, of which the id alone is enough where ids are unique.
    """
    return F.struct(
        F.xxhash64(F.col(id_column).cast("string"), F.col(text_column)).alias("a"),
        F.crc32(F.coalesce(F.col(text_column), F.lit("")).cast("binary")).alias("b"),
    )


def utf8(column) -> list[bytes]:
    """The values of an Arrow string column as UTF-8, null as empty."""
    return [value or b"" for value in column.cast("binary").to_pylist()]


def linked_components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: (node, component) from rows (a, b).

    Nodes are longs; a row (a, a) states a node without links. Every round each node
    tells its neighbours the smallest node it knows, and then the smallest one also
    points its old neighbours on, which halves long chains: rounds grow with the
    logarithm of the longest chain. A hot node is a key of aggregates that combine
    before the exchange, and of joins that adaptive execution splits. Rounds are
    written to the shared folder; nothing but two counts comes to the driver.
    """
    edges = staged(links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).distinct())
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    state = staged(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        # (root, root) for every edge whose ends disagree; the larger root joins the smaller.
        left = state.select(F.col("node").alias("a"), F.col("component").alias("x"))
        right = state.select(F.col("node").alias("b"), F.col("component").alias("y"))
        apart = edges.join(left, "a").join(right, "b").filter("x <> y")
        moves = staged(
            apart.select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("to"))
            .groupBy("node")
            .agg(F.min("to").alias("to"))
        )
        if moves.isEmpty():
            return state
        state = _jump(_jump_once(state, moves))


def _jump_once(state: DataFrame, moves: DataFrame) -> DataFrame:
    to = moves.select(F.col("node").alias("component"), "to")
    return staged(
        state.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    )


def _jump(state: DataFrame) -> DataFrame:
    """Follow pointers until every component points to itself."""
    while True:
        roots = state.select(F.col("node").alias("component"), F.col("component").alias("to"))
        moved = state.join(roots, "component")
        if moved.filter("to <> component").isEmpty():
            return state
        state = staged(moved.select("node", F.col("to").alias("component")))


def packed_texts(
    df: DataFrame, id_column: str, text_column: str, carried: Column | None = None
) -> DataFrame:
    """(key, id, packed): every text compressed before it crosses an exchange, null as empty.

    Another column may be carried in the id's place.
    """

    def rows(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack(text) for text in utf8(batch.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), packed], names=["key", "id", "packed"]
            )

    source = df.select(
        text_key(id_column, text_column).alias("key"),
        (F.col(id_column) if carried is None else carried).alias("id"),
        F.col(text_column).alias("text"),
    )
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(rows, f"key struct<a:bigint,b:bigint>, id {kind}, packed binary")


def unpacked(column) -> list[bytes]:
    """The texts of an Arrow column of `packed_texts`."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) if x else b"" for x in column.to_pylist()]


def larger_batches(batches, most_bytes: int = 8 << 20):
    """Arrow batches put together to about so many bytes, so that fewer words are looked up twice."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class Memory:
    """What a Python worker remembers of words: of `most` entries the half last added or used.

    Two halves: when the young one is full it becomes the old one, and what is asked for
    again moves back. So frequent words stay and memory is bounded.
    """

    LONGEST = 64

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def table(self, lists: list[list[bytes]], compute) -> dict:
        """The entries of all words of some lists; `compute` gives those of a list of new words."""
        words = list(set().union(*lists))
        table = dict(zip(words, map(self.young.get, words), strict=True))
        missing = [w for w, value in table.items() if value is None]
        again = dict(zip(missing, map(self.old.get, missing), strict=True))
        new = [w for w, value in again.items() if value is None]
        if new:
            again.update(compute(new))
        for word, value in again.items():
            self.add(word, value)
        table.update(again)
        return table

    def recall(self, word: bytes):
        """The entry of a word, None where neither half has one."""
        value = self.young.get(word)
        if value is None:
            value = self.old.get(word)
            if value is not None:
                self.add(word, value)
        return value

    def add(self, word: bytes, value) -> None:
        if len(word) <= self.LONGEST:
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            self.young[word] = value


# A comma or full stop in front of white space that does not follow a digit, a letter of
# ASCII or one from U+00C0 to U+00FF.
_JOINED_MARK = re.compile(
    rb"(?<![a-z0-9])(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])[,.](?=[\x20\x09-\x0D]|\Z)"
)


def folded_chunks(text: bytes) -> list[bytes]:
    """What lies between ASCII white space, with A-Z in lower case and last marks apart where safe.

    For tokenizers that lower case after composing characters, and to which a mark behind a
    letter or digit is a word of its own.
    A special token is spelled as it is, and a combining mark may compose with one case of a
    letter only, so texts with either stay as they are; U+0300 to U+036F begin with the bytes
    CC and CD.
    """
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text.split()
    text = text.lower()
    if _JOINED_MARK.search(text):
        return text.split()
    for mark in (b",", b"."):
        for white in (b" ", b"\n"):
            text = text.replace(mark + white, b" " + mark + white)
    return text.split()


def word_hashes(lists: list[list[bytes]]) -> np.ndarray:
    """64-bit hashes of the words of some lists, one after the other."""
    hash_of = xxhash.xxh3_64_intdigest
    table = {w: hash_of(w) for w in set().union(*lists)}
    total = sum(map(len, lists))
    return np.fromiter(map(table.__getitem__, chain.from_iterable(lists)), np.uint64, total)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no order of the input."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
