"""Best-two-fit packing of tokenised documents into sequences of fixed capacity.

A sequence is filled greedily, the largest piece that fits first. Then its smallest
piece is taken out again if two unpacked pieces fit the widened gap more tightly.

Which pieces go together depends on their lengths alone, and lengths run from 1 to the
capacity. So the plan is made on the histogram of lengths, whatever the number of
documents: a combination that the method finds is repeated for as long as its lengths
last, which gives the same sequences as finding it anew each time. The pieces
themselves never leave the executors; each learns its place from its length and its
number among the pieces of that length.
"""

from __future__ import annotations

import gc
import os
import zlib
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rosterline.llm.common import Memory, folded_chunks, larger_batches, staged, utf8

CAPACITY = 2048
END_ID = 0
# Chunks that a Python worker remembers, and bytes of text that it looks up at once.
REMEMBERED, BATCH_BYTES = 1_100_000, 12 << 20
_remembered: dict[str, Memory] = {}


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=2)
def _ends(path: str) -> np.ndarray:
    """Which ids end a word."""
    vocabulary = _tokenizer(path).get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return ends


def _packed_ids(path: str, texts: list[bytes], remembered: int = REMEMBERED) -> list[bytes]:
    """The ids of each text as little-endian 32-bit numbers, without the end.

    Tokens of this tokenizer never cross ASCII white space, so chunks between white
    space are encoded once and looked up after that.
    """

    tokenizer, ends = _tokenizer(path), _ends(path)

    def encoded(chunks):
        found, rest, run = {}, [], []
        for chunk in chunks:
            (run if chunk.isalpha() else rest).append(chunk)
        # A chunk of ASCII letters is one word, so runs of them are encoded at once and cut
        # behind the tokens that end a word.
        for at in range(0, len(run), 512):
            part = run[at : at + 512]
            ids = tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids
            packed = array("I", ids).tobytes()
            cuts = (4 * np.flatnonzero(ends[ids]) + 4).tolist()
            found.update(
                (c, packed[a:b]) for c, a, b in zip(part, [0, *cuts[:-1]], cuts, strict=True)
            )
        plain = [c.decode("utf-8", "replace") for c in rest]
        for chunk, one in zip(rest, tokenizer.encode_batch_fast(plain, add_special_tokens=False), strict=True):
            found[chunk] = array("I", one.ids).tobytes()
        return found

    chunks = [folded_chunks(text) for text in texts]
    ids = _remembered.setdefault(path, Memory(remembered)).table(chunks, encoded)
    return [b"".join(map(ids.__getitem__, own)) for own in chunks]


def tokenised_pieces(
    df: DataFrame,
    path: str,
    id_column: str,
    text_column: str,
    capacity: int = CAPACITY,
    remembered: int = REMEMBERED,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per piece: (part, id, piece, start, length, ids_crc32, nth).

    `nth` numbers the pieces of one length inside a partition, `part`. Documents up to
    the capacity stay whole, longer ones are cut into full pieces and a rest.
    """

    def rows(batches):
        # Nothing here refers to itself, and collections would walk millions of chunks.
        gc.set_threshold(200_000, 50, 100)
        part, seen = TaskContext.get().partitionId(), Counter()
        end = END_ID.to_bytes(4, "little")
        for batch in larger_batches(batches, batch_bytes):
            taken, table = [], []
            for at, ids in enumerate(_packed_ids(path, utf8(batch.column(1)), remembered)):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[start : start + 4 * capacity]
                    length = len(cut) // 4
                    taken.append(at)
                    table.append((piece, start // 4, length, zlib.crc32(cut), seen[length]))
                    seen[length] += 1
            columns = np.array(table, np.int64).reshape(-1, 5)
            piece, start, length, crc, nth = (pa.array(columns[:, i]) for i in range(5))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(taken), part, np.int64)),
                    batch.column(0).take(pa.array(taken, pa.int64())),
                    piece.cast(pa.int32()),
                    start,
                    length,
                    crc,
                    nth,
                ],
                names=["part", "id", "piece", "start", "length", "ids_crc32", "nth"],
            )

    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = (
        f"part bigint, id {source.schema['id'].dataType.simpleString()}, piece int, start bigint,"
        " length bigint, ids_crc32 bigint, nth bigint"
    )
    return source.mapInArrow(rows, schema)


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """The plan: (number of sequences, lengths in each), from pieces of each length."""
    left = {length: n for length, n in sorted(counts.items()) if n > 0}
    plan = []
    while left:
        lengths = list(left)
        items, gap, free = [], capacity, dict(left)
        at = bisect_right(lengths, gap)
        while at:
            length = lengths[at - 1]
            take = min(free[length], gap // length)
            items += [length] * take
            free[length] -= take
            gap -= take * length
            at = min(at - 1, bisect_right(lengths, gap))
        if gap and items:
            pair = _two_tighter(free, items[-1], gap + items[-1])
            if pair:
                items[-1:] = pair
        need = Counter(items)
        times = min(left[length] // n for length, n in need.items())
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        plan.append((times, sorted(items, reverse=True)))
    return plan


def _two_tighter(free: dict[int, int], smallest: int, room: int) -> list[int] | None:
    """The two free lengths whose sum fits `room` best, if above `smallest`."""
    lengths = np.array([length for length, n in free.items() if n], np.int64)
    if not len(lengths):
        return None
    twice = np.array([free[int(x)] > 1 for x in lengths])
    partner = np.searchsorted(lengths, room - lengths, "right") - 1
    own = np.arange(len(lengths))
    partner = np.where((partner == own) & ~twice, partner - 1, partner)
    sums = np.where(partner >= 0, lengths + lengths[partner], 0)
    best = int(sums.argmax())
    if sums[best] <= smallest:
        return None
    return sorted([int(lengths[best]), int(lengths[partner[best]])], reverse=True)


def _places(plan: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first number, sequences from, copies in one, and their offsets, by plan row."""
    rows, sequence, given = defaultdict(list), 0, Counter()
    for times, items in plan:
        offsets, at = defaultdict(list), 0
        for length in items:
            offsets[length].append(at)
            at += length
        for length, where in offsets.items():
            rows[length].append((given[length], sequence, len(where), where[0]))
            given[length] += len(where) * times
        sequence += times
    # Copies of one length lie side by side, so the first offset gives the others.
    return {length: tuple(np.array(x, np.int64).T) for length, x in rows.items()}


def pack(
    df: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    remembered: int = REMEMBERED,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Pack all documents: (id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is its end token alone. Ids may be null or repeated, each row
    is a document. An empty table gives no rows. Only the histogram of lengths (at most
    `capacity` rows) comes to the driver, and the plan that goes back holds a few rows
    per length. Pieces are written to the shared folder once, so that their numbers
    stay; they then meet the first number of their length in their partition in a join
    whose keys hold one partition's pieces at most. `remembered` and `batch_bytes` trade
    memory of a Python worker for time.
    """
    pieces = staged(
        tokenised_pieces(df, path, id_column, text_column, capacity, remembered, batch_bytes)
    )
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(best_two_fit(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def placed(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            number = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                mine = length == one
                first, from_sequence, copies, at = places[int(one)]
                row = np.searchsorted(first, number[mine], "right") - 1
                since = number[mine] - first[row]
                sequence[mine] = from_sequence[row] + since // copies[row]
                offset[mine] = at[row] + since % copies[row] * one
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = pieces.join(firsts, ["part", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number")
    )
    kind = pieces.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint,"
        " sequence_id bigint, offset bigint"
    )
    return numbered.mapInArrow(placed, schema).withColumnRenamed("id", id_column)
