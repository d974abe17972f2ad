"""Periodic runs of words, solved tile by tile for each octave of periods.

A run is a stretch of words with smallest period q that no neighbour extends. Its places
with word[i] = word[i + q] are one interval, and the run is known once that interval is.

Octave k has the periods from 2^k to 2^(k+1) (the lowest one those from 1 to 7), and a
boundary every 2^k words. An interval worth reporting is at least as long as two boundaries
are apart, so it holds one; Z-functions forward and backward of a boundary give for all periods of
the octave at once how far equality reaches, as far as two boundaries away. A document is
exploded into overlapping tiles of up to `BOUNDARIES` boundaries with the words around
them; tiles go to any task, know nothing of each other, and yield fragments of intervals.
Fragments meet by document and period and are stitched where they touch.

Tiles around which no stretch of half a boundary's distance occurs again at a distance of
the octave cannot hold a fragment and are not made; hashes tell, the words themselves decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import mixed, staged, text_key, utf8

# The least words of a run, whatever its period.
LEAST = 12
# The lowest octave: periods from 1, boundaries every 2^LOWEST words.
LOWEST = 2
# Boundaries of a tile, fewer where they are far apart: one more of them adds so many words at most.
BOUNDARIES, TILE_WORDS = 16, 1 << 16


def reach(octave: int) -> int:
    """How far Z-functions look from a boundary on either side."""
    return max(LEAST, 2 << octave)


def least_matches(period: int) -> int:
    """Places that equal the one a period further on, in the shortest run."""
    return max(LEAST, 2 * period) - period


def z_function(words: list[int]) -> list[int]:
    """For each place how long what follows it equals the beginning; the first entry is the length."""
    n = len(words)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def boundary_fragments(words: list[int], at: int, octave: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the matching places around a boundary, for periods of the octave.

    Only periods whose word at the boundary is no power of a shorter one, and only stretches
    that make a run of their own.
    """
    far, top = reach(octave), 2 << octave
    forward = z_function(words[at : at + top + far])
    low = 1 if octave == LOWEST else 1 << octave
    good = [q for q in range(low, min(top, len(forward))) if forward[q] > 0]
    if not good:
        return
    first = max(0, at - far)
    pattern = words[first:at][::-1]
    # Words before boundary + period, backward: place `last - period` of what follows the mark.
    last = min(top - 1, len(words) - at)
    follow = words[first : at + last][::-1]
    backward = z_function([*pattern, -1, *follow[: last - low + 1 + far]])
    for q in good:
        behind = backward[len(pattern) + 1 + last - q] if pattern and q <= last else 0
        if behind + forward[q] >= least_matches(q) and all(
            forward[q // p] < q - q // p for p in _prime_factors(q)
        ):
            yield q, at - behind, at + forward[q]


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(period, start, end) with what touches put together."""
    found: list[tuple[int, int, int]] = []
    for q, start, end in sorted(spans):
        if found and found[-1][0] == q and start <= found[-1][2]:
            found[-1] = (q, found[-1][1], max(end, found[-1][2]))
        else:
            found.append((q, start, end))
    return found


def _low_boundaries(ids: np.ndarray) -> np.ndarray:
    """Boundaries of the lowest octave near six places in a row that match at some period."""
    found = []
    for q in range(1, 2 << LOWEST):
        same = ids[:-q] == ids[q:]
        two = same[:-1] & same[1:]
        four = two[:-2] & two[2:]
        at = np.flatnonzero(four[:-2] & two[4:])
        found += [(at + step) >> LOWEST << LOWEST for step in (3, 5)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _joined(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mixed(one + two * np.uint64(0x9E3779B97F4A7C15), 4)


def living_boundaries(ids: np.ndarray, document: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries) near which a run of the octave's periods may lie.

    `ids` are the words of some documents one after the other, with a mark of its own
    behind each; equal words of different documents are told apart by `document`.
    """
    n = len(ids)
    if n <= 8:
        return
    yield LOWEST, _low_boundaries(ids)
    word = mixed(ids.astype(np.uint64) + (document.astype(np.uint64) << np.uint64(32)), 3)
    pair = _joined(word[:-1], word[1:])
    hashes = np.zeros(n, np.uint64)
    hashes[: n - 3] = _joined(pair[:-2], pair[2:])
    places, size, octave = np.arange(n - 3), 4, LOWEST + 1
    while len(places):
        # Places whose stretch of `size` words occurs more than once, by stretch and place.
        values = hashes[places]
        order = np.argsort(values, kind="stable")
        values, places = values[order], places[order]
        same = values[1:] == values[:-1]
        often = np.append(same, False) | np.insert(same, 0, False)
        group = np.cumsum(np.insert(~same, 0, True))[often] if len(often) else np.zeros(0, np.int64)
        places = places[often]
        if not len(places):
            return
        own = places % size == 0
        key = group * n + places
        ahead = np.searchsorted(key, key[own] + 2 * size)
        near = key[np.minimum(ahead, len(key) - 1)]
        block = places[own][(ahead < len(key)) & (near < key[own] + 4 * size)]
        # A boundary's interval holds a block that begins from two before it to one behind it.
        around = (block[:, None] + np.array([-size, 0, size, 2 * size])).ravel()
        yield octave, np.unique(around[(around % (2 * size) == 0) & (around >= 0)])
        known = np.zeros(n, bool)
        known[places] = True
        places = places[places + size < n]
        places = np.sort(places[known[places + size]])
        hashes[places] = _joined(hashes[places], hashes[places + size])
        size, octave = 2 * size, octave + 1


def tiles_of(texts: list[list[bytes]]) -> Iterator[tuple[int, int, int, list[int], bytes]]:
    """(document, octave, place of the tile, boundaries in the tile, numbers of its words)."""
    number = {w: i for i, w in enumerate(set().union(*texts))}
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ids = np.empty(int((sizes + 1).sum()), np.int32)
    for k, (start, words) in enumerate(zip(starts.tolist(), texts, strict=True)):
        ids[start : start + len(words)] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        ids[start + len(words)] = -1 - k
    document = np.repeat(np.arange(len(texts)), sizes + 1)
    for octave, living in living_boundaries(ids, document):
        living = living[living < len(ids)]
        whose = document[living]
        inside = living < (starts + sizes)[whose]
        living, whose = living[inside], whose[inside]
        far, most = reach(octave), max(1, min(BOUNDARIES, TILE_WORDS >> octave))
        cuts = np.flatnonzero((np.diff(living) != 1 << octave) | (np.diff(whose) != 0)) + 1
        for run in np.split(np.arange(len(living)), cuts):
            for i in range(0, len(run), most):
                part = living[run[i : i + most]]
                k = int(whose[run[0]])
                low = max(int(starts[k]), int(part[0]) - far)
                high = min(int(starts[k] + sizes[k]), int(part[-1]) + (2 << octave) + far)
                yield k, octave, low - int(starts[k]), (part - low).tolist(), ids[low:high].tobytes()


def tile_fragments(octave: int, boundaries: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """(period, start, end) of matching places in a tile, what touches put together."""
    return merged([f for at in boundaries for f in boundary_fragments(words, at, octave)])


_TILE = "struct<octave:int,place:bigint,boundaries:array<int>,words:binary>"
_TILE_TYPE = pa.struct(
    [
        ("octave", pa.int32()),
        ("place", pa.int64()),
        ("boundaries", pa.list_(pa.int32())),
        ("words", pa.binary()),
    ]
)


def _tiled(df: DataFrame, id_column: str, text: Column) -> DataFrame:
    """(key, id, whole, packed, tiles): each document with its tiles.

    `whole` is the digest of its words joined by one space; `packed` are these, compressed,
    and null where there are no tiles.
    """

    def rows(batches: Iterable[pa.RecordBatch]):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = [t.split() for t in utf8(batch.column(2))]
            tiles: list[list] = [[] for _ in texts]
            for k, octave, place, boundaries, words in tiles_of(texts) if texts else ():
                tiles[k].append(
                    {"octave": octave, "place": place, "boundaries": boundaries, "words": pack(words)}
                )
            lines = [b" ".join(words) for words in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([hashlib.sha256(line).hexdigest() for line in lines], pa.string()),
                    pa.array(
                        [pack(line) if t else None for line, t in zip(lines, tiles, strict=True)], pa.binary()
                    ),
                    pa.array(tiles, pa.list_(_TILE_TYPE)),
                ],
                names=["key", "id", "whole", "packed", "tiles"],
            )

    source = df.select(F.col(id_column).alias("id"), text.alias("text")).select(
        text_key("id", "text").alias("key"), "id", "text"
    )
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        rows, f"key struct<a:bigint,b:bigint>, id {kind}, whole string, packed binary, tiles array<{_TILE}>"
    )


def _fragments(tiled: DataFrame) -> DataFrame:
    """(key, period, start, end) of matching places, tile by tile."""

    def rows(batches: Iterable[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            spans, index = [], []
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            for i, (octave, place, boundaries, packed) in enumerate(zip(*columns, strict=True)):
                words = np.frombuffer(unpack(packed), np.int32).tolist()
                for q, start, end in tile_fragments(octave, boundaries, words):
                    spans.append((q, place + start, place + end))
                    index.append(i)
            found = zip(*spans, strict=True) if spans else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), *[pa.array(x, pa.int64()) for x in found]],
                names=["key", "period", "start", "end"],
            )

    exploded = tiled.select("key", F.explode("tiles").alias("tile")).select("key", "tile.*")
    # Tiles of one long document are many: they are dealt out one by one.
    dealt = exploded.repartition("key", "octave", "place")
    return dealt.mapInArrow(rows, "key struct<a:bigint,b:bigint>, period bigint, start bigint, end bigint")


def _stitched(fragments: DataFrame) -> DataFrame:
    """(key, start, length, period) of runs."""
    ordered = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before >= F.col("start"), 0).otherwise(1)
    return (
        fragments.withColumn("fresh", fresh)
        .withColumn("stretch", F.sum("fresh").over(ordered))
        .groupBy("key", "period", "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("key", "start", (F.col("end") + F.col("period") - F.col("start")).alias("length"), "period")
    )


def _collapsed(texts: DataFrame) -> DataFrame:
    """(key, id, runs, collapsed): the words of `packed` without what repeats within runs, joined by one space."""

    def rows(batches: Iterable[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = []
            for packed, runs in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = unpack(packed).split() if packed else []
                found.append(b" ".join(kept_words(words, [(r["start"], r["length"], r["period"]) for r in runs])))
            collapsed = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], collapsed], names=["key", "id", "runs", "collapsed"]
            )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("key", "id", "runs", "packed").mapInArrow(
        rows, f"key struct<a:bigint,b:bigint>, id {kind}, runs {_RUNS}, collapsed binary"
    )


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run of (start, length, period) contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(change).tolist(), strict=False) if not covered]


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(df: DataFrame, id_column: str = "doc_id", text: Column | str = "text") -> DataFrame:
    """(id, runs, collapsed, whole): one row per row, runs by start and period.

    Words are what stands between ASCII white space. A run of smallest period q has at
    least 12 words and at least 2 * q. `collapsed` are the words outside what runs repeat,
    joined by one space, as UTF-8, and null where no run can be: all words stay, and `whole`
    is the digest of all words. Null and empty texts have no runs. Ids may be null or
    repeated, rows too; columns may have any names. A document's runs are fewer than its words.
    """
    tiled = staged(_tiled(df, id_column, F.col(text) if isinstance(text, str) else text))
    found = (
        _stitched(_fragments(tiled))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    )
    # Without tiles there is nothing to look up: only documents with some are joined.
    some = tiled.filter("packed IS NOT NULL").select("key", "id", "packed", "whole")
    none = tiled.filter("packed IS NULL").select(
        "id", F.expr(f"CAST(array() AS {_RUNS})").alias("runs"), F.lit(None).cast("binary").alias("collapsed"), "whole"
    )
    no_runs = F.expr(f"CAST(array() AS {_RUNS})")
    met = some.join(found, "key", "left").withColumn("runs", F.coalesce("runs", no_runs))
    solved = _collapsed(met).select("id", "runs", "collapsed", F.lit(None).cast("string").alias("whole"))
    return none.unionByName(solved).withColumnRenamed("id", id_column)


def run_report(df: DataFrame, id_column: str = "doc_id", text: Column | str = "text") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256).

    The run of the greatest length, of equal ones the first by start and period; null in
    all four columns without a run.
    """
    found = periodic_runs(df, id_column, text)
    longest = F.array_min(
        F.transform(
            "runs",
            lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")),
        )
    )
    line = F.transform(
        "runs",
        lambda r: F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")]),
    )
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", longest).select(
        id_column,
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.coalesce("whole", F.sha2("collapsed", 256)).alias("collapsed_sha256"),
    )


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """A text of which the part from some word on repeats, as told by a checksum of the id.

    One in ten of all ids, told by the checksum of their decimal digits; other texts stay.
    """
    seed = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words).cast("int")
    draw = F.floor(seed / 10)
    first = (draw % F.greatest(n, F.lit(1))).cast("int")
    period = (1 + F.floor((n - first) / (3 + draw % 8))).cast("int")
    times = F.ceil((n - first) / period).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, first + 1, period), times))
    moved = F.concat(F.slice(words, 1, first), F.slice(tail, 1, n - first))
    return F.when((seed % 10 == 0) & (n > 0), F.array_join(moved, " ")).otherwise(text)
