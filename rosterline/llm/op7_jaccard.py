"""Near-duplicate documents: a Jaccard join on word shingles, filtered under several orders.

If two sets are similar enough, their prefixes under any order of all shingles share a
shingle. One order, rare shingles first, is looked up in an index: sets meet that share a
shingle of that prefix. Before two texts are compared in full, their prefixes under each
further order must meet as well.

How rare a shingle is comes from all documents. They are cut into blocks; each block lists
the distinct cells its shingles fall into (the leading bits of their hashes) with counts,
the lists meet by range of cells, and each block gets back a level per cell. Two shingles
in one cell only look more frequent than they are. A set of which too few shingles occur
anywhere else has no partner and goes no further.

Copies are one class from the start. What is asked for are components, so a shingle's sets
are compared in rounds: first each with a hub, then those still apart with some others, and
in the end with all that the links found so far leave apart.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import (
    linked_components,
    mixed,
    staged,
    text_key,
    unpacked,
    utf8,
    word_hashes,
)

SHINGLE = 5
# A character of a word, as a regular expression.
WORD = r"[^\x20\x09-\x0D]"
# Similarity as a share of a hundred.
THRESHOLD = 80
# Seeds of the orders: the first is indexed, the others filter.
ORDERS = (11, 12, 13)
# Hubs that a family of similar sets is compared with first, and neighbours on either side
# that those still apart are compared with then.
HUBS, NEIGHBOURS = 16, 8
# Leading bits of a hash that make its cell; shingles in a block; most ranges of cells.
CELL_BITS, BLOCK_SHINGLES, MOST_RANGES = 40, 600_000, 8192
# About how many cells of a range are sorted at once, in at most so many parts of it.
AT_ONCE, MOST_PARTS = 200_000, 64

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, np.uint64)
    values[:1] = 1
    return np.multiply.accumulate(values)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of some texts as (text, shingle), sorted by both.

    Fewer words than a shingle are one shingle, no words none.
    """
    words = [text.lower().split() for text in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = word_hashes(words)
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * _powers(_BASE, n))])
    undo = _powers(_INVERSE, n)
    document = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(n)
    last = ends[document]
    whole = start + SHINGLE <= last
    short = (sizes[document] < SHINGLE) & (start == last - sizes[document])
    start = start[whole | short]
    document = document[start]
    end = np.minimum(start + SHINGLE, ends[document])
    value = mixed((prefix[end] - prefix[start]) * undo[start] + (end - start).astype(np.uint64))
    cuts = np.cumsum(np.bincount(document, minlength=len(sizes))).tolist()
    for begin, stop in zip([0, *cuts], cuts, strict=False):
        value[begin:stop].sort()
    new = np.ones(len(value), bool)
    new[1:] = (document[1:] != document[:-1]) | (value[1:] != value[:-1])
    return document[new], value[new]


def needed(a, b):
    """Shingles that sets of sizes a and b must have in common to be similar."""
    return -(-THRESHOLD * (a + b) // (100 + THRESHOLD))


def prefix_size(n):
    """Shingles in the prefix of a set of n: all but those a partner of any size can do without."""
    return n - -(-THRESHOLD * n // 100) + 1


def placed(document: np.ndarray, value: np.ndarray, seed: int, level: np.ndarray) -> tuple[np.ndarray, ...]:
    """Shingles in order of document, level and a hash: their positions, and their places in the set.

    `document` is sorted; `level` says how frequent a shingle is, from 0 on.
    """
    order = np.lexsort((mixed(value, seed), level, document))
    heads = np.flatnonzero(np.diff(document, prepend=-1))
    sizes = np.diff(np.append(heads, len(document)))
    return order, np.arange(len(document)) - np.repeat(heads, sizes)


def classes(document: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each of n sets, and a number that equal sets have in common (0 if empty)."""
    size = np.bincount(document, minlength=n)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if len(document):
        heads = np.flatnonzero(np.diff(document, prepend=-1))
        one[document[heads]] = np.add.reduceat(value, heads)
        two[document[heads]] = np.add.reduceat(mixed(value, 1), heads)
    name = mixed(one + mixed(two + size.astype(np.uint64), 2), 3)
    return size, np.where(size > 0, name, np.uint64(0)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets pass the filters of the further orders and the exact test.

    Under any order, what two similar sets have in common begins before the last
    `needed` shingles of either.
    """
    most, least = max(len(a), len(b)), min(len(a), len(b))
    if 100 * least < THRESHOLD * most:
        return False
    wanted = needed(len(a), len(b))
    for seed in ORDERS[1:]:
        own = [s[np.argsort(mixed(s, seed))[: len(s) - wanted + 1]] for s in (a, b)]
        if not np.isin(own[0], own[1]).any():
            return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= wanted


def cells_of(value: np.ndarray) -> np.ndarray:
    return value >> np.uint64(64 - CELL_BITS)


def _range_bits(partitions: int) -> int:
    """Bits of a cell that name its range: about as many ranges as a shuffle has partitions."""
    return min(max(partitions, 16), MOST_RANGES).bit_length() - 1


def packed_cells(cells: np.ndarray) -> bytes:
    """Sorted cells as differences, their bytes by significance, compressed."""
    steps = np.diff(cells, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(steps[:, : CELL_BITS // 8].T.tobytes())


def unpacked_cells(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    steps = np.zeros((len(planes) // (CELL_BITS // 8), 8), np.uint8)
    steps[:, : CELL_BITS // 8] = planes.reshape(CELL_BITS // 8, -1).T
    return np.cumsum(steps.view("<u8").reshape(-1))


_COLUMNS = "block bigint, key struct<a:bigint,b:bigint>, id {}, class bigint, n bigint, packed binary"
_NAMES = ["block", "key", "id", "class", "n", "packed", "range", "cells", "counts"]


def _blocks(source: DataFrame, range_bits: int) -> DataFrame:
    """Rows of documents (`packed` is set), and rows of cells (`cells` is set), by block.

    A block is a run of rows of one partition with about `BLOCK_SHINGLES` shingles. A
    document row has its class (null without shingles), the size of its set and its text; a
    row of cells holds a range of them with the number of the block's classes in each.
    """

    most = BLOCK_SHINGLES

    def rows(batches):
        part, block = TaskContext.get().partitionId(), 0
        kinds: list = []
        seen: set[int] = set()
        held: list[np.ndarray] = []

        def name():
            return part << 32 | block

        def listed():
            nonlocal block, held, seen
            cells, counts = np.unique(cells_of(np.concatenate(held)), return_counts=True)
            heads = cells >> np.uint64(CELL_BITS - range_bits)
            cuts = np.flatnonzero(np.diff(heads, prepend=~heads[:1]))
            pack = zstandard.ZstdCompressor(level=1).compress
            spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(cells)], strict=True))
            size = len(spans)
            nothing = pa.nulls(size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, name(), np.int64)),
                    *[nothing.cast(kind) for kind in kinds],
                    nothing.cast(pa.int64()),
                    nothing.cast(pa.int64()),
                    nothing.cast(pa.binary()),
                    pa.array(heads[cuts].astype(np.int64)),
                    pa.array([packed_cells(cells[a:b]) for a, b in spans], pa.binary()),
                    pa.array([pack(np.minimum(counts[a:b], 255).astype(np.uint8).tobytes()) for a, b in spans]),
                ],
                names=_NAMES,
            )
            block, held, seen = block + 1, [], set()

        for batch in batches:
            kinds = [batch.schema.field(0).type, batch.schema.field(1).type]
            texts = utf8(batch.column(2))
            document, value = shingle_sets(texts)
            size, named = classes(document, value, len(texts))
            pack = zstandard.ZstdCompressor(level=1).compress
            nothing = pa.nulls(len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(texts), name(), np.int64)),
                    batch.column(0),
                    batch.column(1),
                    pa.array(named, mask=size == 0),
                    pa.array(size),
                    pa.array([pack(text) for text in texts], pa.binary()),
                    nothing.cast(pa.int64()),
                    nothing.cast(pa.binary()),
                    nothing.cast(pa.binary()),
                ],
                names=_NAMES,
            )
            fresh = np.array([c not in seen for c in named.tolist()], bool)
            fresh[fresh] = _firsts(named[fresh])
            seen.update(named.tolist())
            held.append(value[fresh[document]])
            if sum(map(len, held)) >= most:
                yield from listed()
        if any(map(len, held)):
            yield from listed()

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(rows, _COLUMNS.format(kind) + ", range bigint, cells binary, counts binary")


def _firsts(values: np.ndarray) -> np.ndarray:
    """Which values are the first of their kind."""
    mask = np.zeros(len(values), bool)
    mask[np.unique(values, return_index=True)[1]] = True
    return mask


def levels_of(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each cell, the binary logarithm of the sum of the counts of all that are equal to it.

    Cells are leading bits of hashes, so parts of equal width hold about as many.
    """
    level = np.empty(len(cells), np.uint8)
    low, parts = cells.min(), min(len(cells) // AT_ONCE + 1, MOST_PARTS)
    width = (cells.max() - low) // np.uint64(parts) + np.uint64(1)
    for _ in range(parts):
        at = np.flatnonzero((cells >= low) & (cells < low + width))
        _, same = np.unique(cells[at], return_inverse=True)
        level[at] = np.log2(np.bincount(same, counts[at])).astype(np.uint8)[same]
        low += width
    return level


def _levels(lists: DataFrame) -> DataFrame:
    """(block, range, levels): the binary logarithm of how many classes are in each listed cell.

    All cells of a range are held once, as numbers; they are counted part by part.
    """

    def found(table):
        unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        counts = [unpack(x) for x in table.column("counts").to_pylist()]
        ends = np.cumsum([len(x) for x in counts])
        cells = np.empty(ends[-1], np.uint64)
        for end, own, packed in zip(ends.tolist(), counts, table.column("cells"), strict=True):
            cells[end - len(own) : end] = unpacked_cells(packed.as_py())
        level = levels_of(cells, np.frombuffer(b"".join(counts), np.uint8))
        parts = [pack(x.tobytes()) for x in np.split(level, ends[:-1])]
        return pa.Table.from_arrays(
            [table.column("block"), table.column("range"), pa.array(parts, pa.binary())],
            names=["block", "range", "levels"],
        )

    return lists.groupBy("range").applyInArrow(found, "block bigint, range bigint, levels binary")


def _candidates(documents: DataFrame, levels: DataFrame) -> DataFrame:
    """Of classes that can have a partner: rows (shingle, class, n, place) of the prefix, and texts.

    Only shingles that occur elsewhere are listed, with their place in the order. A class
    comes once per block.
    """

    def found(key, documents, levels):
        unpack = zstandard.ZstdDecompressor().decompress
        named = documents.column("class").to_numpy()
        first = _firsts(named)
        documents, named = documents.filter(pa.array(first)), named[first]
        document, value = shingle_sets(unpacked(documents.column("packed")))
        cells = cells_of(value)
        order = np.argsort(levels.column("range").to_numpy())
        packed = levels.column("levels").to_pylist()
        listed = np.frombuffer(b"".join([unpack(packed[i]) for i in order.tolist()]), np.uint8)
        level = listed[np.unique(cells, return_inverse=True)[1]]
        size = np.bincount(document, minlength=len(named))
        shared = np.bincount(document, level > 0, minlength=len(named)).astype(np.int64)
        partner = 100 * shared >= THRESHOLD * size
        # Shingles that occur nowhere else come first, so only the others are put in order.
        meets = partner[document] & (level > 0)
        document, value = document[meets], value[meets]
        order, place = placed(document, value, ORDERS[0], level[meets])
        place += (size - shared)[document]
        chosen = place < prefix_size(size[document])
        whose, place, value = document[chosen], place[chosen], value[order[chosen]]
        at = np.flatnonzero(partner)
        texts = documents.column("packed").combine_chunks().take(pa.array(at))
        return pa.Table.from_arrays(
            [
                pa.concat_arrays([pa.array(value.view(np.int64)), pa.nulls(len(at), pa.int64())]),
                pa.array(np.concatenate([named[whose], named[at]])),
                pa.array(np.concatenate([size[whose], size[at]])),
                pa.concat_arrays([pa.array(place), pa.nulls(len(at), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(value), pa.binary()), texts.cast(pa.binary())]),
            ],
            names=["shingle", "class", "n", "place", "packed"],
        )

    both = documents.groupBy("block").cogroup(levels.groupBy("block"))
    return both.applyInArrow(found, "shingle bigint, class bigint, n bigint, place bigint, packed binary")


def _by_shingle(rows: DataFrame, found, schema: str) -> DataFrame:
    """Call `found` with the columns of each run of whole shingles of a partition.

    Rows come sorted by shingle, size and class; a shingle is never cut between calls.
    """

    def stream(batches):
        kept = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = pa.concat_tables([kept, part]) if kept is not None else part
            shingle = part.column(0).to_numpy()
            whole = np.flatnonzero(shingle != shingle[-1])
            cut = whole[-1] + 1 if len(whole) else 0
            kept = part.slice(cut)
            if cut:
                yield from found(*(c.to_numpy() for c in part.slice(0, cut).columns))
            elif kept.num_rows > 4 * batch.num_rows:
                kept = kept.combine_chunks()
        if kept is not None and kept.num_rows:
            yield from found(*(c.to_numpy() for c in kept.columns))

    dealt = rows.repartition("shingle").sortWithinPartitions("shingle", "n", "class")
    return dealt.mapInArrow(stream, schema)


def _close(n, place, m, other):
    """Whether sets of n and m shingles with one at these places can be similar by it."""
    wanted = needed(n, m)
    return (place <= n - wanted) & (other <= m - wanted)


def _drawn(shingle, name, seed: int) -> np.ndarray:
    """A hash of the class, one of `HUBS` by shingle, so that a family's shingles draw alike."""
    salt = shingle.view(np.uint64) % np.uint64(HUBS) * np.uint64(_BASE)
    return mixed(name.view(np.uint64) + salt, seed)


def _groups(shingle) -> tuple[np.ndarray, np.ndarray]:
    """First rows of the shingles, and the number of each row's shingle."""
    heads = np.flatnonzero(np.diff(shingle, prepend=~shingle[:1]))
    return heads, np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(shingle))))


def _shared(shingle, name, n, place):
    """Shingles of two classes or more, each row with another it is first compared with.

    That is the shingle's hub, or where the two cannot be similar by this shingle, an earlier
    row that can.
    """
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (name[1:] != name[:-1])
    shingle, name, n, place = shingle[new], name[new], n[new], place[new]
    alone = np.ones(len(shingle), bool)
    alone[1:] &= shingle[1:] != shingle[:-1]
    alone[:-1] &= shingle[1:] != shingle[:-1]
    shingle, name, n, place = shingle[~alone], name[~alone], n[~alone], place[~alone]
    heads, group = _groups(shingle)
    chosen = np.lexsort((_drawn(shingle, name, 1), group))[heads][group] if len(heads) else group
    far = np.flatnonzero(~_close(n[chosen], place[chosen], n, place))
    own = None
    for i, s, m, p in zip(far.tolist(), *(x[far].tolist() for x in (shingle, n, place)), strict=True):
        if own is None or s != own[1] or not _close(own[2], own[3], m, p):
            own = (i, s, m, p)
        chosen[i] = own[0]
    columns = [shingle, name, n, place, name[chosen] if len(name) else name]
    names = ["shingle", "class", "n", "place", "chosen"]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _apart_and_near(seed: int):
    """Of the pairs that `_apart` gives, those whose classes are drawn one soon after the other."""

    def found(shingle, name, n, place, root):
        group = _groups(shingle)[1]
        order = np.lexsort((_drawn(shingle, name, seed), group))
        group, name, n, place, root = (x[order] for x in (group, name, n, place, root))
        for step in range(1, NEIGHBOURS + 1):
            meets = (group[step:] == group[:-step]) & (root[step:] != root[:-step])
            meets &= _close(n[:-step], place[:-step], n[step:], place[step:])
            a, b = name[:-step][meets], name[step:][meets]
            pair = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
            yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])

    return found


def _apart(shingle, name, n, place, root):
    """Pairs that can be similar by a shingle and are in different components."""
    heads = np.flatnonzero(np.diff(shingle, prepend=~shingle[:1]))
    for begin, end in zip(heads, np.append(heads[1:], len(shingle)), strict=True):
        if (root[begin:end] == root[begin]).all():
            continue
        for i in range(begin, end - 1):
            upto = begin + int(np.searchsorted(n[begin:end], 100 * n[i] // THRESHOLD, "right"))
            rest = slice(i + 1, upto)
            other = np.flatnonzero(_close(n[i], place[i], n[rest], place[rest]) & (root[rest] != root[i])) + i + 1
            if len(other):
                a, b = np.minimum(name[i], name[other]), np.maximum(name[i], name[other])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar; each side is joined by class."""

    def rows(batches):
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def shingles(name, packed):
            if name not in known:
                known[name] = shingle_sets(unpacked(pa.array([packed])))[1]
                if len(known) > 500:
                    known.popitem(last=False)
            return known[name]

        for batch in batches:
            a, b, first, second = (c.to_pylist() for c in batch.columns)
            linked = [
                (x, y)
                for x, y, p, q in zip(a, b, first, second, strict=True)
                if similar(shingles(x, p), shingles(y, q))
            ]
            left, right = zip(*linked, strict=True) if linked else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    first = texts.select(F.col("class").alias("a"), F.col("packed").alias("first"))
    second = texts.select(F.col("class").alias("b"), F.col("packed").alias("second"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "first", "second")
    return staged(both.mapInArrow(rows, "a bigint, b bigint"))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(key, component_root, id, n_shingles, component_id) of every document.

    Words lie between ASCII white space, with A-Z in lower case. A null or empty text has no
    shingles and is its own component; ids may be null or repeated, and a component's id is
    its smallest one. Different components can have the same id; only the root, null without
    shingles, tells them apart. Equal texts are linked. An empty table gives no rows.

    Documents are written once, in blocks; after that only lists of cells, one per block and
    range, and the texts of classes that can have a partner cross an exchange. A shingle's
    sets meet in one task as numbers, one per class and block. Nothing but two tests for
    emptiness comes to the driver.
    """
    source = df.select(
        text_key(id_column, text_column).alias("key"),
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
    )
    spark = df.sparkSession
    blocks = staged(_blocks(source, _range_bits(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    documents = blocks.filter("packed is not null").select("block", "key", "id", "class", "n", "packed")
    levels = _levels(blocks.filter("cells is not null").select("block", "range", "cells", "counts"))
    candidates = staged(_candidates(documents.filter("class is not null"), levels))
    texts = candidates.filter("packed is not null").dropDuplicates(["class"]).select("class", "packed")
    schema = "shingle bigint, class bigint, n bigint, place bigint, chosen bigint"
    listed = candidates.filter("shingle is not null").select("shingle", "class", "n", "place")
    shared = staged(_by_shingle(listed, _shared, schema))

    pair = [F.least("class", "chosen").alias("a"), F.greatest("class", "chosen").alias("b")]
    tried = staged(shared.filter("class <> chosen").select(*pair).distinct())
    links = _verified(tried, texts)
    for found in (*map(_apart_and_near, (2, 3, 4)), _apart):
        roots = linked_components(links).select(F.col("node").alias("class"), F.col("component").alias("root"))
        apart = shared.join(roots, "class", "left").select(
            "shingle", "class", "n", "place", F.coalesce("root", "class").alias("root")
        )
        pairs = _by_shingle(apart, found, "a bigint, b bigint").distinct()
        pairs = staged(pairs.join(tried, ["a", "b"], "left_anti"))
        more = _verified(pairs, texts)
        tried, links = tried.unionByName(pairs), links.unionByName(more)
    if not more.isEmpty():
        joined = linked_components(links)
        roots = joined.select(F.col("node").alias("class"), F.col("component").alias("root"))

    documents = documents.drop("block", "packed")
    grouped = documents.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    # Grouped as a struct, the roots get an exchange of their own for the join, which can then
    # split a hot one.
    smallest = grouped.groupBy(F.struct("root").alias("of")).agg(F.min("id").alias("component_id"))
    smallest = smallest.select("of.root", "component_id").filter("root is not null")
    return grouped.join(smallest, "root", "left").select(
        "key",
        F.col("root").alias("component_root"),
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def join_report(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id)."""
    return near_duplicates(df, id_column, text_column).drop("key", "component_root")


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, one with its id; rows without words all stay.

    Rows without words are told by their text alone and go past the join, so that a lost
    executor's task gives the same rows when it runs again.
    """
    worded = F.coalesce(F.col(text_column).rlike(WORD), F.lit(False))
    first = (
        near_duplicates(df, id_column, text_column)
        .filter(F.col("n_shingles") > 0)
        .groupBy("component_root")
        .agg(F.min(F.struct(F.col(id_column).isNull(), F.col(id_column), F.col("key"))).alias("first"))
        .select(F.col("first.key").alias("_kept"))
    )
    keyed = df.filter(worded).select(F.struct("*").alias("row"), text_key(id_column, text_column).alias("_key"))
    # Rows given twice have the same key.
    kept = keyed.join(first, F.col("_key") == F.col("_kept")).dropDuplicates(["_key"])
    return kept.select("row.*").select(*df.columns).unionByName(df.filter(~worded))
