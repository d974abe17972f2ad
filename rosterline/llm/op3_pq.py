"""Near-duplicate vectors by product quantisation.

Unit vectors are dealt out to coarse lists by their nearest centroid; what is left of
each is stored as one code per subspace. A query takes its distance to the codes of a
probed list, and what may be near enough is compared exactly. Lists lie in regions, and a
vector is sent to a region once for all the lists that it probes there; the distances of
many queries to a list's codes are one matrix product, at first over half of the subspaces.

All steps are safe. With `radius` the distance of two unit vectors at the threshold:
a vector nearest to centroid j lies on j's side of the plane between j and the query's
own centroid i, so j's list is probed unless the query is further than `radius` from that
plane. And a code is at most its stored error away from its vector, in half of the
subspaces as in all, so a vector is left out only if the distance exceeds `radius` by more
than that error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from rosterline.llm.common import linked_components, staged

THRESHOLD = 0.95
# The index is fitted on so many distinct vectors, those with the smallest hashes; every
# vector is indexed. A sample holds so many numbers at most.
SAMPLE, SAMPLE_NUMBERS = 20_000, 4_000_000
MOST_LISTS, CODES, SUBSPACE = 1024, 256, 4
# A region's vectors and queries meet in blocks of about so many; of many vectors a block holds
# one in so many, and so many numbers at most.
BLOCK, BLOCK_SHARE, BLOCK_NUMBERS = 16_384, 8, 3_000_000
# Nearest centroids are sought for so many rows at once, distances taken for so many queries and
# vectors of a list, exact ones for so many numbers; links wait until there are so many.
ROWS, TILE, EXACT_NUMBERS, WAITING = 512, (1024, 2048), 4_000_000, 200_000


def _block(total: int, size: int) -> int:
    return max(1, min(BLOCK_NUMBERS // size, max(BLOCK, total // BLOCK_SHARE)))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Nearest centroid of each row."""
    square, factor = (centroids**2).sum(1), (-2 * centroids).T
    label = np.empty(len(x), np.int64)
    for at in range(0, len(x), ROWS):
        distance = x[at : at + ROWS] @ factor
        distance += square
        label[at : at + ROWS] = distance.argmin(1)
    return label


def _k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of a sample; an empty cluster keeps its centroid."""
    centroids = x[np.random.default_rng(7).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        label = _nearest(x, centroids)
        order = np.argsort(label, kind="stable")
        heads = np.flatnonzero(np.diff(label[order], prepend=-1))
        sizes = np.diff(np.append(heads, len(x)))
        centroids[label[order][heads]] = np.add.reduceat(x[order], heads) / sizes[:, None]
    return centroids


class Index:
    """Coarse centroids and one codebook per subspace, fitted on a sample of unit vectors.

    Centroids are numbered by region, of which there are about as many as blocks.
    """

    def __init__(self, sample: np.ndarray, total: int):
        dimension = sample.shape[1]
        k = max(1, min(MOST_LISTS, len(sample), round(math.sqrt(total))))
        coarse = _k_means(sample.astype(np.float32), k).astype(np.float64)
        regions = min(k, -(-total // _block(total, dimension)))
        region = np.unique(_nearest(coarse, _k_means(coarse, regions)), return_inverse=True)[1]
        order = np.argsort(region, kind="stable")
        self.coarse, self.region = coarse[order], region[order]
        parts = np.array_split(np.arange(dimension), max(1, dimension // SUBSPACE))
        self.cuts = [(int(p[0]), int(p[-1]) + 1) for p in parts]
        self.head = self.cuts[(len(self.cuts) - 1) // 2][1]
        left = (sample - self.coarse[_nearest(sample, self.coarse)]).astype(np.float32)
        codes = min(CODES, len(sample))
        self.books = [_k_means(left[:, a:b], codes) for a, b in self.cuts]
        gap = (self.coarse**2).sum(1)
        apart = np.sqrt(np.maximum(gap[:, None] + gap - 2 * self.coarse @ self.coarse.T, 0))
        self.apart = apart

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each vector, in half of the subspaces and in all."""
        own = _nearest(unit, self.coarse)
        left = (unit - self.coarse[own]).astype(np.float32)
        codes = np.stack([_nearest(left[:, a:b], book) for (a, b), book in self._parts()], 1)
        off = (unit - self.decode(own, codes)) ** 2
        return own, codes.astype(np.uint8), np.sqrt(off[:, : self.head].sum(1)), np.sqrt(off.sum(1))

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that the codes of a list stand for."""
        return self.coarse[lists] + np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1)

    def asks(self, unit: np.ndarray, own: np.ndarray, lists: np.ndarray, radius: float) -> np.ndarray:
        """Whether each vector probes each of the lists: its own, and higher ones that can hold
        vectors within `radius`.

        Of two lists the lower one asks: a pair is found from one side only.
        """
        to = self.coarse[lists]
        home = self.coarse[own]
        excess = (to**2).sum(1) - 2 * unit @ to.T
        excess -= ((home**2).sum(1) - 2 * (unit * home).sum(1))[:, None]
        near = excess <= (2 * radius * self.apart[:, lists] + 1e-9)[own]
        near &= lists >= own[:, None]
        return near

    def probes(self, unit: np.ndarray, radius: float) -> list[np.ndarray]:
        """Per vector the lists that it probes."""
        own = _nearest(unit, self.coarse)
        return [np.flatnonzero(row) for row in self.asks(unit, own, np.arange(len(self.coarse)), radius)]

    def regions(self, unit: np.ndarray, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """Per vector the regions with lists that it probes."""
        near = self.asks(unit, own, np.arange(len(self.coarse)), radius)
        heads = np.flatnonzero(np.diff(self.region, prepend=-1))
        return [np.flatnonzero(row) for row in np.logical_or.reduceat(near, heads, axis=1)]

    def _parts(self):
        return zip(self.cuts, self.books, strict=True)


class Filter:
    """Queries against the codes of vectors: which of them can be within `radius`.

    A product with the columns appended here is half of what the limit exceeds the squared
    distance by. It is taken in single precision; the limits are wider by its rounding.
    """

    def __init__(self, queries: np.ndarray, decoded: np.ndarray, error: np.ndarray, radius: float):
        own, square = (queries**2).sum(1), (decoded**2).sum(1)
        limit = (radius + error + 1e-9) ** 2
        rounding = 1.2e-7 * (queries.shape[1] + 4) * (1 + square + limit)
        ones = np.ones(len(queries))
        half = np.full(len(decoded), -0.5)
        self.queries = np.column_stack([queries, own, ones]).astype(np.float32)
        self.stored = np.column_stack([decoded, half, (limit - square) / 2 + rounding]).astype(np.float32)

    def __call__(self, queries: np.ndarray, stored: slice) -> np.ndarray:
        return self.queries[queries] @ self.stored[stored].T >= 0


class Forest:
    """As few of the links between nodes 0 to n - 1 as connect what all of them connect."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[np.ndarray] = []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        root = self.root
        while True:
            p, q = root[x], root[y]
            apart = p != q
            if not apart.any():
                break
            x, y = x[apart], y[apart]
            low, high = np.minimum(p, q)[apart], np.maximum(p, q)[apart]
            # Of each tree that could join a lower one, one link does.
            high, at = np.unique(high, return_index=True)
            root[high] = low[at]
            self.links.append(np.column_stack([x[at], y[at]]))
            while (root != (further := root[root])).any():
                root = further
        self.root = root


def _read(df: DataFrame, id_column: str, vector_column: str, number: type) -> DataFrame:
    """(id, size, node, name, vector): `node` and `name` are null where a vector cannot link."""

    def rows(batches):
        for batch in batches:
            sizes, nodes, names, vectors = [], [], [], []
            for value in batch.column(1).to_pylist():
                raw = np.array(value if value is not None and None not in value else [], np.float64)
                with np.errstate(over="ignore"):
                    norm = float(np.sqrt((raw * raw).sum()))
                if not (len(raw) and np.isfinite(raw).all() and norm > 0):
                    sizes.append(None), nodes.append(None), names.append(None), vectors.append(None)
                    continue
                if not math.isfinite(norm) or norm < 1e-140:  # its square overflows or vanishes
                    raw = raw / np.abs(raw).max()
                data = (raw + 0.0).astype(number).tobytes()
                sizes.append(len(raw))
                nodes.append(xxhash.xxh3_64_intdigest(data) - (1 << 63))
                names.append(xxhash.xxh3_128_digest(data))
                vectors.append(data)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(vectors, pa.binary()),
                ],
                names=["id", "size", "node", "name", "vector"],
            )

    source = df.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(rows, f"id {kind}, size bigint, node bigint, name binary, vector binary")


def _number(df: DataFrame, vector_column: str) -> type:
    """What holds a vector's numbers without loss."""
    numbers = df.schema[vector_column].dataType
    single = isinstance(numbers, ArrayType) and isinstance(numbers.elementType, FloatType)
    return np.float32 if single else np.float64


def _units(column, number: type) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), number).reshape(len(column), -1).astype(np.float64)
    return raw / np.sqrt((raw * raw).sum(1))[:, None]


def _encoded(vectors: DataFrame, index: Index, radius: float, number: type) -> DataFrame:
    """(node, weight, vector, list, region, codes, head, error, probes) of every distinct vector.

    `head` and `error` are the code's error in half of the subspaces and in all; `probes` are regions.
    """

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(batch.column(2), number)
            own, codes, head, error = index.encode(unit)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(own, pa.int32()),
                    pa.array(index.region[own], pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(head),
                    pa.array(error),
                    pa.array([p.tolist() for p in index.regions(unit, own, radius)], pa.list_(pa.int32())),
                ],
                names=["node", "weight", "vector", "list", "region", "codes", "head", "error", "probes"],
            )

    schema = (
        "node bigint, weight bigint, vector binary, list int, region int, codes binary, head double, "
        "error double, probes array<int>"
    )
    return vectors.mapInArrow(rows, schema)


def _near(a: np.ndarray, b: np.ndarray, rows: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float):
    """Whether the cosine of a[rows[x]] and b[y] reaches the threshold, for pairs (x, y)."""
    near = np.empty(len(x), bool)
    left = np.arange(len(x))
    if len(x) * 16 > len(rows) * len(b):  # all products at once, and one by one only those at the threshold
        above = (a[rows] @ b.T)[x, y] - threshold
        near, left = above > 0, np.flatnonzero(np.abs(above) <= 1e-9)
    step = max(1, EXACT_NUMBERS // a.shape[1])
    for at in range(0, len(left), step):
        some = left[at : at + step]
        near[some] = np.einsum("ij,ij->i", a[rows[x[some]]], b[y[some]]) >= threshold
    return near


def _pairs(index: Index, data: pa.Table, queries: pa.Table, threshold: float, radius: float, number: type):
    """Row numbers (query, vector, whether in the query's own list) of the linked pairs, in parts.

    The vectors are sorted by list.
    """
    lists = data.column("list").to_numpy()
    codes = np.frombuffer(b"".join(data.column("codes").to_pylist()), np.uint8).reshape(len(lists), -1)
    decoded = index.decode(lists, codes)
    unit, asking = _units(data.column("vector"), number), _units(queries.column("vector"), number)
    own = queries.column("list").to_numpy()
    head = index.head
    half = Filter(asking[:, :head], decoded[:, :head], data.column("head").to_numpy(), radius)
    whole = Filter(asking, decoded, data.column("error").to_numpy(), radius)
    heads = np.flatnonzero(np.diff(lists, prepend=-1))
    probed = index.asks(asking, own, lists[heads], radius)
    high, wide = TILE
    for i, (start, end) in enumerate(zip(heads, np.append(heads[1:], len(lists)), strict=True)):
        askers = np.flatnonzero(probed[:, i])
        for at in range(0, len(askers), high):
            some = askers[at : at + high]
            for first in range(start, end, wide):
                stored = slice(first, min(first + wide, end))
                near = half(some, stored)
                many = np.count_nonzero(near)
                if not many:
                    continue
                if many * 50 > near.size:
                    near &= whole(some, stored)
                x, y = np.divmod(np.flatnonzero(near), near.shape[1])
                linked = _near(asking, unit[stored], some, x, y, threshold)
                x, y = some[x[linked]], y[linked] + first
                yield x, y, own[x] == lists[start]


def _links(
    encoded: DataFrame, index: Index, threshold: float, radius: float, number: type, block: int
) -> DataFrame:
    """Rows (node, other, found): links of a node as their weight, or a link of the two (found 0).

    A region's vectors and the queries that probe it are cut into blocks of bounded size, and
    each pair of blocks is a group of its own.
    """
    asked = encoded.select(F.explode("probes").alias("region"))
    asked = asked.groupBy("region").agg(F.count(F.lit(1)).alias("q"))
    stored = encoded.groupBy("region").agg(F.count(F.lit(1)).alias("d"))
    sizes = {r["region"]: (-(-r.d // block), -(-r.q // block)) for r in stored.join(asked, "region").collect()}
    blocks = F.create_map(*[F.lit(x) for k, (d, q) in sizes.items() for x in (k, F.array(F.lit(d), F.lit(q)))])
    spread = F.abs(F.xxhash64("node", F.lit(5)))
    kept = ["node", "weight", "vector", "list"]
    coded = ["codes", "head", "error"]
    data = encoded.withColumn("n", blocks[F.col("region")]).select(
        *kept,
        *coded,
        "region",
        F.lit(False).alias("asks"),
        (spread % F.col("n")[0]).cast("int").alias("d"),
        F.explode(F.sequence(F.lit(0), F.col("n")[1] - 1)).alias("q"),
    )
    queries = (
        encoded.withColumn("region", F.explode("probes"))
        .withColumn("n", blocks[F.col("region")])
        .filter("n is not null")  # a region without vectors
        .select(
            *kept,
            *[F.lit(None).cast(encoded.schema[c].dataType).alias(c) for c in coded],
            "region",
            F.lit(True).alias("asks"),
            F.explode(F.sequence(F.lit(0), F.col("n")[0] - 1)).alias("d"),
            (spread % F.col("n")[1]).cast("int").alias("q"),
        )
    )

    def search(table):
        asks = table.column("asks").to_numpy()
        data, queries = table.filter(pa.array(~asks)).sort_by("list"), table.filter(pa.array(asks))
        columns = [pa.array([], pa.int64())] * 3
        if data.num_rows and queries.num_rows:
            node, weight = data.column("node").to_numpy(), data.column("weight").to_numpy()
            asker, askers = queries.column("node").to_numpy(), queries.column("weight").to_numpy()
            names, place = np.unique(np.concatenate([asker, node]), return_inverse=True)
            asker, node = place[: len(asker)], place[len(asker) :]
            found = np.zeros(len(names), np.int64)
            forest = Forest(len(names))
            waiting, many = [], 0
            for x, y, home in _pairs(index, data, queries, threshold, radius, number):
                other = asker[x] != node[y]
                x, y, home = x[other], y[other], home[other]
                np.add.at(found, asker[x], weight[y])
                np.add.at(found, node[y[~home]], askers[x[~home]])  # in their own list both ask
                waiting.append((asker[x], node[y]))
                many += len(x)
                if many > WAITING:
                    forest.add(*map(np.concatenate, zip(*waiting, strict=True)))
                    waiting, many = [], 0
            if many:
                forest.add(*map(np.concatenate, zip(*waiting, strict=True)))
            some = np.flatnonzero(found)
            links = np.concatenate([np.empty((0, 2), np.int64), *forest.links])
            columns = [
                pa.array(names[np.concatenate([some, links[:, 0]])]),
                pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(names[links[:, 1]])]),
                pa.array(np.concatenate([found[some], np.zeros(len(links), np.int64)])),
            ]
        return pa.Table.from_arrays(columns, names=["node", "other", "found"])

    groups = data.unionByName(queries).groupBy("region", "d", "q")
    return groups.applyInArrow(search, "node bigint, other bigint, found bigint")


def near_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    dimension: int | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; links are at `threshold` cosine or more.

    A vector that is null, empty or zero, or that holds null or a number that is not finite,
    links with nothing. Vectors link with others of their length; each length has an index of
    its own, and lengths should be few. With `dimension`, only that length links. Equal
    vectors link; they are one vector with a weight from the start, so copies are never
    compared with each other. Ids may be null or repeated; a component's id is its smallest.
    An empty table gives no rows. The driver gets a row per length, and of each length the
    sample and a row per region.
    """
    number = _number(df, vector_column)
    rows = staged(_read(df, id_column, vector_column, number))
    if dimension is not None:
        rows = rows.withColumn("node", F.when(F.col("size") == dimension, F.col("node")))
    distinct = staged(
        rows.filter("node is not null")
        .groupBy("node", "name")
        .agg(F.count(F.lit(1)).alias("weight"), F.max("vector").alias("vector"), F.max("size").alias("size"))
        .select("node", "weight", "vector", "size")
    )
    totals = {r["size"]: r["total"] for r in distinct.groupBy("size").agg(F.count("node").alias("total")).collect()}
    radius = math.sqrt(2 - 2 * threshold)
    links = None
    for size, total in sorted(totals.items()):
        vectors = distinct.filter(F.col("size") == size).select("node", "weight", "vector")
        most = max(1, min(SAMPLE, SAMPLE_NUMBERS // size))
        sample = vectors.orderBy(F.xxhash64("node"), "node").limit(most).select("vector").toArrow()
        index = Index(_units(sample.column(0), number), total)
        encoded = staged(_encoded(vectors, index, radius, number))
        own = staged(_links(encoded, index, threshold, radius, number, _block(total, size)))
        links = own if links is None else links.unionByName(own)
    if links is not None:
        edges = links.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
        roots = linked_components(edges).withColumnRenamed("component", "root")
        counts = links.filter("other is null").groupBy("node").agg(F.sum("found").alias("links"))
        found = distinct.select("node", "weight").join(counts, "node", "left").join(roots, "node", "left")
    else:
        found = distinct.select("node", "weight", F.lit(0).alias("links"), F.col("node").alias("root"))
    found = found.select(
        "node",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("bigint").alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    placed = rows.select("id", "node").join(found, "node", "left")
    # Grouped as a struct, the roots get an exchange of their own for the join, which can then
    # split a hot one.
    smallest = placed.groupBy(F.struct("root").alias("of")).agg(F.min("id").alias("component_id"))
    smallest = smallest.select("of.root", "component_id").filter("root is not null")
    component = F.coalesce("component_id", "id")
    return placed.join(smallest, "root", "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
