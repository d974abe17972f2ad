"""Operators on pairs and repeats against brute force."""

import hashlib
import itertools
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from fixtures import PASSAGE, prose
from pyspark.sql import functions as F

from rosterline.llm import op3_pq, op6_substrings, op7_jaccard
from rosterline.llm.common import linked_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


class Union(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def link(self, a, b):
        self[self.root(a)] = self.root(b)


# --- Components


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(100 + i, 101 + i) for i in range(30)]
    union = Union()
    for a, b in edges:
        union.link(a, b)
    least = {}
    for x in {x for e in edges for x in e}:
        least[union.root(x)] = min(least.get(union.root(x), x), x)
    found = linked_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {x: least[union.root(x)] for x in {x for e in edges for x in e}}


def test_components_of_nothing(spark):
    assert linked_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- Substrings


def repeats_removed(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    times = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if times[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def test_removal_equals_brute_force(docs, no_docs):
    df, rows = docs
    expected = Counter((r[0], *x) for r, x in zip(rows, repeats_removed([r[1] for r in rows], 35), strict=True))
    assert Counter(tuple(r) for r in op6_substrings.removal_digest(df).collect()) == expected
    assert op6_substrings.removal_digest(no_docs).count() == 0


@pytest.mark.parametrize("many", [0, 4000])
def test_small_windows_and_crowded_anchors(spark, monkeypatch, many):
    """With few letters all anchors are hot; at `many` 0 every one is split into windows."""
    monkeypatch.setattr(op6_substrings, "MANY_CONTEXTS", many)
    monkeypatch.setattr(op6_substrings, "SHARD_WORDS", 50)
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(list("ab"), rng.integers(0, 60))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = op6_substrings.remove_repeats(df, length=13).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)
    )
    expected = Counter((i, *x) for i, x in enumerate(repeats_removed(texts, 13)))
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_hot_passage_in_many_documents(spark):
    texts = [f"{prose(i, 40)} {PASSAGE} {prose(1000 + i, 40)}" for i in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = op6_substrings.removal_digest(df).collect()
    assert Counter(tuple(r) for r in found) == Counter((i, *x) for i, x in enumerate(repeats_removed(texts, 35)))
    assert all(r.n_removed >= 60 for r in found)


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    passages = [rng.integers(0, 3, rng.integers(1, 15)).tolist() for _ in range(6)]
    weights = rng.integers(1, 4, 6).tolist()
    automaton = op6_substrings.SuffixAutomaton()
    for p, w in zip(passages, weights, strict=True):
        automaton.add(p, w)
    automaton.finish()

    def times(part):
        n = len(part)
        return sum(w * sum(p[i : i + n] == part for i in range(len(p) - n + 1)) for p, w in zip(passages, weights, strict=True))

    query = rng.integers(0, 3, 25).tolist()
    for end, (matched, count) in enumerate(automaton.matching_statistics(query, 5), 1):
        longest = max(n for n in range(min(5, end) + 1) if n == 0 or times(query[end - n : end]))
        assert matched == longest
        assert not matched or count == times(query[end - matched : end])


def test_texts_without_repeats_keep_their_layout(spark):
    rows = [(1, "a  b\n c", 5), (2, PASSAGE + "\n tail", 5), (3, PASSAGE, 5), (4, None, 5)]
    df = spark.createDataFrame(rows, "doc_id int, text string, carried int")
    found = {r.doc_id: r for r in op6_substrings.without_repeats(df).collect()}
    assert [found[i].text for i in (1, 2, 3, 4)] == ["a  b\n c", "tail", "", None]
    assert all(r.carried == 5 for r in found.values())


# --- Jaccard


def jaccard_components(rows):
    sets = []
    for _, text in rows:
        words = WORD.findall(lowered(text or ""))
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)][: len(words)]
        sets.append(set(grams))
    union = Union()
    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            union.link(i, j)
    least = {}
    for i, (name, _) in enumerate(rows):
        r = union.root(i)
        old = least.get(r)
        least[r] = name if old is None else old if name is None else min(old, name)
    return Counter((name, len(sets[i]), least[union.root(i)]) for i, (name, _) in enumerate(rows))


def test_join_equals_brute_force(docs, no_docs):
    df, rows = docs
    found = op7_jaccard.join_report(df).collect()
    assert Counter(tuple(r) for r in found) == jaccard_components([r[:2] for r in rows])
    assert op7_jaccard.join_report(no_docs).count() == 0


def near_copies(seed, n):
    """Families of texts with a few words changed, around the threshold, and a passage that many share."""
    rng = np.random.default_rng(seed)
    texts = []
    for family in range(n):
        base = prose(seed * 1000 + family, int(rng.integers(8, 90))).split()
        for _ in range(int(rng.integers(1, 9))):
            own = list(base)
            for at in rng.integers(0, len(own), int(rng.integers(0, 4))):
                own[at] = f"changed{rng.integers(0, 5)}"
            if family % 2:
                own += PASSAGE.split()[:30]
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("seed, block", [(1, 500), (2, 1_000_000), (3, 3000)])
def test_families_around_the_threshold(spark, monkeypatch, seed, block):
    monkeypatch.setattr(op7_jaccard, "BLOCK_SHINGLES", block)
    rows = list(enumerate(near_copies(seed, 40)))
    found = op7_jaccard.join_report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert Counter(tuple(r) for r in found.collect()) == jaccard_components(rows)


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 60, 2).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        linked = 100 * common >= 80 * (len(a) + len(b) - common)
        assert op7_jaccard.similar(a, b) == linked
        rare = [(s % np.uint64(7) > 3).astype(int) for s in (a, b)]
        wanted = op7_jaccard.needed(len(a), len(b))
        own = []
        for s, r in zip((a, b), rare, strict=True):
            order, place = op7_jaccard.placed(np.zeros(len(s), np.int64), s, 3, r)
            own.append(s[order[(place <= len(s) - wanted) & (place < op7_jaccard.prefix_size(len(s)))]])
        assert not linked or np.isin(*own).any()


def test_cells_survive_packing():
    rng = np.random.default_rng(0)
    cells = np.unique(op7_jaccard.cells_of(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)))
    assert (op7_jaccard.unpacked_cells(op7_jaccard.packed_cells(cells)) == cells).all()


class Grouped:
    """Stands for the lists of cells and gives back what is called with those of a range."""

    def groupBy(self, _):
        return self

    def applyInArrow(self, found, _):
        return found


@pytest.mark.parametrize("lists, size, spread", [(12, 100_000, 1 << 35), (40, 500, 900), (3, 1, 1)])
def test_levels_of_a_range_take_little_memory(lists, size, spread):
    rng = np.random.default_rng(lists)
    cells = [np.unique(rng.integers(0, spread, size, dtype=np.uint64)) for _ in range(lists)]
    cells = [np.unique(np.append(c, rng.choice(cells[0], size // 10))) for c in cells]
    counts = [rng.integers(1, 256, len(c)).astype(np.uint8) for c in cells]
    table = pa.table(
        {
            "block": pa.array(range(lists), pa.int64()),
            "range": pa.array([0] * lists, pa.int64()),
            "cells": [op7_jaccard.packed_cells(c) for c in cells],
            "counts": [zstandard.compress(c.tobytes()) for c in counts],
        }
    )
    tracemalloc.start()
    found = op7_jaccard._levels(Grouped())(table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    total = Counter()
    for c, times in zip(cells, counts, strict=True):
        for cell, n in zip(c.tolist(), times.tolist(), strict=True):
            total[cell] += n
    for c, packed in zip(cells, found.column("levels").to_pylist(), strict=True):
        level = np.frombuffer(zstandard.decompress(packed), np.uint8)
        assert level.tolist() == [total[cell].bit_length() - 1 for cell in c.tolist()]
    if size == 100_000:
        assert most < 4 * sum(c.nbytes for c in cells)


def test_one_row_of_each_group_stays(docs, no_docs):
    df, rows = docs
    kept = op7_jaccard.keep_one(df)
    assert kept.columns == df.columns
    names = [r.doc_id for r in kept.collect()]
    # Rows by place instead of id: an id may stand for texts of different components.
    groups = jaccard_components([(i, r[1]) for i, r in enumerate(rows)])
    empty = sum(c for (_, n, _), c in groups.items() if not n)
    assert len(names) == len({g for (_, n, g) in groups if n}) + empty
    assert op7_jaccard.keep_one(no_docs).count() == 0


def test_components_with_the_same_id_each_keep_a_row(spark):
    """Null ids without a partner, an id given to different texts, and rows without shingles."""
    texts = [prose(50 + i, 40) for i in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3])]
    rows += [(6, texts[3]), (5, texts[4]), (9, texts[5]), (None, texts[5])]
    rows += [(None, None), (None, None), (5, ""), (5, ""), (7, " \n")]
    kept = op7_jaccard.keep_one(spark.createDataFrame(rows, "doc_id int, text string").repartition(4))
    expected = [(None, texts[0]), (None, texts[1]), *((5, texts[i]) for i in (2, 3, 4)), (9, texts[5]), *rows[-5:]]
    assert Counter(tuple(r) for r in kept.collect()) == Counter(expected)


# --- Vectors


def vector_links(rows, threshold, dimension):
    good = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) == dimension and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and (x != 0).any():
                good[i] = x / np.linalg.norm(x)
    links, union = Counter(), Union()
    for i, j in itertools.combinations(good, 2):
        if good[i] @ good[j] >= threshold:
            links[i] += 1
            links[j] += 1
            union.link(i, j)
    least = {}
    for i, (name, _) in enumerate(rows):
        r = union.root(i)
        old = least.get(r)
        least[r] = name if old is None else old if name is None else min(old, name)
    return Counter((n, links[i], least[union.root(i)], n == least[union.root(i)]) for i, (n, _) in enumerate(rows))


def awkward_vectors(seed, n, dimension):
    rng = np.random.default_rng(seed)
    rows = []
    for family in range(n):
        centre = rng.normal(size=dimension)
        for _ in range(int(rng.integers(1, 12))):
            v = centre + rng.normal(size=dimension) * rng.choice([0, 0.1, 0.25, 0.4])
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.choice([0.01, 1, 50])]))
    zeros = [0.0] * dimension
    odd = [None, [], zeros, [None] + zeros[1:], [float("nan")] + zeros[1:], [float("inf")] + zeros[1:], [1.0, 2.0]]
    rows += [(10_000 + i, v) for i, v in enumerate(odd)]
    rows += [(None, rows[3][1]), (None, rows[3][1]), (5, rows[5][1]), rows[6]]
    return rows


@pytest.mark.parametrize("block", [7, 4096])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(op3_pq, "BLOCK", block)
    rows = awkward_vectors(1, 60, 16)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("node", F.lit(1))
    found = op3_pq.near_vectors(df).collect()
    assert Counter(tuple(r) for r in found) == vector_links(rows, 0.95, 16)


def test_vectors_of_every_length_link(spark):
    short, long = awkward_vectors(3, 8, 6), awkward_vectors(4, 12, 16)
    rows = [(n, v) for n, v in short[:-11]] + [(n + 1000, v) for n, v in long[:-11]] + [(5000, [2.0]), (5001, [1.0])]
    sizes = {len(v) for _, v in rows}
    expected = sum((vector_links([r for r in rows if len(r[1]) == n], 0.95, n) for n in sizes), Counter())
    found = op3_pq.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_no_vectors_and_no_good_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert op3_pq.near_vectors(none).count() == 0
    bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id bigint, embedding array<float>")
    assert {tuple(r) for r in op3_pq.near_vectors(bad).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}


def test_a_small_sample_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(op3_pq, "SAMPLE", 20)
    rows = awkward_vectors(2, 50, 12)
    found = op3_pq.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert Counter(tuple(r) for r in found.collect()) == vector_links(rows, 0.95, 12)


def test_probes_do_not_take_every_list():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, 16)) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = op3_pq.Index(x, len(x))
    assert np.mean([len(p) for p in index.probes(x, 0.316)]) < len(index.coarse) / 3


def families(rng, n, of, dimension, noise):
    centres = rng.normal(size=(n, dimension))
    x = np.repeat(centres, of, axis=0)
    return x + rng.normal(size=x.shape) * noise * np.linalg.norm(x, axis=1)[:, None] / np.sqrt(dimension)


def test_a_vector_is_sent_once_to_a_few_blocks(spark, monkeypatch):
    # Random directions are near almost every list; a vector was sent to each of them.
    x = np.random.default_rng(0).normal(size=(1500, 64))
    sent, links = [], op3_pq._links

    def counted(encoded, *rest):
        sent.append(encoded.select(F.sum(F.size("probes"))).first()[0])
        return links(encoded, *rest)

    monkeypatch.setattr(op3_pq, "_links", counted)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    assert op3_pq.near_vectors(df).filter("n_links = 0 and kept").count() == 1500
    assert sent == [1500]


@pytest.mark.parametrize("zeros", [0, 16])
def test_products_lose_no_pair(monkeypatch, zeros):
    monkeypatch.setattr(op3_pq, "TILE", (23, 9))
    monkeypatch.setattr(op3_pq, "BLOCK", 100)
    rng = np.random.default_rng(3)
    x = np.concatenate([families(rng, 120, 4, 16, 0.3), families(rng, 1, 150, 16, 0.2), rng.normal(size=(50, 16))])
    x = np.concatenate([np.zeros((len(x), zeros)), x], axis=1)
    x /= np.linalg.norm(x, axis=1)[:, None]
    radius = np.sqrt(0.1)
    index = op3_pq.Index(x[::3], len(x))
    own, codes, head, error = index.encode(x)
    assert len(np.unique(index.region)) > 1 and (np.diff(index.region) >= 0).all()
    columns = {"list": own, "codes": [c.tobytes() for c in codes], "head": head, "error": error}
    table = pa.table(columns | {"vector": [v.tobytes() for v in x], "row": np.arange(len(x))}).sort_by("list")
    found = set()
    place = table.column("row").to_numpy()
    for a, b, home in op3_pq._pairs(index, table, table, 0.95, radius, np.float64):
        part = set(zip(place[a].tolist(), place[b].tolist(), home.tolist(), strict=True))
        assert not found & part and all(h == (own[i] == own[j]) for i, j, h in part)
        found |= part
    pairs = {(i, j) for i, j, _ in found}
    assert all((j, i) in pairs for i, j, home in found if home)
    assert not any((j, i) in pairs for i, j, home in found if not home)
    near = np.argwhere(x @ x.T >= 0.95)
    assert {(min(p), max(p)) for p in pairs} == {(min(p), max(p)) for p in near.tolist()}
    regions = index.regions(x, own, radius)
    assert all(index.region[own[j]] in regions[i] for i, j in pairs)


def test_few_links_connect_what_all_do():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 400, (2, 600))
    union, forest = Union(), op3_pq.Forest(400)
    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        union.link(a, b)
    forest.add(x[:250], y[:250])
    forest.add(x[250:], y[250:])
    few = Union()
    links = np.concatenate(forest.links).tolist()
    for a, b in links:
        assert few.root(a) != few.root(b)
        few.link(a, b)
    one = {(union.root(i), few.root(i)) for i in range(400)}
    assert len(one) == len({a for a, _ in one}) == len({b for _, b in one}) == 400 - len(links)
    assert {tuple(p) for p in links} <= set(zip(x.tolist(), y.tolist(), strict=True))


def test_vectors_of_doubles_link(spark, monkeypatch):
    monkeypatch.setattr(op3_pq, "BLOCK", 30)
    x = families(np.random.default_rng(6), 40, 3, 10, 0.25) * 1e30  # a single number cannot hold 1e300
    x[::7] *= 1e270
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    with np.errstate(over="ignore"):
        scaled = [(i, (np.array(v) / np.abs(v).max()).tolist()) for i, v in rows]
    found = op3_pq.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert Counter(tuple(r) for r in found.collect()) == vector_links(scaled, 0.95, 10)
