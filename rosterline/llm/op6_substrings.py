"""Removal of repeated passages by matching statistics on suffix automata.

A window is `length` consecutive words. A word goes if a window that covers it starts
anywhere else as well, in the same document or another.

Every window names an anchor: the run of `GRAM` words inside it with the least hash, the
leftmost of equals. Windows with equal words name equal anchors, so only places whose
anchor occurs twice can repeat. Consecutive windows with one anchor form a context; each
window lies in exactly one. The distinct contexts around the anchors, with the number of
places each stands for, are the reference passages. They are dealt out by anchor into
shards of a bounded number of words; a suffix automaton is built of each shard, and its
contexts stream through it. A match as long as a window ends in a state that tells how
often those words occur.

Broadcasting each automaton to all documents would read the whole corpus once per shard,
so a shard's automaton stays in the task where the contexts of its anchors arrive.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import mixed, packed_texts, staged, text_key, unpacked, utf8, word_hashes

WINDOW = 35
GRAM = 10
# Anchors with more distinct contexts than this are judged window by window instead.
MANY_CONTEXTS = 4000
SHARD_WORDS = 100_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, np.uint64)
    values[:1] = 1
    return np.multiply.accumulate(values)


def contexts(words: list[list[bytes]], length: int = WINDOW) -> dict[str, np.ndarray]:
    """Per context of some documents: document, first word, words, anchor and content hash."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = word_hashes(words)
    gram = min(GRAM, length)
    inside = length - gram + 1
    n = len(flat)
    nothing = {x: np.zeros(0, np.int64) for x in ("document", "start", "words", "gram", "context")}
    if n < length:
        return nothing
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * _powers(_BASE, n))])
    undo = _powers(_INVERSE, n)
    grams = mixed((prefix[gram:] - prefix[:-gram]) * undo[: n - gram + 1])
    nearest = np.lib.stride_tricks.sliding_window_view(grams, inside)[: n - length + 1].argmin(axis=1)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    document = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(document[: n - length + 1] == document[length - 1 :])
    if not len(starts):
        return nothing
    anchor = starts + nearest[starts]
    cut = np.flatnonzero(np.diff(anchor) | (np.diff(starts) != 1)) + 1
    head = np.concatenate([np.zeros(1, np.int64), cut])
    tail = np.concatenate([cut, [len(starts)]]) - 1
    begin, end = starts[head], starts[tail] + length
    content = mixed((prefix[end] - prefix[begin]) * undo[begin], 1)
    return {
        "document": document[begin],
        "start": begin - first[begin],
        "words": end - begin,
        "gram": grams[anchor[head]].view(np.int64),
        "context": content.view(np.int64),
    }


class SuffixAutomaton:
    """All substrings of a set of weighted sequences of numbers, and how often each occurs."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _split(self, p: int, q: int, symbol: int) -> int:
        """The state of the strings that end at q by way of p: q itself, or a copy for them."""
        size = self.length[p] + 1
        if size == self.length[q]:
            return q
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(size)
        self.link.append(self.link[q])
        self.count.append(0)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, sequence, weight: int) -> None:
        following, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for symbol in sequence:
            q = following[last].get(symbol)
            if q is not None:
                last = q if length[last] + 1 == length[q] else self._split(last, q, symbol)
                count[last] += weight
                continue
            new = len(following)
            following.append({})
            length.append(length[last] + 1)
            link.append(0)
            count.append(weight)
            p = last
            while p >= 0:
                q = following[p].setdefault(symbol, new)
                if q != new:
                    link[new] = q if length[p] + 1 == length[q] else self._split(p, q, symbol)
                    break
                p = link[p]
            last = new

    def finish(self) -> None:
        """Pass the counts on to the shorter strings that end at the same places."""
        link, count = self.link, self.count
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if link[state] >= 0:
                count[link[state]] += count[state]

    def matching_statistics(self, sequence, most: int):
        """For each end: length of the longest match, up to `most`, and how often it occurs."""
        following, link, length, count = self.next, self.link, self.length, self.count
        state, matched = 0, 0
        for symbol in sequence:
            q = following[state].get(symbol)
            while q is None and state:
                state = link[state]
                matched = length[state]
                q = following[state].get(symbol)
            if q is not None:
                state = q
                matched = matched + 1 if matched < most else most
                while matched <= length[link[state]]:
                    state = link[state]
            yield matched, count[state]


def repeated_windows(passages: list[tuple[list[bytes], int]], length: int) -> list[int]:
    """Per passage a mask: bit i tells that the window from its word i occurs twice or more.

    The passages are (words, places they stand for) and hold fewer than 64 windows each.
    """
    number: dict[bytes, int] = {}
    coded = [[number.setdefault(w, len(number)) for w in words] for words, _ in passages]
    automaton = SuffixAutomaton()
    for sequence, (_, places) in zip(coded, passages, strict=True):
        automaton.add(sequence, places)
    automaton.finish()
    masks = []
    for sequence in coded:
        mask = 0
        for end, (matched, times) in enumerate(automaton.matching_statistics(sequence, length), 1):
            if matched == length and times > 1:
                mask |= 1 << (end - length)
        masks.append(mask)
    return masks


def _places(source: DataFrame, length: int) -> DataFrame:
    """One row per context: (key, start, words, gram, context)."""

    def rows(batches):
        for batch in batches:
            found = contexts([text.split() for text in utf8(batch.column(1))], length)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(found["document"])),
                    pa.array(found["start"]),
                    pa.array(found["words"]),
                    pa.array(found["gram"]),
                    pa.array(found["context"]),
                ],
                names=["key", "start", "words", "gram", "context"],
            )

    schema = "key struct<a:bigint,b:bigint>, start bigint, words bigint, gram bigint, context bigint"
    return source.mapInArrow(rows, schema)


def _fetched(passages: DataFrame, packed: DataFrame, length: int) -> DataFrame:
    """The words of each passage: (gram, context, part, places, text).

    A passage whose anchor has many contexts comes as its single windows, named by their
    own content; `part` is the window's number, or -1 for a whole passage.
    """

    def rows(batches):
        for batch in batches:
            out = []
            for wanted, text in zip(batch.column(0).to_pylist(), unpacked(batch.column(1)), strict=True):
                words = text.split()
                for p in wanted:
                    own = words[p["start"] : p["start"] + p["words"]]
                    if not p["split"]:
                        out.append((p["gram"], p["context"], -1, p["n"], b" ".join(own)))
                    else:
                        for i in range(len(own) - length + 1):
                            window = b" ".join(own[i : i + length])
                            out.append((p["gram"], p["context"], i, p["n"], window))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["gram", "context", "part", "n", "words"],
            )

    one = F.struct("gram", "context", "n", "split", F.col("at.start").alias("start"), "words")
    wanted = passages.groupBy(F.col("at.key").alias("key")).agg(F.collect_list(one).alias("wanted"))
    sides = wanted.join(packed.dropDuplicates(["key"]), "key").select("wanted", "packed")
    return sides.mapInArrow(rows, "gram bigint, context bigint, part bigint, n bigint, words binary")


def _judged(passages: DataFrame, length: int) -> DataFrame:
    """(gram, context, mask) of passages dealt out by anchor, a shard at a time."""

    most = SHARD_WORDS

    def rows(batches):
        held, size, last = [], 0, None

        def shard():
            masks = repeated_windows([(words, n) for _, _, n, words in held], length)
            kept = [(g, c, m) for (g, c, _, _), m in zip(held, masks, strict=True) if m]
            grams, found, masks = zip(*kept, strict=True) if kept else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (grams, found, masks)], names=["gram", "context", "mask"]
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for gram, context, n, text in zip(*columns, strict=True):
                if size >= most and gram != last:
                    yield shard()
                    held, size = [], 0
                words = text.split(b" ")
                held.append((gram, context, n, words))
                size, last = size + len(words), gram
        if held:
            yield shard()

    dealt = passages.select("gram", "context", "n", "words").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(rows, "gram bigint, context bigint, mask bigint")


def repeated_places(df: DataFrame, length: int, id_column: str, text_column: str, packed: DataFrame) -> DataFrame:
    """(key, spans) of documents with repeated windows; a span is (start, mask of windows)."""
    source = df.select(text_key(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    places = staged(_places(source, length))
    # Grouped as a struct, the anchors get an exchange of their own for the join, which can
    # then split a hot one.
    counts = places.groupBy(F.struct("gram").alias("anchor")).agg(F.count(F.lit(1)).alias("n"))
    places = staged(places.join(counts.filter("n > 1").select("anchor.gram"), "gram"))
    passages = places.groupBy("gram", "context", "words").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "start")).alias("at")
    )
    passages = staged(passages)
    crowded = passages.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > MANY_CONTEXTS)
    crowded = crowded.select("gram", F.lit(True).alias("split"))
    marked = passages.join(crowded, "gram", "left").withColumn("split", F.col("split").isNotNull())
    fetched = staged(_fetched(marked, packed, length))

    whole = _judged(fetched.filter("part < 0"), length)
    # A window that stands alone is its own anchor: copies meet by content before they are dealt out.
    parts = fetched.filter("part >= 0").withColumn("window", F.xxhash64("words", F.lit(1)))
    windows = parts.groupBy("window", "words").agg(F.sum("n").alias("n"))
    alone = windows.select(F.col("window").alias("gram"), F.lit(0).alias("context").cast("bigint"), "n", "words")
    hits = _judged(alone, length).select(F.col("gram").alias("window"))
    split = (
        parts.join(hits.distinct(), "window")
        .groupBy("gram", "context")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(part AS int))")).alias("mask"))
    )
    masks = staged(whole.unionByName(split))
    spans = places.join(masks, ["gram", "context"]).select("key", F.struct("start", "mask").alias("span"))
    return spans.groupBy("key").agg(F.collect_set("span").alias("spans"))


def covered(n: int, starts: np.ndarray, masks: np.ndarray, length: int) -> np.ndarray:
    """Which of n words the repeated windows cover; bit i of a mask is the window i after its start."""
    place, bit = np.nonzero((masks[:, None] >> np.arange(63)) & 1)
    at = starts[place] + bit
    edges = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def remove_repeats(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = WINDOW,
    carried: Column | None = None,
) -> DataFrame:
    """(id, n_words, n_removed, kept): the words left of every document, joined by a space.

    Words lie between ASCII white space and are compared as they are. A null or empty text
    has none; ids may be null or repeated, and a row given twice repeats itself. Windows
    are judged on the input. An empty table gives no rows. Hot passages are counted
    before they meet, and an anchor with many contexts is split into windows; only
    places and compressed texts cross an exchange. `length` is at most `GRAM` + 62.
    Another column may be carried in the id's place.
    """
    if not 0 < length <= GRAM + 62:
        raise ValueError("length is out of range")
    packed = packed_texts(df, id_column, text_column, carried)
    spans = repeated_places(df, length, id_column, text_column, packed)

    def rows(batches):
        for batch in batches:
            total, removed, left = [], [], []
            flat = batch.column(2).flatten()
            starts, masks = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("start", "mask"))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy())
            begin = 0
            for end, text in zip(ends.tolist(), unpacked(batch.column(1)), strict=True):
                words = text.split()
                total.append(len(words))
                if begin < end:
                    stays = ~covered(len(words), starts[begin:end], masks[begin:end], length)
                    words = list(compress(words, stays.tolist()))
                removed.append(total[-1] - len(words))
                left.append(b" ".join(words))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(left, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n_words", "n_removed", "kept"],
            )

    kind = packed.schema["id"].dataType.simpleString()
    return (
        packed.join(spans, "key", "left")
        .select("id", "packed", "spans")
        .mapInArrow(rows, f"id {kind}, n_words bigint, n_removed bigint, kept string")
        .withColumnRenamed("id", id_column if carried is None else "carried")
    )


def without_repeats(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The input with repeated passages removed; texts without any stay as they are, layout included."""
    found = remove_repeats(df, id_column, text_column, carried=F.struct("*"))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("carried")[text_column])
    columns = [text.alias(c) if c == text_column else F.col("carried")[c].alias(c) for c in df.columns]
    return found.select(*columns)


def removal_digest(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256)."""
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return remove_repeats(df, id_column, text_column).select(id_column, "n_words", "n_removed", kept)
