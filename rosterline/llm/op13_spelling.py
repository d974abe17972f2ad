"""Spelling variants: words one edit apart, found through words over a reduced alphabet.

Every letter is hashed to one of a few symbols. Two words one edit apart are then at most
one edit apart in symbols as well. So each word's reduced form is looked up together with
its whole one-edit neighbourhood among the reduced vocabulary, and what meets there is
verified on the original strings. Words that reduce alike share a neighbourhood. Reduced
words are 64-bit polynomial hashes, of which a neighbour's follows from a prefix and a
suffix: a word of L letters costs some 2 * L * symbols numbers, however long it is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import larger_batches, mixed, staged, utf8

# Symbols that letters are hashed to: more make fewer false candidates, fewer make smaller
# neighbourhoods. Words of this many letters have as many reduced words as there are words.
LEAST_SYMBOLS, USUAL = 4, 8
# Neighbours in one batch on their way out of a task.
BATCH_NEIGHBOURS = 200_000
# A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as C3 80 to C3 BF.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
# A run of a document to the word that counts in its place.
Change = Callable[[str | None, bytes], bytes]

_BASE = 0xD6E8FEB86659FD93


def runs_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, A-Z in lower case."""
    return RUN.findall(text.lower())


def slip(doc_id: str | None, run: bytes) -> bytes:
    """Drop one letter of about every 97th run, as told by a checksum of document and run."""
    seed = zlib.crc32(run, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if seed % 97:
        return run
    letters = run.decode()
    at = seed % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_letters: int = 5,
    least_count: int = 3,
    change: Change | None = None,
) -> DataFrame:
    """(word, n): how often each word of enough letters occurs in all texts, if often enough.

    Null and empty texts have no words, a row given twice counts twice. Each task counts
    the words of a few megabytes at a time, and the sums meet by word.
    """

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in larger_batches(batches):
            counts: Counter[bytes] = Counter()
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, utf8(batch.column(1)), strict=True):
                runs = runs_of(text)
                if change is None:
                    counts.update(runs)
                else:
                    for run, n in Counter(runs).items():
                        counts[change(doc_id, run)] += n
            kept = [(w, n) for w, n in counts.items() if len(w) >= least_letters]
            words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [words, pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
            )

    source = df.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    return (
        source.mapInArrow(rows, "word string, n bigint")
        .filter(F.length("word") >= least_letters)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least_count)
    )


def symbols_for(n_words: int) -> int:
    """The fewest symbols with as many reduced words of `USUAL` letters as there are words.

    The vocabulary thus decides how large neighbourhoods are; what they find is the same.
    """
    return max(LEAST_SYMBOLS, next(s for s in range(2, 1 << 16) if s**USUAL >= n_words))


def symbols_of(words: np.ndarray, symbols: int) -> np.ndarray:
    """Reduced words: for each code point of a matrix of letters a number from 1 to `symbols`."""
    return mixed(words.astype(np.uint64), 5) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    values = np.full(n, _BASE, np.uint64)
    values[:1] = 1
    return np.multiply.accumulate(values)


def _hashes(values: np.ndarray, length: int) -> np.ndarray:
    return mixed(values + np.asarray(length, np.uint64) * np.uint64(_BASE), 6).view(np.int64)


def reduced_hashes(codes: np.ndarray) -> np.ndarray:
    """The hash of each reduced word, the rows of a matrix."""
    n = codes.shape[1]
    return _hashes((codes * _powers(n)[::-1]).sum(axis=1), n)


def neighbourhoods(codes: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash): distinct hashes of each reduced word and of all reduced words one edit from it."""
    rows, n = codes.shape
    powers = _powers(n + 1)
    weight = powers[:n][::-1]  # of each place, the last one 1
    terms = codes * weight
    none = np.zeros((rows, 1), np.uint64)
    before = np.concatenate([none, np.cumsum(terms, axis=1)], axis=1)  # of the first i places
    total = before[:, -1:]
    after = total - before
    # What stands before a dropped place weighs one power less: it is summed by itself.
    shorter = np.concatenate([none, np.cumsum(codes[:, :-1] * weight[1:], axis=1)], axis=1)
    choice = np.arange(1, symbols + 1, dtype=np.uint64)
    dropped = shorter + after[:, 1:]
    replaced = (total - terms)[:, :, None] + choice * weight[:, None]
    inserted = (before * np.uint64(_BASE) + after)[:, :, None] + choice * powers[::-1][:, None]
    found = np.concatenate(
        [
            _hashes(dropped, n - 1),
            _hashes(replaced.reshape(rows, -1), n),
            _hashes(inserted.reshape(rows, -1), n + 1),
        ],
        axis=1,
    )
    found.sort(axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]


def letter_sets(words: np.ndarray) -> np.ndarray:
    """The letters of words as sets of 64 bits, of which one edit changes two at most."""
    bits = np.uint64(1) << (mixed(words.astype(np.uint64), 7) % np.uint64(64))
    return np.bitwise_or.reduce(bits, axis=1).view(np.int64)


def _by_length(words: list, letter: str, cells: int) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """(indexes, matrix): words of one length together, each letter a cell; few words where they are long."""
    width = np.dtype(letter).itemsize
    lengths = np.array([len(w) for w in words], np.int64) // width
    for n in np.unique(lengths[lengths > 0]).tolist():
        own = np.flatnonzero(lengths == n)
        step = max(1, cells // n)
        for i in range(0, len(own), step):
            part = own[i : i + step]
            yield part, np.frombuffer(b"".join(words[k] for k in part.tolist()), letter).reshape(-1, n)


_CODED = "word string, n bigint, code binary, hash bigint, letters bigint"


def _coded(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, code, hash, letters): words with their reduced words, a symbol in two bytes each."""

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            letters = [w.encode("utf-32-le") for w in batch.column(0).to_pylist()]
            size = len(letters)
            codes, hashes, sets = [b""] * size, np.zeros(size, np.int64), np.zeros(size, np.int64)
            for part, matrix in _by_length(letters, "<u4", BATCH_NEIGHBOURS):
                reduced = symbols_of(matrix, symbols)
                hashes[part], sets[part] = reduced_hashes(reduced), letter_sets(matrix)
                for k, row in zip(part.tolist(), reduced.astype("<u2"), strict=True):
                    codes[k] = row.tobytes()
            columns = [pa.array(codes, pa.binary()), pa.array(hashes), pa.array(sets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], names=["word", "n", "code", "hash", "letters"]
            )

    return words.select("word", "n").mapInArrow(rows, _CODED)


def _neighbours(classes: DataFrame, symbols: int) -> DataFrame:
    """(near, hash): the hashes of a reduced word's whole neighbourhood, and its own."""

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            own = batch.column(0).to_numpy()
            cells = max(1, BATCH_NEIGHBOURS // (2 * symbols + 1))
            for part, codes in _by_length(batch.column(1).to_pylist(), "<u2", cells):
                row, near = neighbourhoods(codes.astype(np.uint64), symbols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near), pa.array(own[part][row])], names=["near", "hash"]
                )

    return classes.select("hash", "code").mapInArrow(rows, "near bigint, hash bigint")


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of words exactly one edit apart.

    `words` has distinct words with their counts. Words of the same reduced word have one
    neighbourhood between them, of which rows hold two numbers.
    """
    coded = staged(_coded(words, symbols))
    asking = _neighbours(coded.select("hash", "code").distinct(), symbols)
    own = coded.select("hash", "word", "n", "letters")
    others = own.toDF("near", "other", "other_n", "other_letters")
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2
    return (
        asking.join(others, "near")
        .join(own, "hash")
        .filter(alike & (F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))
        .select("word", "n", "other", "other_n")
    )


def spelling_variants(words: DataFrame, symbols: int | None = None, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the commoner word that each may be a slip of.

    A word's form is its near word of largest count, the first in code-point order of equal
    ones, if that is at least `times` the word's own; `root` is where forms lead to. `symbols`
    follow from the number of words unless given, and change no result. No words give no rows. Counts at least double along a chain of forms, so chains are short,
    and every round of joins doubles what each word has followed.
    """
    if times < 2:
        raise ValueError("times must be at least 2")
    words = staged(words)
    best = (
        near_words(words, symbols or symbols_for(words.count()))
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
        )
    )
    form = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.other"))
    found = staged(
        words.join(best, "word", "left").select(
            "word",
            form.alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(form.isNotNull(), -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _followed(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _followed(steps: DataFrame) -> DataFrame:
    """(word, root) after following (word, root) to where no row leads on."""
    state = staged(steps)
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(onward, "root", "left")
        if moved.filter("next IS NOT NULL").isEmpty():
            return state
        state = staged(moved.select("word", F.coalesce("next", "root").alias("root")))


def variant_report(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", change: Change | None = None
) -> DataFrame:
    """`spelling_variants` of the words of a table of texts.

    Null and empty texts and an empty table add no words; ids may be null or repeated and
    matter to `change` alone; columns may have any names.
    """
    return spelling_variants(word_counts(df, id_column, text_column, change=change))
