"""Quality rules on how well a public vocabulary fits a text.

A text that the vocabulary was made for takes few tokens: many characters in each, few
bytes as a fallback, and neither a handful of tokens over and over nor noise. Characters
per token, byte-fallback share and token entropy have a band per language; a language
without one takes the band of its script.
"""

from __future__ import annotations

import math
from array import array
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import Memory, utf8

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"


class Band(NamedTuple):
    """What a text must keep to; outside it is rejected.

    Entropy, in bits per token, rises with the number of tokens and then levels off. It is
    held against the usual entropy of so many tokens, `a + b*x - c*x*x` with x the binary
    logarithm of their number, from the peak on at its maximum, and may lie so far below
    and above it. A natural vocabulary goes on growing past the peak: see `WIDER`.
    """

    chars_per_token: tuple[float, float]
    byte_share: float
    usual_entropy: tuple[float, float, float]
    below: float
    above: float


# Fixed values. Characters per token are lowest for text that the vocabulary hardly
# knows; junk such as a symbol after every word lacks entropy long before that.
BANDS = {
    "en": Band((1.7, 9.0), 0.05, (1.56, 0.867, 0.0345), 0.45, 2.5),
    "de": Band((1.75, 9.0), 0.05, (1.62, 0.845, 0.0345), 0.45, 2.5),
    "es": Band((1.6, 9.0), 0.05, (2.69, 0.628, 0.0233), 0.45, 2.5),
    "fr": Band((1.6, 9.0), 0.05, (2.37, 0.696, 0.0279), 0.45, 2.5),
    "Latin": Band((1.3, 10.0), 0.1, (1.6, 0.8, 0.0345), 0.9, 3.0),
    "Cyrillic": Band((1.2, 10.0), 0.1, (1.6, 0.8, 0.0345), 0.9, 3.0),
    "Greek": Band((0.8, 10.0), 0.2, (1.6, 0.8, 0.0345), 1.2, 3.0),
    "Han": Band((0.4, 6.0), 0.6, (1.6, 0.8, 0.0345), 1.5, 4.0),
    "other": Band((0.25, 12.0), 0.9, (1.6, 0.8, 0.0345), 2.5, 5.0),
}

# Past the peak of the usual entropy, bits that a text may lie further above it for every
# doubling of its tokens, and at most.
WIDER, WIDEST = 0.3, 1.5


@lru_cache(maxsize=2)
def _pieces(path: str):
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    fallback = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(len(model))])
    return model, fallback


# Words that a task remembers.
REMEMBERED = 600_000


def _word_ids(path: str, texts: list[list[bytes]], memory: Memory) -> dict[bytes, bytes]:
    """Ids of the words of some texts, each encoded as it is after a space."""

    def encoded(words):
        found = _pieces(path)[0].encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        return {w: array("H", ids).tobytes() for w, ids in zip(words, found, strict=True)}

    return memory.table(texts, encoded)


def fertility(path: str, words: list[bytes], word_chars: int, known=None) -> tuple[float, float, float]:
    """Characters per token, share of byte-fallback tokens, entropy in bits; zeros without words.

    `known` holds the ids of the words, if they have been looked up.
    """
    known = known or _word_ids(path, [words], Memory(REMEMBERED))
    ids = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u2")
    if not len(ids):
        return 0.0, 0.0, 0.0
    share = np.bincount(ids)
    share = share[share > 0] / len(ids)
    return (
        word_chars / len(ids),
        float(_pieces(path)[1][ids].mean()),
        float(-(share * np.log2(share)).sum()),
    )


def script_of(text: str) -> str:
    """Script of most letters above ASCII, or Latin where most are ASCII."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts = {
        "Latin": ((codes >= 65) & (codes <= 122) | (codes >= 0xC0) & (codes < 0x250)).sum(),
        "Greek": ((codes >= 0x370) & (codes < 0x400)).sum(),
        "Cyrillic": ((codes >= 0x400) & (codes < 0x530)).sum(),
        "Han": ((codes >= 0x3040) & (codes < 0xA000)).sum(),
        "other": ((codes >= 0x530) & (codes < 0x3040) | (codes >= 0xA000)).sum(),
    }
    return max(counts, key=counts.get)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(
        pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
    )
    often = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(often)] |= often
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[list[bytes], int, int, int, int]:
    """Words, code points in them, symbols, repeated lines and repeated words."""
    words = text.split()
    bare = np.frombuffer(text.translate(None, WHITE), np.uint8)
    chars = int(((bare & 0xC0) != 0x80).sum())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return words, chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def accepted(measured: tuple[float, float, float], word_chars: int, band: Band) -> bool:
    """Whether characters per token, byte share and entropy lie in the band."""
    chars, share, entropy = measured
    if not chars:
        return False
    low, high = band.chars_per_token
    x = math.log2(word_chars / chars)
    a, b, c = band.usual_entropy
    peak = b / (2 * c)
    level = min(x, peak)
    off = entropy - (a + b * level - c * level * level)
    above = band.above + min(WIDER * (x - level), WIDEST)
    return low <= chars <= high and share <= band.byte_share and -band.below <= off <= above


RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, chars_per_token double, byte_share double, token_entropy double,"
    " band string"
)


def quality(
    df: DataFrame,
    path: str,
    text_column: str = "text",
    language_column: str | None = "lang",
    bands: dict[str, Band] = BANDS,
) -> DataFrame:
    """The input's columns as struct `row`, and `quality`: what was measured, and `kept`.

    `path` is a sentencepiece model of at most 65,536 pieces. A null or empty text has
    no words, measures zero and fails the base rule; a null or unknown language takes
    the band of the text's script. Rows may repeat, columns may have any names. Nothing
    is exchanged; a text is read whole.
    """

    def rows(batches):
        memory = Memory(REMEMBERED)
        for batch in batches:
            out = []
            texts = utf8(batch.column(1))
            known = _word_ids(path, [raw.split() for raw in texts], memory)
            for raw, language in zip(texts, batch.column(2).to_pylist(), strict=True):
                words, chars, symbols, lines, repeated = base_counts(raw)
                failed = len(words) < MIN_WORDS or 100 * repeated > 50 * len(words)
                measured = fertility(path, words, chars, known)
                name = language if language in bands else script_of(raw.decode("utf-8", "replace"))
                kept = not failed and accepted(measured, chars, bands[name])
                out.append((len(words), chars, symbols, lines, repeated, failed, kept, *measured, name))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            found = pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["row", "quality"])

    names = [part.split()[0] for part in RESULT.split(", ")]
    arrow = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}
    kinds = [arrow[part.split()[1]] for part in RESULT.split(", ")]
    language = F.col(language_column) if language_column else F.lit(None)
    source = df.select(
        F.struct("*").alias("row"),
        F.col(text_column).alias("text"),
        language.cast("string").alias("language"),
    )
    measured = ",".join(":".join(part.split()) for part in RESULT.split(", "))
    schema = f"row {source.schema['row'].dataType.simpleString()}, quality struct<{measured}>"
    return source.mapInArrow(rows, schema)


def quality_report(df: DataFrame, path: str, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, n_words, ..., kept, ...): what `quality` measured, one row per document."""
    return quality(df, path, **options).select(F.col("row")[id_column].alias(id_column), "quality.*")


def keep_good(df: DataFrame, path: str, **options) -> DataFrame:
    """The rows that the rules keep, unchanged."""
    return quality(df, path, **options).filter("quality.kept").select("row.*")
