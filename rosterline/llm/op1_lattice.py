"""Log probability of a text by a subword lattice.

The pieces of a public vocabulary, weighted by its scores, spell every token in all the
ways they can; a forward recursion in log space sums over all of them. A token met in
training is one more arc of its own lattice, as likely as its share of the training
tokens. Pieces never cross a token's end, so the sum over all segmentations of a
document is the product of the sums of its tokens.

    P(token) = s * c / N + (1 - s) * L(token),   s = N / (N + V)

c is the token's count, N all and V the distinct training tokens; L spells the token. The
end of a document is a token that L spells with probability `END_SHARE`. Summed over all
tokens P is at most one.

The vocabulary at hand is ordered by its scores (minus the rank of a piece), so a piece
of rank r weighs as 1 / (r + 1), by Zipf's law.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import staged, utf8

SPACE = "▁"
END_SHARE = 1e-3
BLOCK_TOKENS = 2_000_000
BLOCK_BYTES = 32 << 20
END_TOKEN = b""


class Lattice:
    """Piece weights of a sentencepiece model, and the forward recursion over a token."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        first, other, self.byte = {}, {}, {}
        for i in range(len(model)):
            piece, score = model.id_to_piece(i), model.get_score(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = -math.log(len(model))
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and score > -1e8:
                (first if piece[0] == SPACE else other)[piece] = -math.log(1 - score)
        first.setdefault(SPACE, -math.log(len(model)))  # some models do not score it
        self.longest = max(map(len, [*first, *other]))
        # A piece that starts a token is drawn from those with a space in front, each later
        # one from the rest, the byte pieces and the stop; both sum to one. The stop takes
        # as much as all pieces that start a token would.
        starts = sum(map(math.exp, first.values()))
        rest = sum(math.exp(x) for d in (other, self.byte) for x in d.values()) + starts
        self.stop = math.log(starts / rest)
        self.first = {p: w - math.log(starts) for p, w in first.items()}
        self.other = {p: w - math.log(rest) for p, w in other.items()}
        self.byte = {b: w - math.log(rest) for b, w in self.byte.items()}
        self.letters = {p for p in self.other if len(p) == 1}

    def log_probability(self, token: str) -> float:
        """Natural logarithm of the sum over all segmentations of a space and the token.

        A character that no single piece spells can be spelled by its bytes.
        """
        text, first, other = SPACE + token, self.first, self.other
        alpha = [-math.inf] * (len(text) + 1)
        for end in range(1, min(self.longest, len(text)) + 1):
            alpha[end] = first.get(text[:end], -math.inf)
        for start in range(1, len(text)):
            at = alpha[start]
            if at == -math.inf:
                continue
            for end in range(start + 1, min(start + self.longest, len(text)) + 1):
                weight = other.get(text[start:end])
                if weight is not None:
                    alpha[end] = _log_sum(alpha[end], at + weight)
            if text[start] not in self.letters:
                spelled = sum(self.byte[b] for b in text[start].encode("utf-8", "replace"))
                alpha[start + 1] = _log_sum(alpha[start + 1], at + spelled)
        return alpha[-1] + self.stop


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def tokens_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case, then the end. (`bytes.lower` leaves other letters alone.)"""
    return [*text.lower().split(), END_TOKEN]


def _blocks(source: DataFrame) -> DataFrame:
    """Tokens as numbers into a list per block: rows of documents, and rows of types.

    A block is a run of rows of one partition with about `BLOCK_TOKENS` tokens. A document
    row holds its numbers, a type row the token, its number and its count in training.
    """

    most_tokens = BLOCK_TOKENS

    def rows(batches):
        part, block = TaskContext.get().partitionId(), 0
        numbers: dict[bytes, int] = {}
        counts = np.zeros(0, np.int64)
        tokens_in, bytes_in = 0, 0

        def types():
            nonlocal numbers, counts, block, tokens_in, bytes_in
            n, name = len(numbers), part << 32 | block
            listed = list(numbers)
            for at in range(0, n, 50_000):
                words = listed[at : at + 50_000]
                size = len(words)
                nothing = pa.nulls(size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, name, np.int64)),
                        nothing.cast(kind),
                        nothing.cast(pa.bool_()),
                        nothing.cast(pa.int64()),
                        nothing.cast(pa.binary()),
                        pa.array(words, pa.binary()),
                        pa.array(np.arange(at, at + size, dtype=np.int32)),
                        pa.array(counts[at : at + size]),
                    ],
                    names=NAMES,
                )
            numbers, counts, tokens_in, bytes_in, block = {}, np.zeros(0, np.int64), 0, 0, block + 1

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            held, out, ids_out, at_rows = batch.column(2).to_pylist(), [], [], []
            texts = utf8(batch.column(1))

            def documents():
                size = len(at_rows)
                taken = batch.column(0).take(pa.array(at_rows, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, part << 32 | block, np.int64)),
                        taken,
                        pa.array([held[i] for i in at_rows], pa.bool_()),
                        pa.array(out, pa.int64()),
                        pa.array(ids_out, pa.binary()),
                        pa.nulls(size).cast(pa.binary()),
                        pa.nulls(size).cast(pa.int32()),
                        pa.nulls(size).cast(pa.int64()),
                    ],
                    names=NAMES,
                )

            for at, text in enumerate(texts):
                tokens = tokens_of(text)
                for token in set(tokens):
                    if token not in numbers:
                        numbers[token] = len(numbers)
                        bytes_in += len(token)
                ids = np.fromiter(map(numbers.__getitem__, tokens), np.uint32, len(tokens))
                if len(counts) < len(numbers):
                    counts = np.concatenate([counts, np.zeros(len(numbers), np.int64)])
                if not held[at]:
                    which, times = np.unique(ids, return_counts=True)
                    counts[which] += times
                at_rows.append(at)
                out.append(len(ids))
                ids_out.append(_planes(ids))
                tokens_in += len(ids)
                if tokens_in >= most_tokens or bytes_in >= BLOCK_BYTES:
                    yield documents()
                    yield from types()
                    out, ids_out, at_rows = [], [], []
            if at_rows:
                yield documents()
        if numbers:
            yield from types()

    schema = (
        f"block bigint, id {source.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens bigint,"
        " ids binary, token binary, number int, count bigint"
    )
    return source.mapInArrow(rows, schema)


NAMES = ["block", "id", "held_out", "n_tokens", "ids", "token", "number", "count"]


def _planes(ids: np.ndarray) -> bytes:
    """32-bit numbers with their low bytes first, then the next: the high ones compress away."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


def _spelled(types: DataFrame, path: str) -> DataFrame:
    """Types with their count over all blocks and what the lattice gives them.

    A token has one row per block at most, however often it occurs.
    """
    everywhere = Window.partitionBy("token")
    counted = types.select(
        "block",
        "number",
        "token",
        F.sum("count").over(everywhere).alias("c"),
        (F.min("block").over(everywhere) == F.col("block")).alias("first"),
    )

    def rows(batches):
        model = lattice(path)
        last, value = None, 0.0
        for batch in batches:
            spelled = []
            for token in batch.column(2).to_pylist():
                if token != last:
                    last = token
                    if token == END_TOKEN:
                        value = math.log(END_SHARE)
                    else:
                        word = token.decode("utf-8", "replace")
                        value = math.log1p(-END_SHARE) + model.log_probability(word)
                spelled.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(spelled)],
                names=["block", "number", "c", "first", "spelled"],
            )

    return counted.mapInArrow(rows, "block bigint, number int, c bigint, first boolean, spelled double")


def lattice_scores(
    df: DataFrame, path: str, held_out, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    `held_out` is a boolean column expression; rows where it is true (or null) are scored
    but not learned from. `path` is a sentencepiece model whose scores order its pieces.
    A null or empty text is its end token alone. Ids may be null or repeated; an empty
    table gives no rows, and without training rows every token is spelled only. Scores
    are logarithms to base ten.

    Documents become numbers into a list of tokens per block, written once. Only those
    lists meet across blocks, to be counted and spelled; each then goes back to its
    block. So a frequent token costs one row per block, and no list of all tokens is
    broadcast or collected; the driver learns N and V.
    """
    source = df.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
    )
    blocks = staged(_blocks(source))
    types = blocks.filter(F.col("token").isNotNull()).select("block", "token", "number", "count")
    spelled = staged(_spelled(types, path))
    learned = spelled.filter("first and c > 0").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n"))
    distinct, total = learned.first()
    total = total or 0
    share = total / (total + distinct) if total else 0.0

    def scored(key, documents, types):
        order = types.column("number").to_numpy()
        c = np.zeros(len(order), np.int64)
        spelled = np.zeros(len(order))
        c[order] = types.column("c").to_numpy()
        spelled[order] = types.column("spelled").to_numpy()
        with np.errstate(divide="ignore"):
            seen = np.log(share * c / max(total, 1))
        model = np.logaddexp(seen, np.log1p(-share) + spelled) / np.log(10)
        base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
        found = []
        for planes in documents.column("ids").to_pylist():
            ids = _numbers(planes)
            found.append((int((c[ids] > 0).sum()), total, float(base[ids].sum()), float(model[ids].sum())))
        known, all_tokens, base_scores, scores = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.Table.from_arrays(
            [
                documents.column("id"),
                documents.column("held_out"),
                documents.column("n_tokens"),
                pa.array(known, pa.int64()),
                pa.array(all_tokens, pa.int64()),
                pa.array(base_scores, pa.float64()),
                pa.array(scores, pa.float64()),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    documents = blocks.filter(F.col("ids").isNotNull()).select("block", "id", "held_out", "n_tokens", "ids")
    schema = (
        f"id {source.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens bigint,"
        " n_known bigint, train_tokens bigint, base_score double, score double"
    )
    lists = spelled.select("block", "number", "c", "spelled")
    return (
        documents.groupBy("block")
        .cogroup(lists.groupBy("block"))
        .applyInArrow(scored, schema)
        .withColumnRenamed("id", id_column)
    )
