"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. Each is a logistic regression on the words a
text holds and on the log odds that the earlier models of the chain give. A later model is
trained with log odds from models that have not seen the document (out of fold), so it
learns how far the earlier ones can be trusted on new text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import staged

# The models are fitted on at most so many labelled documents, those with the smallest
# hashes of their ids, and on so many words. Everything else covers all rows.
SAMPLE, FEATURES = 40_000, 2048
MIN_DOCUMENTS, FOLDS = 3, 3
PENALTY, STEPS = 1e-4, 40
# Chi square that chance alone reaches once in a hundred words.
STRENGTH = 6.63
# Letters in the heads of words.
HEADS = (4, 5)
# Log odds are cut off here.
LARGEST_ODDS = 14.0


PUNCTUATION = ".,;:!?\"'()[]{}*#$%&|<>-_+=/~`"


def features_of(word: str) -> list[str]:
    """What a word in lower case stands for: itself without marks around it, and its heads if long.

    A head, `^` and the first letters, stands for all forms of a word.
    """
    bare = word.strip(PUNCTUATION)
    if len(bare) <= HEADS[-1]:
        return [bare] if bare else []
    return [bare, *[f"^{bare[:size]}" for size in HEADS]]


@dataclass
class Model:
    """One category: log odds from the words a text holds and the earlier categories' log odds."""

    category: str
    bias: float
    weights: np.ndarray
    earlier: np.ndarray


@dataclass
class Chain:
    """Models in the order in which they are applied, and the number of each word."""

    vocabulary: dict[str, int]
    models: list[Model]

    def score(self, df: DataFrame, id_column: str, text_column: str) -> DataFrame:
        """(id, p_<category>...) of every row; nothing is exchanged, and a text is read whole."""
        names = ["id", *[f"p_{m.category}" for m in self.models]]

        def rows(batches):
            for batch in batches:
                lists = [set((text or "").lower().split()) for text in batch.column(1).to_pylist()]
                listed = {}
                for word in set().union(*lists):
                    found = [self.vocabulary[f] for f in features_of(word) if f in self.vocabulary]
                    if found:
                        listed[word] = found
                scores = []
                for words in lists:
                    columns = sorted({c for w in words & listed.keys() for c in listed[w]})
                    scores.append(self._probabilities(columns))
                table = np.array(scores, np.float64).reshape(-1, len(self.models))
                parts = [pa.array(table[:, i]) for i in range(len(self.models))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *parts], names=names)

        source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
        schema = f"id {source.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names[1:])
        return source.mapInArrow(rows, schema).withColumnRenamed("id", id_column)

    def _probabilities(self, columns: list[int]) -> list[float]:
        odds: list[float] = []
        for model in self.models:
            own = model.bias + float(model.weights[columns].sum()) + float(model.earlier @ odds if odds else 0)
            odds.append(max(-LARGEST_ODDS, min(LARGEST_ODDS, own)))
        return [1 / (1 + math.exp(-x)) for x in odds]


def _inputs(rows: DataFrame, earlier: list[str]) -> DataFrame:
    """Words and the log odds of the earlier categories as one vector, `_features`."""
    inputs = ["_counts", *[f"_odds_{name}" for name in earlier]]
    return VectorAssembler(inputCols=inputs, outputCol="_features").transform(rows)


def _fitted(rows: DataFrame, width: int, earlier: list[str], category: str):
    """A model of one category and the regression it comes from.

    Where the rows show one class only, it gives its smoothed share and there is no regression.
    """
    label = f"_y_{category}"
    count, positive = rows.agg(F.count(label), F.sum(label)).first()
    positive = positive or 0
    if not 0 < positive < count:
        share = (positive + 0.5) / (count + 1)
        return Model(category, math.log(share / (1 - share)), np.zeros(width), np.zeros(len(earlier))), None
    regression = LogisticRegression(
        featuresCol="_features", labelCol=label, regParam=PENALTY, maxIter=STEPS, rawPredictionCol="_raw"
    ).fit(_inputs(rows, earlier))
    weights = regression.coefficients.toArray()
    return Model(category, float(regression.intercept), weights[:width], weights[width:]), regression


def _out_of_fold(rows: DataFrame, width: int, earlier: list[str], category: str) -> DataFrame:
    """The rows with `_odds_<category>` from models that were fitted on the other folds."""
    parts = None
    for fold in range(FOLDS):
        model, regression = _fitted(rows.filter(F.col("_fold") != fold), width, earlier, category)
        held = rows.filter(F.col("_fold") == fold)
        if regression is None:
            odds = F.lit(model.bias)
        else:
            held, odds = regression.transform(_inputs(held, earlier)), vector_to_array("_raw")[1]
        odds = F.least(F.greatest(odds, F.lit(-LARGEST_ODDS)), F.lit(LARGEST_ODDS))
        part = held.select(*rows.columns, odds.alias(f"_odds_{category}"))
        parts = part if parts is None else parts.unionByName(part)
    return staged(parts)


def _vocabulary(sample: DataFrame, labels: list[str]) -> list[str]:
    """The words whose documents differ most from the rest in some category, by chi square."""
    totals = sample.agg(F.count(F.lit(1)), *[F.sum(c) for c in labels]).first()
    n = totals[0]
    counts = (
        sample.select(F.explode("_words").alias("word"), *labels)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in labels])
        .filter(F.col("n") >= MIN_DOCUMENTS)
    )
    strongest = F.lit(0.0)
    for label, positive in zip(labels, totals[1:], strict=True):
        if 0 < positive < n:
            expected = F.col("n") * (positive / n)
            spread = expected * (1 - positive / n) * (1 - F.col("n") / (n + 1))
            strongest = F.greatest(strongest, (F.col(label) - expected) ** 2 / (spread + 0.5))
    associated = counts.select("word", strongest.alias("strength")).filter(F.col("strength") >= STRENGTH)
    best = associated.orderBy(F.desc("strength"), "word").limit(FEATURES)
    return sorted(r.word for r in best.collect())


def fit_chain(
    df: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> Chain:
    """Fit a chain on the documents that have labels.

    `categories` names the chain in order and gives each category as a 0/1 expression over
    `labels`; a document with several label rows has the larger value, one with a null
    label or a null id is left out. A document given twice counts twice. Without any
    labelled document every probability is one half, with one class only its smoothed
    share.
    """
    names = list(categories)
    chosen = (
        labels.select(
            F.col(id_column).alias("_id"),
            *[c.cast("double").alias(f"_y_{n}") for n, c in categories.items()],
        )
        .groupBy("_id")
        .agg(*[F.max(f"_y_{n}").alias(f"_y_{n}") for n in names])
        .dropna()
        .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id")
        .limit(sample)
    )
    targets = [f"_y_{n}" for n in names]
    # The sample has a fixed size, so it may be broadcast; the texts stay where they are.
    texts = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    labelled = texts.join(F.broadcast(chosen), "_id").select("_id", "_text", *targets)
    rows = staged(_with_words(labelled))
    listed = _vocabulary(rows, targets) if not rows.isEmpty() else []
    chain = Chain({word: i for i, word in enumerate(listed)}, [])
    # Spark's vectors need a word; one that no text holds changes nothing.
    vectors = CountVectorizerModel.from_vocabulary(listed or [""], inputCol="_words", outputCol="_counts")
    vectors.setBinary(True)
    fold = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(3)), F.lit(FOLDS))
    rows = vectors.transform(rows).drop("_words").withColumn("_fold", fold)
    for at, name in enumerate(names):
        width = max(len(listed), 1)
        model, _ = _fitted(rows, width, names[:at], name)
        chain.models.append(model)
        if at + 1 < len(names):
            rows = _out_of_fold(rows, width, names[:at], name)
    return chain


def _with_words(labelled: DataFrame) -> DataFrame:
    """The rows with the distinct features of their texts, `_words`, in the text's place."""
    kept = [c for c in labelled.columns if c != "_text"]

    def rows(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            found = [
                sorted({f for w in set((text or "").lower().split()) for f in features_of(w)}) for text in texts
            ]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.string()))], names=[*kept, "_words"])

    kinds = [f"{c} {labelled.schema[c].dataType.simpleString()}" for c in kept]
    return labelled.mapInArrow(rows, ", ".join([*kinds, "_words array<string>"]))


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.5,
) -> DataFrame:
    """(id, p_<category>..., <category>...) of every document; a category holds from `threshold` on.

    One row per input row, whatever its id; a null or empty text has no words and gets
    what the models give a text without them. Nothing is exchanged while scoring.
    """
    scored = fit_chain(df, labels, categories, id_column, text_column).score(df, id_column, text_column)
    flags = [(F.col(f"p_{n}") >= threshold).alias(n) for n in categories]
    return scored.select("*", *flags)
