"""URL filters: rules by host and path, and a ratio of two character language models for the rest.

URLs that a rule decides are the training data: one Markov model of variable order for the
accepted, one for the rejected. A model knows the strings of up to `ORDER` + 1 characters
that make up at least a fixed share of all strings of their length, so it has a bounded
size whatever the input; their counts come from all training URLs. A character's
probability is smoothed from the longest known context down to none (Witten and Bell).

What decides is the difference of the two log-likelihoods by character. It is calibrated on
training URLs the models have not seen: a logistic curve fitted to histograms of the
differences, with both classes weighing the same.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import staged

ORDER = 5
# A string is known if it makes up this share of the strings of its length, so that a model
# has at most 1 / SHARE strings of each length.
SHARE = 1 / 20_000
# What the smallest context falls back on: every character alike.
CHARACTERS = 256
# One training URL in so many, told by its text, calibrates.
FOLDS = 5
# Differences are counted in bins of this width, up to that far from zero.
BIN, FARTHEST = 0.01, 10.0
# Begins every URL, so that a context is never empty but for order 0.
START = "\x02"
# The most rules, which are arguments of one expression.
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """`name` is a host and a path; it holds for subdomains, and for paths that begin with it."""

    verdict: str
    name: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2]


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct (name, verdict); null without one.

    Of rules of the same length the one given first holds.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


class MarkovModel:
    """Character probabilities from counts of known strings, longest context first."""

    def __init__(self, counts: dict[str, int]):
        followers: dict[str, list[str]] = defaultdict(list)
        for known in counts:
            followers[known[:-1]].append(known)
        self.known: dict[str, float] = {}  # log10 of a known string's last character
        self.fallback: dict[str, float] = {}  # log10 of what a context leaves to the shorter one
        for context in sorted(followers, key=len):
            strings = followers[context]
            total = sum(counts[s] for s in strings) + len(strings)
            self.fallback[context] = math.log10(len(strings) / total)
            for s in strings:
                lower = 10 ** self._log(s[1:]) if len(s) > 1 else 1 / CHARACTERS
                self.known[s] = math.log10((counts[s] + len(strings) * lower) / total)

    def _log(self, string: str) -> float:
        """log10 of the last character after the ones before it."""
        value = 0.0
        while string:
            known = self.known.get(string)
            if known is not None:
                return value + known
            value += self.fallback.get(string[:-1], 0.0)
            string = string[1:]
        return value - math.log10(CHARACTERS)

    def log_likelihood(self, text: str) -> float:
        """log10 probability of a text."""
        text = START + text
        return sum(self._log(text[max(0, i - ORDER) : i + 1]) for i in range(1, len(text)))


def known_strings(urls: DataFrame) -> dict[str, dict[str, int]]:
    """For each class of (class, text) the counts of its known strings.

    All strings of all texts are counted; only those of a sufficient share come to the
    driver, at most ORDER / SHARE for each class.
    """
    marked = F.concat(F.lit(START), F.col("text"))
    ends = F.sequence(F.lit(2), F.length("marked"))
    strings = (
        urls.filter("text <> ''")
        .select("class", marked.alias("marked"))
        .select("class", "marked", F.explode(ends).alias("end"))
        .select(
            "class",
            F.explode(
                F.array(
                    *[
                        F.when(F.col("end") >= size, F.expr(f"substr(marked, end - {size - 1}, {size})"))
                        for size in range(1, ORDER + 2)
                    ]
                )
            ).alias("string"),
        )
        .filter("string IS NOT NULL")
        .groupBy("class", "string")
        .agg(F.count("*").alias("n"))
    )
    sizes = Counter()
    counted = staged(strings.withColumn("size", F.length("string")))
    for name, size, total in counted.groupBy("class", "size").agg(F.sum("n")).collect():
        sizes[name, size] = total
    least = F.lit(None).cast("double")
    for (name, size), total in sizes.items():
        fits = (F.col("class") == name) & (F.col("size") == size)
        least = F.when(fits, F.lit(total * SHARE)).otherwise(least)
    found: dict[str, dict[str, int]] = defaultdict(dict)
    for name, string, n in counted.filter(F.col("n") >= least).select("class", "string", "n").collect():
        found[name][string] = n
    return found


def difference_of(accepted: MarkovModel, rejected: MarkovModel, text: Column) -> Column:
    """By how much the accepted model likes a character of a text more than the rejected one.

    An empty text has the difference 0, a null one null.
    """

    @F.pandas_udf("double")
    def difference(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: None
            if t is None
            else (accepted.log_likelihood(t) - rejected.log_likelihood(t)) / max(len(t), 1)
        ).astype("float64")

    return difference(text)


def logistic_fit(bins: list[tuple[float, int, int]], rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the log odds of being accepted, from (difference, accepted, rejected).

    Both classes weigh the same, and a weak pull towards slope 1 keeps the slope finite where
    a point parts the classes. The slope is never negative.
    """
    x = np.array([b[0] for b in bins], np.float64)
    yes, no = (np.array([b[i] for b in bins], np.float64) for i in (1, 2))
    yes, no = yes / max(yes.sum(), 1) * 1000, no / max(no.sum(), 1) * 1000
    design = np.stack([x, np.ones_like(x)], 1)
    pull = np.array([1e-3, 1e-3])
    weights = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (yes * (1 - p) - no * p) - pull * (weights - [1.0, 0.0])
        curve = design.T @ (design * ((yes + no) * p * (1 - p))[:, None]) + np.diag(pull)
        step = np.linalg.solve(curve, gradient)
        weights = weights + np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(weights[0]), 0.0), float(weights[1])


def url_verdicts(
    df: DataFrame, rules: Sequence[Rule], allow: str = "allow", url_column: str = "url"
) -> DataFrame:
    """The input's columns as struct `row`, with `host`, `path`, `rule`, `verdict`, `difference` and `odds`.

    A rule's verdict holds where one fits; `difference` and `odds` are null there. Elsewhere
    `odds`, the calibrated log odds of being accepted, decide: `allow` from 0 on, else the
    other verdict of the rules. A null URL or
    one without `://` has an empty host and path, and a null URL the difference 0. Where the
    rules accept or reject nothing there is no other class to tell apart: the difference is 0
    and the odds are those of the class that is there; without either, everything is allowed.
    Rows may repeat, columns may have any names. Nothing but counts is exchanged.
    """
    verdicts = {r.verdict for r in rules}
    other = next(iter(sorted(verdicts - {allow})), "block")
    url = F.col("row")[url_column]
    host, path = host_of(url), path_of(url)
    after = _after_scheme(url)
    text = F.concat(host, after.substr(F.length(host) + 1, F.length(after)))
    judged = df.select(F.struct("*").alias("row")).select(
        "row",
        host.alias("host"),
        path.alias("path"),
        rule_of(host, path, rules).alias("fit"),
        F.when(F.instr(url, "://") > 0, text).otherwise(F.coalesce(url, F.lit(""))).alias("text"),
    )
    training = judged.filter("fit IS NOT NULL AND text <> ''").select(
        F.when(F.col("fit.verdict") == allow, "accepted").otherwise("rejected").alias("class"),
        "text",
        (F.crc32(F.col("text").cast("binary")) % FOLDS == 0).alias("apart"),
    )
    counts = known_strings(training.filter("NOT apart").select("class", "text"))
    accepted, rejected = (MarkovModel(counts.get(c, {})) for c in ("accepted", "rejected"))
    slope, offset = 0.0, 0.0
    if counts.get("accepted") and counts.get("rejected"):
        edge = int(FARTHEST / BIN)
        bins = F.round(difference_of(accepted, rejected, F.col("text")) / BIN).cast("int")
        seen = (
            training.filter("apart")
            .groupBy(F.least(F.greatest(bins, F.lit(-edge)), F.lit(edge)).alias("bin"))
            .agg(
                F.count_if(F.col("class") == "accepted").alias("yes"),
                F.count_if(F.col("class") == "rejected").alias("no"),
            )
            .orderBy("bin")
            .collect()
        )
        slope, offset = logistic_fit([(r.bin * BIN, r.yes, r.no) for r in seen])
    else:
        accepted = rejected = MarkovModel({})
        offset = -1.0 if counts.get("rejected") else 1.0
    open_text = F.when(F.col("fit").isNull(), F.col("text"))
    found = judged.withColumn("difference", difference_of(accepted, rejected, open_text))
    odds = slope * F.col("difference") + offset
    return found.select(
        "row",
        "host",
        "path",
        F.col("fit.name").alias("rule"),
        F.coalesce("fit.verdict", F.when(odds >= 0, allow).otherwise(other)).alias("verdict"),
        "difference",
        odds.alias("odds"),
    )


def url_report(
    df: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict, difference, odds): one row per row of the input."""
    found = url_verdicts(df, rules, url_column=url_column)
    return found.select(
        F.col("row")[id_column].alias(id_column), "host", "path", "rule", "verdict", "difference", "odds"
    )
