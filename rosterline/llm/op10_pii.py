"""Personal data by weak supervision.

Base kinds have exact rules and always stand. For what rules cannot decide, looser
expressions propose candidates, and three labelers vote on each: the form of the value, a
gazetteer, and the words in front of it. Expectation maximisation estimates from the votes
alone how reliable each labeler is and how likely each pattern of votes is personal data.
With those likelihoods as soft labels a linear span classifier is trained on features of
the span, which also decides where the labelers abstain or disagree.

Votes and features take few values, so the driver learns from counts: one row per
combination that occurs, whatever the number of documents.
"""

from __future__ import annotations

import math
from itertools import chain
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from rosterline.llm.common import staged
from rosterline.llm.spans import (
    MARK,
    bound,
    chunks,
    part,
    replaced,
    searchable,
    sha256,
    spans_of,
    written,
)

# Fixed values. A repeat that begins with the class of what precedes it starts at the head of
# a run only (or where the last match ended), which finds the same matches in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")

TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora"
GIVEN_NAMES = (
    "James John Robert Michael William David Richard Thomas Mary Patricia Jennifer Linda Elizabeth Susan"
    " Jessica Sarah Hans Peter Klaus Jürgen Wolfgang Ursula Sabine Monika Pierre Jean Michel Philippe"
    " Marie Nathalie Isabelle Sylvie José Antonio Manuel Francisco Carmen María Ana Isabel"
).split()
NAME_PART = r"\p{Lu}[\p{Ll}'-]{1,20}"
CANDIDATES = {
    "name": (
        rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:(?:{TITLES})\.?\x20{NAME_PART}(?:\x20{NAME_PART})?"
        rf"|(?:{'|'.join(GIVEN_NAMES)})\x20{NAME_PART})(?![\p{{L}}\p{{N}}])"
    ),
    "local_phone": (
        r"(?<![\p{L}\p{N}+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![\p{L}\p{N}])"
    ),
    "number": r"(?<![\p{L}\p{N}.+-])[0-9]{2,4}(?:[\x20-]?[0-9]{2,4}){1,6}+(?![\p{L}\p{N}])",
    "handle": r"(?<![\p{L}\p{N}._%+@/-])@[A-Za-z][A-Za-z0-9_]{2,30}(?![\p{L}\p{N}@.])",
}
KINDS = (*BASE_KINDS, *CANDIDATES)
# Words that make personal data likely after them, and words that make it unlikely.
CUES = {
    "name": (r"name|called|regards|sincerely|contact|dear|hello|author", r"saint|street|avenue|lake|hotel"),
    "local_phone": (r"phone|tel|call|fax|mobile|cell|text", r"order|invoice|part|item|model|version|isbn"),
    "number": (r"ssn|social|account|iban|passport|licen[cs]e|tax|id", r"order|invoice|isbn|part|model|page|year"),
    "handle": (r"follow|user|handle|twitter|instagram|account|by|via", r"css|java|python|code|decorator"),
}
NOT_PEOPLE = "media import param return override font keyframes charset property staticmethod here all".split()
CONTEXT = 40


class Labels(NamedTuple):
    """What expectation maximisation found: share of personal data per kind, and votes given it."""

    prior: dict[str, float]
    votes: list[dict[bool, dict[int, float]]]


def _at_most_255(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda part: part.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    letters = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))

    def worth(letter: Column, place: Column) -> Column:
        twice = letter.cast("int") * (1 + place % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(letters, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(16, 19) & _passes_luhn(digits)


BASE = {
    "email": (EMAIL, None),
    "ip": (IP, _at_most_255),
    "card": (CARD, _card),
    "phone": (PHONE, lambda value: F.length(_digits(value)).between(8, 15)),
}


def _placed(rank: int):
    return lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"))


def base_spans(text: Column) -> Column:
    """Spans (rank, start, end) of the base kinds, by kind and start."""
    parts = [F.transform(spans_of(text, p, keep), _placed(rank)) for rank, (p, keep) in enumerate(BASE.values())]
    return F.concat(*parts)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _form(kind: str, value: Column) -> Column:
    """The labeler of the value's own form."""
    digits = _digits(value)
    if kind == "name":
        return _vote(value.rlike(rf"^(?:{TITLES})\b"), F.lit(False))
    if kind == "local_phone":
        return _vote(digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^[01]"))
    if kind == "number":
        # A number as long as a card's that is no card has failed the check digit.
        return _vote(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), (F.length(digits) < 9) | (F.length(digits) > 12))
    return _vote(value.rlike("[0-9_]") & (F.length(value) <= 20), value.rlike("^@[A-Z_]+$"))


def _gazetteer(kind: str, value: Column) -> Column:
    """The labeler that looks the value up."""
    if kind == "name":
        listed = F.exists(F.split(value, r"[\x20.]+"), lambda part: part.isin(*GIVEN_NAMES))
        return _vote(listed, F.lit(False))
    if kind == "handle":
        return _vote(F.lit(False), F.lower(F.substring(value, 2, 40)).isin(*NOT_PEOPLE))
    if kind == "local_phone":
        return _vote(_digits(value).rlike("^[0-9]{3}555"), _digits(value).rlike(r"^([0-9])\1+$"))
    # Areas that were never given out, and what begins like a date.
    return _vote(
        value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"),
        value.rlike("^(?:19|20)[0-9]{2}[-\x20]") | (F.length(_digits(value)) > 12),
    )


def _candidate(kind: str, rank: int, chunked: Column):
    """Turns a span of a looser expression into its votes and features."""
    likely, unlikely = CUES[kind]

    def described(s: Column) -> Column:
        before = F.lower(part(chunked, F.greatest(s["start"] - CONTEXT, F.lit(0)), s["start"]))
        value = s["value"]
        cue = _vote(before.rlike(rf"\b(?:{likely})\b"), before.rlike(rf"\b(?:{unlikely})\b"))
        digits = F.length(_digits(value))
        return F.struct(
            F.lit(rank).alias("rank"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.array(_form(kind, value), _gazetteer(kind, value), cue).alias("votes"),
            F.array(
                F.lit(kind),
                F.concat(F.lit("digits"), F.least(digits, F.lit(20)).cast("string")),
                F.when(value.rlike(r"[\x20.()-]"), "parted").otherwise("solid"),
                F.when(before.rlike(r"[:=#]\s*$"), "announced")
                .when(before.rlike(r"(?:^|[.!?\n])\s*$"), "first")
                .otherwise("within"),
                F.when(cue == 1, "cue").when(cue == -1, "countercue").otherwise("plain"),
            ).alias("features"),
        )

    return described


def candidate_spans(text: Column, base: Column) -> Column:
    """Spans (rank, start, end, votes, features) of the other kinds that no base span touches."""
    loose = F.array(*[spans_of(text, pattern) for pattern in CANDIDATES.values()])

    def described(found: Column) -> Column:
        some = F.exists(found, lambda spans: F.size(spans) > 0)
        hidden = replaced(text, F.transform(base, _ends), lambda s, end: F.repeat(F.lit(MARK), end - s["start"]))
        # Texts without candidates are not cut up.
        return bound(
            F.when(some, chunks(text)),
            lambda c: bound(F.when(some & (F.size(base) > 0), chunks(hidden)), lambda h: free(found, c, h)),
        )

    def free(found: Column, chunked: Column, covered: Column) -> Column:
        def apart(s: Column) -> Column:
            return ~F.coalesce(F.contains(part(covered, s["start"], s["end"]), F.lit(MARK)), F.lit(False))

        parts = [
            F.transform(F.filter(found[i], apart), _candidate(kind, i + len(BASE), chunked))
            for i, kind in enumerate(CANDIDATES)
        ]
        return F.concat(*parts)

    return bound(loose, described)


def _ends(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["end"].alias("end"))


def maximise(counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 60) -> Labels:
    """Expectation maximisation over (kind, votes, number): nobody says which votes are right.

    Labelers are taken to be independent given the truth. They begin as right rather than
    wrong, and one count of every vote is added, so a vote never seen stays possible.
    """
    labelers = len(counts[0][1]) if counts else 0
    prior = {kind: 0.5 for kind, _, _ in counts}
    votes = [{True: {1: 0.5, 0: 0.4, -1: 0.1}, False: {1: 0.1, 0: 0.4, -1: 0.5}} for _ in range(labelers)]
    labels = Labels(prior, votes)
    for _ in range(rounds):
        seen = [{z: {v: 1.0 for v in (-1, 0, 1)} for z in (True, False)} for _ in range(labelers)]
        share = {kind: [1.0, 1.0] for kind in prior}
        for kind, vote, n in counts:
            p = likelihood(labels, kind, vote)
            share[kind][0] += n * p
            share[kind][1] += n * (1 - p)
            for j, v in enumerate(vote):
                seen[j][True][v] += n * p
                seen[j][False][v] += n * (1 - p)
        labels = Labels(
            {kind: a / (a + b) for kind, (a, b) in share.items()},
            [{z: {v: c / sum(s[z].values()) for v, c in s[z].items()} for z in s} for s in seen],
        )
    return labels


def likelihood(labels: Labels, kind: str, votes: tuple[int, ...]) -> float:
    """How likely a candidate with these votes is personal data."""
    odds = math.log(labels.prior[kind] / (1 - labels.prior[kind]))
    for labeler, vote in zip(labels.votes, votes, strict=True):
        odds += math.log(labeler[True][vote] / labeler[False][vote])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def train(rows: list[tuple[list[str], float, int]], rounds: int = 400) -> dict[str, float]:
    """Weights of a logistic regression on (features, likelihood, number); "" is the bias."""
    weights = {f: 0.0 for f in chain([""], *(features for features, _, _ in rows))}
    total = sum(n for _, _, n in rows)
    for _ in range(rounds):
        slope = {f: 1e-3 * w for f, w in weights.items()}
        for features, target, n in rows:
            names = ["", *features]
            odds = max(-30.0, min(30.0, sum(weights[f] for f in names)))
            error = (1 / (1 + math.exp(-odds)) - target) * n / total
            for f in names:
                slope[f] += error
        for f in weights:
            weights[f] -= 0.5 * slope[f]
    return weights


def _learned(documents: DataFrame) -> dict[str, float]:
    """The span classifier from the candidates of all documents.

    Three votes with three values and five features with a few each: the number of
    groups is bounded, and counts combine before the exchange.
    """
    spans = documents.select(F.explode("candidates").alias("c"))
    groups = spans.groupBy("c.votes", "c.features").agg(F.count(F.lit(1)).alias("n")).collect()
    by_votes: dict[tuple[str, tuple[int, ...]], int] = {}
    for g in groups:
        key = (g.features[0], tuple(g.votes))
        by_votes[key] = by_votes.get(key, 0) + g.n
    labels = maximise([(kind, votes, n) for (kind, votes), n in sorted(by_votes.items())])
    return train([(g.features, likelihood(labels, g.features[0], tuple(g.votes)), g.n) for g in _sorted(groups)])


def _sorted(groups: list[Row]) -> list[Row]:
    return sorted(groups, key=lambda g: (g.features, g.votes))


def find_personal(df: DataFrame, text_column: str = "text") -> DataFrame:
    """The input's columns as struct `row`, and `found`: spans (rank, start, end), by kind and start.

    `rank` counts the kinds of `KINDS`. A null or empty text has none; rows may repeat, columns
    may have any names, and a table without candidates trains nothing. Documents are read
    once and written with their candidates; nothing is exchanged but counts, and
    everything is a built-in function.
    """
    text = df.select(F.struct("*").alias("row"), searchable(F.col(text_column)).alias("text"))
    based = text.withColumn("base", base_spans(F.col("text")))
    described = based.select("row", "base", candidate_spans(F.col("text"), F.col("base")).alias("candidates"))
    documents = staged(described)
    weights = _learned(documents)
    if not weights.get(""):
        return documents.select("row", F.col("base").alias("found"))
    lookup = F.create_map(*[F.lit(x) for f, w in sorted(weights.items()) if f for x in (f, w)])

    def personal(s: Column) -> Column:
        total = F.aggregate(
            s["features"], F.lit(weights[""]), lambda a, f: a + F.coalesce(F.element_at(lookup, f), F.lit(0.0))
        )
        return total > 0

    kept = F.transform(
        F.filter("candidates", personal),
        lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return documents.select("row", F.array_sort(F.concat("base", kept)).alias("found"))


def _with_kind(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(
        spans,
        lambda s: F.struct(names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def _ranked(rank: int):
    return lambda s: s["rank"] == rank


def personal_report(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    found = find_personal(df.select(id_column, text_column), text_column)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    counts = [
        F.size(F.filter("found", _ranked(rank))).cast("bigint").alias(f"n_{kind}")
        for rank, kind in enumerate(BASE_KINDS)
    ]
    return found.select(
        F.col("row")[id_column].alias(id_column),
        *counts,
        sha256(written(_with_kind(base))).alias("base_sha256"),
        written(_with_kind(F.col("found"))).alias("spans"),
    )


def mask_personal(df: DataFrame, text_column: str = "text") -> DataFrame:
    """The input with every span of a text replaced by its kind in angle brackets.

    Where spans overlap, their union is replaced under the kind of the one that starts first.
    Null stays null; other columns stay as they are.
    """
    found = find_personal(df, text_column)
    spans = F.transform(
        "found",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank")),
    )
    text = F.col("row")[text_column]
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    changed = replaced(text, spans, lambda s, end: names[s["rank"]])
    columns = [changed.alias(c) if c == text_column else F.col("row")[c].alias(c) for c in df.columns]
    return found.select(*columns)
