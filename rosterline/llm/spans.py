"""Places of regular expressions in texts, with built-in functions only.

A span is a struct (start, end, value) in code points, end exclusive. Expressions that the
caller passes must consume what they match in one way (use possessive repeats for groups),
since Java's other repeats of groups recurse once per round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands before and after each match while places are counted. Texts that hold it get
# another control character instead, as long and in no class of any expression.
MARK, INSTEAD = "\x01", "\x03"
# Numbers that are added up one after the other, and code points of a chunk of text.
BLOCK, CHUNK = 256, 64


def searchable(text: Column) -> Column:
    """A text ready for `spans_of`, null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), MARK, INSTEAD)


def spans_of(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """The leftmost matches that do not overlap, of which those stay whose value `keep` accepts.

    A match that is dropped still uses up its characters. Every second piece between marks
    is a match, so the places follow from the lengths of the pieces, in time that grows with
    their number.
    """
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)

    def placed(pieces: Column) -> Column:
        ends = running(F.transform(pieces, F.length), lambda a, x: a + x)
        spans = F.zip_with(
            pieces,
            ends,
            lambda piece, end: F.struct((end - F.length(piece)).alias("start"), end.alias("end"), piece.alias("value")),
        )
        wanted = (lambda s, i: i % 2 == 1) if keep is None else (lambda s, i: (i % 2 == 1) & keep(s["value"]))
        return F.filter(spans, wanted)

    return bound(marked, placed)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` and lambdas in it name it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(numbers: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What an array's first one, two, three, ... numbers, none below zero, come to.

    `add` is a sum, or another operation for which 0 changes nothing and order of grouping
    does not matter. Adding to an array copies it, so it runs within blocks, and over what
    whole blocks come to.
    """

    def appended(values: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast("array<int>").alias("all"))

        def step(state: Column, x: Column) -> Column:
            at = add(state["at"], x)
            return F.struct(at.alias("at"), F.array_append(state["all"], at).alias("all"))

        return F.aggregate(values, start, step, lambda state: state["all"])

    def over(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda values: F.aggregate(values, F.lit(0), add))
        before = F.concat(F.array(F.lit(0)), appended(totals, F.lit(0)))
        return F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), appended))

    def cut(values: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
        return bound(F.transform(places, lambda i: F.slice(values, i, BLOCK)), over)

    return bound(numbers, cut)


def chunks(text: Column) -> Column:
    """A text as chunks of `CHUNK` code points, of which `part` takes some without counting from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def part(chunked: Column, start: Column, end: Column) -> Column:
    """The code points from `start` up to `end` of a text in chunks."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.floor((end - 1) / CHUNK).cast("int")
    held = F.array_join(F.slice(chunked, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.substring(held, start - first * CHUNK + 1, end - start)


def replaced(text: Column, spans: Column, instead: Callable[[Column, Column], Column]) -> Column:
    """A text with spans replaced; of those that overlap, their union.

    `instead(span, end)` stands for a union that begins with `span` and ends at `end`. Spans
    are structs with `start` and `end`; of equal starts the shortest comes first.
    """

    def apart(ordered: Column) -> Column:
        return bound(
            running(F.transform(ordered, lambda s: s["end"]), lambda a, x: F.greatest(a, x)),
            lambda ends: bound(headed(ordered, ends), lambda heads: united(ends, heads)),
        )

    def headed(ordered: Column, ends: Column) -> Column:
        """Spans that begin behind all before them, with where those end."""
        with_before = F.zip_with(
            ordered,
            F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1)),
            lambda s, at: F.struct(s.alias("span"), at.alias("at")),
        )
        return F.filter(with_before, lambda x: x["span"]["start"] >= x["at"])

    def united(ends: Column, heads: Column) -> Column:
        # A union ends where the next one's text begins.
        next_at = F.concat(F.slice(F.transform(heads, lambda x: x["at"]), 2, F.size(heads)), F.array(F.element_at(ends, -1)))
        unions = F.zip_with(
            heads,
            next_at,
            lambda x, end: F.struct(x["span"].alias("span"), x["at"].alias("at"), end.alias("end")),
        )
        return bound(chunks(text), lambda c: bound(unions, lambda found: joined(c, found)))

    def joined(c: Column, unions: Column) -> Column:
        pieces = F.transform(
            unions, lambda u: F.concat(part(c, u["at"], u["span"]["start"]), instead(u["span"], u["end"]))
        )
        last = F.element_at(unions, -1)["end"]
        return F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))

    return F.when(F.size(spans) > 0, bound(F.array_sort(spans), apart)).otherwise(text)


def written(spans: Column) -> Column:
    """Spans (kind, start, end) as kind:start:end, comma-joined."""
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(texts, ",")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
