"""Secrets in texts, found by way of an inverted index of trigrams.

From each rule's expression follows what any match must hold: a Boolean query of trigrams in
lower case. The trigrams of all rules are looked up in every text once, which gives the
posting lists (trigram, document). A query is evaluated over the lists, from its leaves up:
lists under an "and" are intersected, lists under an "or" united. What is left are the
candidates of a rule, on whose texts it runs. A rule whose matches need no trigram runs on
every document.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from operator import or_
from re import _constants as sre
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import staged, text_key
from rosterline.llm.spans import searchable, sha256, spans_of, written

# The most strings that a part of an expression may stand for to be spelled out.
MOST_STRINGS = 64
# Lists that are intersected at once: each has a bit of a long.
MOST_LISTS = 60


class Rule(NamedTuple):
    """A kind of secret; `least` is the length that group `group` of a match must have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, then public formats of access tokens and keys.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE = (
    Rule("assign", ASSIGN, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # A run of at least 32, which is what is left of all runs: no run holds another.
    Rule("hex", r"[0-9a-f]{32,}"),
)
EXTRA = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = (*BASE, *EXTRA)

# A query is a tuple ("and" | "or", *queries) or a trigram; an empty "and" always holds.
ALWAYS = ("and",)


def _parts(query, kind: str) -> tuple:
    """The parts of a query of that kind, or the query itself as the only one."""
    return query[1:] if not isinstance(query, str) and query[0] == kind else (query,)


def _all_of(parts) -> tuple | str:
    kept = list(dict.fromkeys(p for part in parts for p in _parts(part, "and")))
    return kept[0] if len(kept) == 1 else ("and", *kept)


def _any_of(parts) -> tuple | str:
    """One of the parts; a part that asks for all that another one asks for, and more, is left out."""
    kept = list(dict.fromkeys(p for part in parts for p in _parts(part, "or")))
    asked = [set(_parts(p, "and")) for p in kept]
    kept = [p for p, own in zip(kept, asked, strict=True) if not any(other < own for other in asked)]
    return kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]) -> tuple | str:
    """What a text must hold to hold one of the strings."""
    return _any_of(_all_of(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _class_letters(items) -> set[str] | None:
    """The letters of a class in lower case, or None if there are too many to spell out."""
    letters: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            letters.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
            letters.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return letters if len(letters) <= 8 else None


def _walk(nodes) -> tuple[set[str] | None, tuple | str]:
    """The strings a sequence can stand for, or None, and its query apart from them.

    `run` holds the strings that the nodes since the last gap can spell; at a gap their
    trigrams become part of the query.
    """
    run, parts, whole = {""}, [], True

    def gap():
        nonlocal run, whole
        parts.append(_of_strings(run))
        run, whole = {""}, False

    for kind, value in nodes:
        strings: set[str] | None = None
        after = False  # whether what follows is apart from the strings
        if kind is sre.LITERAL:
            strings = {chr(value).lower()}
        elif kind is sre.IN:
            strings = _class_letters(value)
        elif kind is sre.SUBPATTERN:
            strings, query = _walk(value[3])
            parts.append(query)
        elif kind is sre.BRANCH:
            found = [_walk(branch) for branch in value[1]]
            if all(s is not None for s, _ in found):
                strings = set().union(*(s for s, _ in found))
            else:
                parts.append(_any_of(q if s is None else _of_strings(s) for s, q in found))
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, inner = value
            once, query = _walk(inner)
            if least:
                parts.append(query)
                copies = min(least, 3)
                if once is not None and len(once) ** copies <= MOST_STRINGS:
                    strings = {"".join(p) for p in product(once, repeat=copies)}
                after = most != least or least > copies
            elif once is not None and most == 1:
                strings = once | {""}
        elif kind is sre.AT:
            strings = {""}
        if strings is None or len(run) * len(strings) > MOST_STRINGS:
            gap()
        if strings is not None:
            run = {a + b for a in run for b in strings}
        if after:
            gap()
    if whole:
        return run, _all_of(parts)
    parts.append(_of_strings(run))
    return None, _all_of(parts)


def trigram_query(pattern: str) -> tuple | str:
    """The Boolean query of trigrams in lower case that a text with a match fulfils."""
    strings, query = _walk(parser.parse(pattern))
    return query if strings is None else _all_of([query, _of_strings(strings)])


def trigrams_in(query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*(trigrams_in(q) for q in query[1:]))


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, key) for every one of the trigrams that a text, `low`, holds."""
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return texts.select("key", F.explode(held).alias("trigram"))


class Node(NamedTuple):
    """An "and" or "or" of a query; its height is one more than that of its highest child."""

    name: str
    kind: str
    children: tuple[str, ...]
    height: int


def _nodes(queries) -> tuple[list[Node], dict]:
    """The nodes of some queries, equal ones once, and the name of each query's node.

    Trigrams are named by themselves. An "and" of more than `MOST_LISTS` parts is an "and" of
    several with fewer.
    """
    nodes: dict[tuple, Node] = {}

    def add(query) -> tuple[str, int]:
        if isinstance(query, str):
            return query, 0
        kind, parts = query[0], query[1:]
        if kind == "and" and len(parts) > MOST_LISTS:
            cuts = range(0, len(parts), MOST_LISTS)
            return add((kind, *[(kind, *parts[i : i + MOST_LISTS]) for i in cuts]))
        if query not in nodes:
            names, heights = zip(*map(add, parts), strict=True)
            nodes[query] = Node(f"node {len(nodes)}", kind, names, 1 + max(heights))
        return nodes[query].name, nodes[query].height

    names = {query: add(query)[0] for query in queries}
    return list(nodes.values()), names


def _evaluated(lists: DataFrame, nodes: list[Node]) -> DataFrame:
    """The lists (node, key) of some nodes, from the lists of their children.

    Every key gathers the bits of the children in whose lists it is; a key that is in a
    list several times, as copies are, adds nothing.
    """
    above: dict[str, list] = {}
    for node in nodes:
        for i, child in enumerate(node.children):
            bit = F.lit(1 << i if node.kind == "and" else 1).cast("bigint")
            above.setdefault(child, []).append(F.struct(F.lit(node.name).alias("parent"), bit.alias("bit")))
    parents = F.create_map(*[x for child, found in above.items() for x in (F.lit(child), F.array(*found))])
    whole = F.create_map(
        *[
            F.lit(value)
            for node in nodes
            for value in (node.name, (1 << len(node.children)) - 1 if node.kind == "and" else 1)
        ]
    )
    bits = lists.select("key", F.inline(F.element_at(parents, F.col("node"))))
    held = bits.groupBy("key", "parent").agg(F.bit_or("bit").alias("bits"))
    wanted = F.element_at(whole, F.col("parent")).cast("bigint")
    return held.filter(F.col("bits") == wanted).select(F.col("parent").alias("node"), "key")


def candidates(held: DataFrame, queries: dict) -> DataFrame:
    """(key, kinds): by postings (trigram, key), the kinds with a query that a text fulfils."""
    nodes, names = _nodes(queries.values())
    lists = held.select(F.col("trigram").alias("node"), "key")
    for height in range(1, max((node.height for node in nodes), default=0) + 1):
        lists = lists.unionByName(_evaluated(lists, [node for node in nodes if node.height == height]))
    kinds: dict[str, list[str]] = {}
    for kind, query in queries.items():
        kinds.setdefault(names[query], []).append(kind)
    of = F.create_map(*[x for name, found in kinds.items() for x in (F.lit(name), F.array(*map(F.lit, found)))])
    fulfilled = lists.select("key", F.explode(F.element_at(of, F.col("node"))).alias("kind"))
    return fulfilled.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def anchors(query, lengths: dict[str, int]) -> set[str]:
    """Trigrams of which every text that fulfils a query holds one, with short posting lists."""
    if isinstance(query, str):
        return {query}
    found = [anchors(part, lengths) for part in query[1:]]
    if query[0] == "or":
        return set().union(*found)
    return min(found, key=lambda own: (sum(lengths.get(t, 0) for t in own), sorted(own)))


def _accepted(rule: Rule):
    if not rule.least:
        return None
    if not rule.group:
        return lambda value: F.length(value) >= rule.least
    return lambda value: F.length(F.regexp_extract(value, rule.pattern, rule.group)) >= rule.least


def _named(rank: int, kind: str):
    return lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
    )


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def _scanned(rows: DataFrame, rules, indexed, asked: bool) -> DataFrame:
    """`row` and `found` of rows with `text`: the rules that are not indexed run on all of them.

    If `asked`, the indexed ones run where `kinds` names them, else nowhere.
    """
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    parts = [none]
    for rank, rule in enumerate(rules):
        if rule.kind in indexed and not asked:
            continue
        spans = F.transform(spans_of(F.col("text"), rule.pattern, _accepted(rule)), _named(rank, rule.kind))
        wanted = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.lit(True)
        parts.append(F.when(wanted, spans).otherwise(none))
    return rows.select("row", F.array_sort(F.concat(*parts)).alias("found"))


def find_secrets(df: DataFrame, rules=RULES, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The input's columns as struct `row`, and `found`: spans (start, rank, end, kind), sorted.

    `rank` is the place of the kind in `rules`. A null or empty text has none; rows and ids may
    repeat, columns may have any names. Everything is a built-in function.

    The posting lists are written once, and their lengths, a number per trigram of the rules,
    choose the rarest trigrams that any candidate must hold one of. Only texts that do cross an
    exchange to meet the candidates, by a key of id and text, one row each, so no key is hot but
    by whole copies; all others go past it to the rules that scan fully.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    queries = {kind: query for kind, query in queries.items() if query != ALWAYS}
    key = text_key(id_column, text_column)
    text = F.coalesce(F.col(text_column), F.lit(""))
    low = F.lower(text).alias("low")
    keyed = df.select(
        F.struct("*").alias("row"), searchable(F.col(text_column)).alias("text"), key.alias("key"), low
    )
    if not queries:
        return _scanned(keyed, rules, queries, False)
    listed = sorted(set().union(*map(trigrams_in, queries.values())))
    held = staged(postings(df.select(key.alias("key"), low), listed))
    lengths = {r.trigram: r["count"] for r in held.groupBy("trigram").count().collect()}
    rare = sorted(set().union(*(anchors(query, lengths) for query in queries.values())))
    possible = reduce(or_, [F.contains("low", F.lit(t)) for t in rare])
    met = keyed.filter(possible).drop("low").join(candidates(held, queries), "key", "left")
    past = keyed.filter(~possible)
    return _scanned(met, rules, queries, True).unionByName(_scanned(past, rules, queries, False))


def secret_report(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans)."""
    found = find_secrets(df, RULES, text_column, id_column)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return found.select(
        F.col("row")[id_column].alias(id_column),
        *[
            F.size(F.filter("found", _of_kind(rule.kind))).cast("bigint").alias(f"n_{rule.kind}")
            for rule in BASE
        ],
        sha256(written(base)).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
