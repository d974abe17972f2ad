"""Check queries as DuckDB SQL, where SQL can express them.

Written in the plainest form: every window, every pair, every rule on every text. Operators
with a tokenizer, a fitted model or a packing have none and are tested against brute force.
"""

from __future__ import annotations

from rosterline.llm.op5_secrets import BASE, EXTRA

WORDS = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# SQL folds more letters than A-Z when told to ignore case, so both cases are spelled out.
NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token"))
API_KEY = _either_case("api") + "_?" + _either_case("key")
ASSIGN = rf"({NAMES}|{API_KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PATTERNS = {"assign": ASSIGN} | {rule.kind: rule.pattern for rule in (*BASE[1:], *EXTRA)}

_MARKED = " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, string_split(regexp_replace(t,"
    rf" {_quoted('(' + pattern + ')')}, chr(1) || '\1' || chr(1), 'g'), chr(1)) AS p FROM texts"
    for rank, (kind, pattern) in enumerate(PATTERNS.items())
)
_WRITTEN = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank)"
SECRETS = f"""
WITH texts AS (SELECT doc_id, translate(coalesce(text, ''), chr(1), chr(3)) AS t FROM documents),
marked AS ({_MARKED}),
pieces AS (SELECT doc_id, kind, rank, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM marked WHERE len(p) > 1),
placed AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM pieces),
spans AS (
  SELECT doc_id, kind, rank, CAST(e - length(piece) AS BIGINT) AS b, CAST(e AS BIGINT) AS e FROM placed
  WHERE i % 2 = 0 AND CASE kind WHEN 'assign' THEN length(regexp_extract(piece, {_quoted(ASSIGN)}, 2)) >= 8
    WHEN 'access' THEN length(piece) >= 16 ELSE true END
)
SELECT d.doc_id, count(kind) FILTER (kind = 'assign') AS n_assign, count(kind) FILTER (kind = 'access') AS n_access,
  count(kind) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce({_WRITTEN} FILTER (rank < 3), '')) AS base_sha256, coalesce({_WRITTEN} FILTER (kind IS NOT NULL), '') AS spans
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""

REPEATS = f"""
WITH lists AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(string_agg(word, ' ') OVER part) AS h, count(*) OVER part AS n FROM words
  WINDOW part AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
),
twice AS MATERIALIZED (SELECT h FROM windows WHERE n = 35 GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows WHERE n = 35 AND h IN (SELECT h FROM twice)
),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE lists AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '{WORDS}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM lists),
runs AS (
  SELECT doc_id, i, n, string_agg(word, ' ') OVER part AS shingle, count(*) OVER part AS size FROM words
  WINDOW part AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, shingle FROM runs WHERE size = 5 OR (n < 5 AND i = 1)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.shingle = b.shingle
  AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
unit AS MATERIALIZED (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM good),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.95
),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
),
linked AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reached LEFT JOIN linked USING (vec_id) GROUP BY vec_id
"""




def _crc32(octets: str) -> str:
    """The checksum of a list of octets: each is put in, then eight bits are shifted out."""
    steps = f"flatten(list_transform({octets}, lambda o: [o, 256, 256, 256, 256, 256, 256, 256, 256]))"
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    folded = f"list_reduce(list_concat([4294967295], {steps}), lambda c, o: CASE WHEN o < 256 THEN xor(c, o) ELSE {bit} END)"
    return f"xor({folded}, 4294967295)"


def _octets(text: str) -> str:
    """UTF-8 of a text of code points below U+0800."""
    points = f"list_transform(string_split({text}, ''), lambda t: CAST(unicode(t) AS BIGINT))"
    return f"flatten(list_transform({points}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + u // 64, 128 + u % 64] END))"


_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda t: CAST(unicode(t) AS BIGINT))"
PERIODIC = f"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w, {_crc32(_DIGITS)} AS h FROM documents
),
drawn AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM lists),
places AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM drawn),
tails AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM places),
moved AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) END AS w
  FROM tails
),
words AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM moved),
six AS (
  SELECT doc_id, i, md5(string_agg(word, ' ') OVER part) AS g, count(*) OVER part AS n FROM words
  WINDOW part AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)
),
grams AS MATERIALIZED (SELECT doc_id, i, g FROM six WHERE n = 6),
equal AS (
  SELECT doc_id, b.i - a.i AS q, a.i AS i FROM grams a JOIN grams b USING (doc_id, g) WHERE b.i > a.i
),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e FROM islands GROUP BY doc_id, q, island),
runs AS MATERIALIZED (
  SELECT doc_id, s, e, min(q) AS q FROM stretches WHERE e - s >= greatest(12, 2 * q) GROUP BY doc_id, s, e
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS line FROM words
  ANTI JOIN (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM runs) USING (doc_id, i) GROUP BY doc_id
),
summed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    min({{'less': s - e, 'start': s, 'period': q}}) AS best
  FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(-best.less AS BIGINT) AS length,
  CAST(best.period AS BIGINT) AS period, CAST(-1000 * best.less // best.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(line, '')) AS collapsed_sha256
FROM documents LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Letters above ASCII as one octet each, since SQL compares octets.
_ABOVE = "".join(map(chr, range(0xC0, 0x100)))
_OCTETS = "".join(map(chr, [*range(0x21, 0x61), 0x7B])).replace("'", "")
SPELLING = f"""
WITH RECURSIVE listed AS (
  SELECT doc_id, unnest(regexp_extract_all({ASCII_LOWER}, '[a-z{_ABOVE[0]}-{_ABOVE[-1]}]+')) AS run FROM documents
),
runs AS (SELECT doc_id, run, count(*) AS c FROM listed GROUP BY doc_id, run),
drawn AS (SELECT run, c, {_crc32(_octets("doc_id || ':' || run"))} AS h FROM runs),
slipped AS (
  SELECT c, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM drawn
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n, length(word) AS size, translate(word, '{_ABOVE}', '{_OCTETS}') AS octets
  FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
),
near AS (
  SELECT a.word AS word, b.word AS other, b.n AS other_n FROM words a JOIN words b ON a.size = b.size
  WHERE levenshtein(a.octets, b.octets) = 1
  UNION ALL SELECT a.word, b.word, b.n FROM words a JOIN words b ON a.size = b.size + 1
  WHERE levenshtein(a.octets, b.octets) = 1
  UNION ALL SELECT a.word, b.word, b.n FROM words a JOIN words b ON a.size = b.size - 1
  WHERE levenshtein(a.octets, b.octets) = 1
),
best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS best FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * n THEN best.other END AS form,
    CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
  FROM words LEFT JOIN best USING (word)
),
followed AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT f.word, s.form FROM followed f JOIN forms s ON f.root = s.word WHERE s.form IS NOT NULL
),
roots AS (SELECT word, root FROM followed JOIN (SELECT word AS root, form AS onward FROM forms) USING (root) WHERE onward IS NULL)
SELECT word, form, root, n, n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN roots USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_product_quantisation": VECTORS,
        "op5_trigram_index": SECRETS,
        "op6_suffix_automata": REPEATS,
        "op7_multi_order": JACCARD,
        "op11_scale_tiles": PERIODIC,
        "op13_reduced_alphabet": SPELLING,
    }
