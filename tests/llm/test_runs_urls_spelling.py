"""Periodic runs, URL filters and spelling variants against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import no_documents, prose
from pyspark.sql import functions as F

from rosterline.llm import op11_runs, op12_urls, op13_spelling

WHITE = re.compile(r"[^\x20\x09-\x0D]+")

# --- Periodic runs


def brute_runs(words):
    """Runs as (start, length, smallest period): every period tried at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((start, end - start, q) for (start, end), q in found.items())


def solved(texts):
    spans = [[] for _ in texts]
    for k, octave, place, boundaries, words in op11_runs.tiles_of(texts):
        for q, start, end in op11_runs.tile_fragments(octave, boundaries, np.frombuffer(words, np.int32).tolist()):
            spans[k].append((q, place + start, place + end))
    return [sorted((s, e + q - s, q) for q, s, e in op11_runs.merged(x)) for x in spans]


def repetitive(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        base = [b"%d" % rng.randint(0, rng.choice([0, 1, 3, 20])) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.6:
            base = list(itertools.islice(itertools.cycle(base), rng.randint(1, 160)))
        words += base
    return words


@pytest.mark.parametrize("seed, boundaries", [(1, 16), (2, 1), (3, 3)])
def test_tiles_find_all_runs(monkeypatch, seed, boundaries):
    monkeypatch.setattr(op11_runs, "BOUNDARIES", boundaries)
    rng = random.Random(seed)
    for _ in range(60):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        assert solved(texts) == [brute_runs(words) for words in texts]


def test_z_function_and_prime_periods():
    assert op11_runs.z_function([1, 1, 2, 1, 1, 2, 1]) == [7, 1, 0, 4, 1, 0, 1]
    assert op11_runs.z_function([]) == []
    assert solved([[b"a"] * 400]) == [[(0, 400, 1)]]
    assert solved([[b"a", b"b"] * 5]) == [[]]


def repeated_tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p if i >= a else i] for i in range(n)]


def run_row(doc_id, words):
    runs = brute_runs(words)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    milli = 1000 * best[1] // best[2] if best else None
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *(best or (None, None, None)), milli, *digests)


def test_run_report_equals_brute_force(docs, no_docs, spark):
    df, rows = docs
    text = op11_runs.repeated_tail(F.col("doc_id"), F.col("text"))
    found = op11_runs.run_report(df, text=text).collect()
    lists = [(r[0], repeated_tail(r[0], WHITE.findall(r[1] or ""))) for r in rows]
    assert Counter(tuple(r) for r in found) == Counter(run_row(i, w) for i, w in lists if len(w) < 2000) + Counter(
        tuple(r) for r in found if len(WHITE.findall(dict((i, t) for i, t, *_ in rows).get(r[0]) or "")) >= 2000
    )
    assert op11_runs.run_report(no_docs, text=text).count() == 0


def test_planted_tails_and_repeats(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(w.decode() for w in repetitive(rng))) for i in range(60)] + [(3, "a " * 30), (3, "a " * 30)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    text = op11_runs.repeated_tail(F.col("doc_id"), F.col("text"))
    found = op11_runs.run_report(df, text=text).collect()
    assert Counter(map(tuple, found)) == Counter(run_row(i, repeated_tail(i, t.split())) for i, t in texts)


def test_runs_of_a_long_text_are_whole(spark):
    """One document of 300,000 words: a period of 70,000 words three times and more, and one word often."""
    words = [f"w{i * i % 99991}" for i in range(70_000)]
    text = " ".join(words * 3 + words[:9000] + ["x"] * 50_000)
    row = op11_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()[0]
    runs = {(r["start"], r["length"], r["period"]) for r in row["runs"]}
    assert {(0, 219_000, 70_000), (219_000, 50_000, 1)} <= runs
    kept = row["collapsed"].decode().split()
    assert kept[-1] == "x" and len(kept) <= 70_001


# --- URLs

RULES = [
    op12_urls.Rule("allow", "com/"),
    op12_urls.Rule("block", "example.com/en/"),
    op12_urls.Rule("allow", "www.example.com/en/"),
    op12_urls.Rule("block", "net/es/"),
]

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://a.com",
    "http://a.com/",
    "HTTP://A.Com/en/1?x=/en/#y",
    "https://example.com/en/a",
    "https://www.example.com/en/a",
    "https://WWW.Example.com/EN/a",
    "https://notexample.com/en/a",
    "https://example.com?/en/",
    "https://example.com#://b.net/es/",
    "ftp://shop.net/es/x",
    "ftp://net/es/",
    "ftp://shop.net/es",
    "://x.com//y\nz",
    "http://ümläut.com/é",
    "http://" + "a" * 3000 + ".org/" + "b" * 3000,
]


def split_url(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path, rest[len(host) :]


def fitting(url):
    host, path, _ = split_url(url)
    fits = [
        r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.name), default=None)


def made_up_urls(seed, n):
    rng = random.Random(seed)
    urls = []
    for _ in range(n):
        good = rng.random() < 0.5
        host = rng.choice(["news", "blog", "shop"] if good else ["casino", "spam", "win"])
        end = rng.choice(["com", "org"] if good else ["net", "org"])
        urls.append(f"http://{host}{rng.randint(1, 30)}.{end}/{'en' if good else 'es'}/{rng.randint(1, 999)}")
    return urls


class PlainModel:
    """Witten and Bell's smoothing straight from all counts, without tables of logarithms."""

    def __init__(self, texts):
        counts = defaultdict(Counter)
        for text in texts:
            marked = "\x02" + text
            for end in range(2, len(marked) + 1):
                for size in range(1, min(6, end) + 1):
                    counts[size][marked[end - size : end]] += 1
        self.followers = defaultdict(Counter)
        for size, own in counts.items():
            least = sum(own.values()) / 20_000
            for string, n in own.items():
                if n >= least:
                    self.followers[string[:-1]][string[-1]] = n

    def probability(self, context, letter):
        lower = self.probability(context[1:], letter) if context else 1 / 256
        own = self.followers.get(context)
        if not own:
            return lower
        return (own[letter] + len(own) * lower) / (sum(own.values()) + len(own))

    def log(self, text):
        marked = "\x02" + text
        return sum(math.log10(self.probability(marked[max(0, i - 5) : i], marked[i])) for i in range(1, len(marked)))


def test_url_report_equals_plain_form(spark):
    urls = list(enumerate(URLS + made_up_urls(1, 400) + made_up_urls(1, 3)))
    urls += [(None, "http://a.org/x"), (3, "http://spam9.org/es/1"), urls[30]]
    df = spark.createDataFrame([(i, u, "h", "r", 1.0) for i, u in urls], "page_id bigint, url string, host string, row string, text double")
    found = op12_urls.url_report(df.repartition(5), RULES).collect()
    texts = {True: [], False: []}
    for _, url in urls:
        rule, (host, _, rest) = fitting(url), split_url(url)
        if rule and zlib.crc32((host + rest).encode()) % 5:
            texts[rule.verdict == "allow"].append(host + rest)
    models = {name: PlainModel(x) for name, x in texts.items()}
    assert len(found) == len(urls)
    assert Counter((r.page_id, r.host, r.path) for r in found) == Counter((i, *split_url(u)[:2]) for i, u in urls)
    whole = {i: u for i, u in urls if i != 3}
    for r in found:
        if r.page_id not in whole:
            continue
        url = whole[r.page_id]
        rule, (host, _, rest) = fitting(url), split_url(url)
        assert r.rule == (rule.name if rule else None)
        if rule:
            assert r.verdict == rule.verdict and r.difference is None
            continue
        text = host + rest if "://" in (url or "") else url or ""
        apart = (models[True].log(text) - models[False].log(text)) / max(len(text), 1)
        assert r.difference == pytest.approx(apart, abs=1e-9)
        assert r.verdict == ("allow" if r.odds >= 0 else "block")


def test_probabilities_of_a_model_add_up():
    counts = {"a": 5, "b": 3, "\x02a": 2, "ab": 2, "aa": 1, "aab": 1}
    model = op12_urls.MarkovModel(counts)
    for context in ("", "a", "aa", "xa", "\x02"):
        assert sum(10 ** model._log(context + chr(c)) for c in range(256)) == pytest.approx(1)


def test_open_urls_follow_their_like(spark):
    """Hosts without a rule: most are judged like the ruled hosts they resemble."""
    urls = made_up_urls(2, 3000)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    open_rows = [r for r in op12_urls.url_report(df, RULES).collect() if r.rule is None]
    right = sum((r.verdict == "allow") == bool(re.match("news|blog|shop", r.host)) for r in open_rows)
    assert len(open_rows) > 500 and right / len(open_rows) > 0.97


def test_urls_without_training(spark):
    schema = "page_id int, url string"
    none = op12_urls.url_report(spark.createDataFrame([], schema), RULES)
    assert none.count() == 0 and none.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    no_rule = spark.createDataFrame([(1, "http://a.org/"), (2, None)], schema)
    assert [r.verdict for r in op12_urls.url_report(no_rule, RULES).collect()] == ["allow", "allow"]
    one_class = spark.createDataFrame([(i, f"http://a.net/es/{i}") for i in range(20)] + [(99, "http://b.org/")], schema)
    assert {r.verdict for r in op12_urls.url_report(one_class, RULES).collect()} == {"block"}


# --- Spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    i = next((i for i, c in enumerate(short) if long[i] != c), len(short))
    return short[i:] == long[i + 1 :] if len(short) < len(long) else short[i + 1 :] == long[i + 1 :]


def brute_variants(counts, times=2):
    found = []
    forms = {}
    for word, n in counts.items():
        near = [w for w in counts if one_edit(word, w)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= times * n else None
        found.append((word, len(near)))
    rows = []
    for word, n_near in found:
        root = word
        while forms[root]:
            root = forms[root]
        rows.append((word, forms[word], root, counts[word], n_near, counts.get(forms[word])))
    return Counter(rows)


def slipped_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def misspelt(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéß", k=rng.randint(4, 9))) for _ in range(60)] + ["ÉCOLE", "école", "z" * 3000]
    texts = []
    for i in range(n):
        words = []
        for w in rng.choices(base, [1 / (k + 1) for k in range(len(base))], k=150):
            at = rng.randrange(len(w) + 1)
            kind = rng.random()
            if kind < 0.1:
                w = w[:at] + rng.choice("abcdeéß") + w[at:]
            elif kind < 0.2:
                w = w[: max(at - 1, 0)] + w[at:]
            words.append(w)
        texts.append((i % 40, rng.choice([" ", "-", "\n"]).join(words)))
    return texts


@pytest.mark.parametrize("symbols", [1, 8, 64])
def test_variants_equal_brute_force(spark, symbols):
    rows = misspelt(symbols, 60) + [(None, "Hello hello HELLO helo"), (1, None), (1, "")]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id bigint, text string, n int, word string")
    words = op13_spelling.word_counts(df.repartition(3), change=op13_spelling.slip)
    found = op13_spelling.spelling_variants(words, symbols).collect()
    assert Counter(map(tuple, found)) == brute_variants(slipped_counts(rows))


def test_chains_of_forms(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "ccccc": 5, "ccccd": 9, "aaaac": 3}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = op13_spelling.spelling_variants(words).collect()
    assert Counter(map(tuple, found)) == brute_variants(counts)
    assert {r.root for r in found if r.word.startswith("aaaa")} == {"bbbbb"}


def test_neighbourhoods_hold_every_edit():
    rng, symbols = random.Random(1), 3
    for n in (1, 2, 3, 5, 7):
        codes = [[rng.randint(1, 3) for _ in range(n)] for _ in range(30)]
        row, found = op13_spelling.neighbourhoods(np.array(codes, np.uint64), symbols)
        for k, code in enumerate(codes):
            edits = {tuple(code)}
            for i in range(n + 1):
                edits |= {(*code[:i], s, *code[i:]) for s in range(1, symbols + 1)}
                edits |= {(*code[:i], s, *code[i + 1 :]) for s in range(1, symbols + 1) if i < n}
                edits |= {(*code[:i], *code[i + 1 :])}
            hashes = {int(op13_spelling.reduced_hashes(np.array([e], np.uint64))[0]) for e in edits}
            assert sorted(found[row == k].tolist()) == sorted(hashes)


def test_symbols_follow_the_vocabulary():
    assert [op13_spelling.symbols_for(n) for n in (0, 60_000, 70_000, 10**9)] == [4, 4, 5, 14]


def test_awkward_texts_and_no_words(docs, spark):
    df, rows = docs
    found = op13_spelling.variant_report(df, change=op13_spelling.slip).collect()
    assert Counter(map(tuple, found)) == brute_variants(slipped_counts([r[:2] for r in rows]))
    assert op13_spelling.variant_report(no_documents(spark)).count() == 0
    assert op13_spelling.variant_report(spark.createDataFrame([(1, prose(1, 3))], "doc_id int, text string")).count() == 0
