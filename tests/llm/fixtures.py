"""Small tables with what may trip an operator."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, id int, row int"

PASSAGE = " ".join(f"passage{i}" for i in range(60))


def prose(seed: int, n: int) -> str:
    """Made-up words, unlike those of another seed."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def awkward_texts() -> list[str | None]:
    """Null and empty texts, white space, one word, repeats, ties, symbols, long words and texts."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    return [
        None,
        "",
        " \t\n ",
        "word",
        "four words are here",
        "a " * 90,
        "a b " * 60,
        base,
        base,
        " ".join(near),
        base.upper(),
        prose(2, 30) + "\n" + PASSAGE + "\r\n" + prose(3, 40),
        prose(4, 45) + " " + PASSAGE + " " + prose(5, 20),
        PASSAGE,
        "x" * 5000 + " " + "ab" * 3000,
        prose(6, 4000),
        "日本語のテキスト Ελληνικά кириллица naïve café é ẞ   \u0085 🙂🙂",
        "line\nline\n\nline\n#$%&*|<> <|endoftext|> I'll don't \x01 \x03",
        "0" * 400 + " " + "1 " * 300,
    ]


def documents(spark):
    """Awkward texts with null and repeated ids, a row given twice, and clashing column names."""
    texts = awkward_texts()
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "k", 1, 2) for i, t in enumerate(texts)]
    rows.append((None, prose(7, 60), "de", None, None, None, None, None))
    rows.append((None, prose(7, 60), "de", None, None, None, None, None))
    rows.append((7, prose(8, 70), "xx", "s", 1, "k", 1, 2))
    rows.append(rows[11])
    return spark.createDataFrame(rows, SCHEMA), rows


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
