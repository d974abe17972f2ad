"""Word expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of letters, numbers and underscores in any script.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def words(text: Column) -> Column:
    """Upper-cased words of a text, as an array in reading order."""
    return F.regexp_extract_all(F.upper(text), F.lit(WORD_PATTERN), F.lit(0))
