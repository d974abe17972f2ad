"""BPE encoding and decoding by a contiguous array of adjacent ranks.

A word is held as its part boundaries, the ids between them and, for each pair of
neighbours, the rank of the merge that would join them. The smallest rank is found by
scanning the array, its boundary is deleted and the two neighbouring ranks are looked
up again. Scanning beats a heap while words are short; words above `SCAN_LIMIT`
symbols take a heap, with the same merges.

Normalising and splitting into words is left to the library that defines them. Neither
crosses ASCII white space, so a text is encoded chunk by chunk and chunks that come
again are looked up.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rosterline.llm.common import folded_chunks, utf8

SCAN_LIMIT = 128
NO_MERGE = 1 << 60


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it shows, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


# Up to Latin Extended-B a word is written in byte letters by a table; what lies above, or
# does not show, is left to the library.
PLAIN_BELOW = "\u0250"
_LETTERS = _byte_letters()
BYTE_LETTERS = {c: "".join(_LETTERS[b] for b in chr(c).encode()) for c in range(0x21, ord(PLAIN_BELOW))}


class WordBpe:
    """Vocabulary and merges of a tokenizers file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        found = "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.special_split = re.compile(f"({found})") if found else None
        self.special_bytes = [t.encode() for t in self.special]
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[self.vocab[left], self.vocab[right]] = rank
            self.merged.append(self.vocab[left + right])

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word of the splitter."""
        symbols = [*word[:-1], word[-1] + self.end] if word else []
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        return self._scan(ids) if len(ids) <= SCAN_LIMIT else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        rank_of = self.ranks.get
        ranks = [rank_of(pair, NO_MERGE) for pair in zip(ids, ids[1:], strict=False)]
        bounds = list(range(len(ids) + 1))
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            i = ranks.index(least)
            ids[i] = self.merged[least]
            del ids[i + 1], bounds[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), NO_MERGE)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), NO_MERGE)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        rank_of = self.ranks.get
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        queue = [(rank_of(pair, NO_MERGE), i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False))]
        queue = [x for x in queue if x[0] != NO_MERGE]
        heapq.heapify(queue)
        gone = [False] * len(ids)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if gone[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = self.merged[rank], True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    pair = ids[k], ids[after[k]]
                    if pair in self.ranks:
                        heapq.heappush(queue, (self.ranks[pair], k, *pair))
        return [x for x, dead in zip(ids, gone, strict=True) if not dead]

    def chunk_words(self, chunk: bytes) -> list[str]:
        """The words of a text without ASCII white space inside, and special tokens, in order."""
        if chunk.isalpha():  # ASCII letters only
            return [chunk.lower().decode()]
        text = chunk.decode("utf-8", "replace")
        parts = [text]
        if self.special_split and any(t in chunk for t in self.special_bytes):
            parts = self.special_split.split(text)
        words: list[str] = []
        for part in parts:
            if part in self.special:
                words.append(part)
            elif part:
                clean = self.normalizer.normalize_str(part)
                if clean.isprintable() and max(clean) < PLAIN_BELOW:
                    words += [w.translate(BYTE_LETTERS) for w in self.split.findall(clean)]
                else:
                    words += [w for w, _ in self.pre_tokenizer.pre_tokenize_str(clean)]
        return words

    def ids_of(self, word: str) -> list[int]:
        """Ids of a word or special token of `chunk_words`."""
        return [self.special[word]] if word in self.special else self.word_ids(word)

    def encode(self, text: str) -> list[int]:
        return [i for chunk in text.encode().split() for w in self.chunk_words(chunk) for i in self.ids_of(w)]

    def decode(self, ids: list[int]) -> str:
        """As the library does for a file without a decoder: tokens joined by a space."""
        return " ".join(self.token_of[i] for i in ids)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


# Chunks and words that a Python worker remembers; their number and length bound its memory.
REMEMBERED, LONGEST_REMEMBERED = 800_000, 64
_remembered: dict[str, tuple[dict, dict]] = {}


def _text_of(bpe: WordBpe, chunk: bytes, known: dict[str, tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    """Ids of a chunk and its tokens, both as text."""
    parts = []
    for word in bpe.chunk_words(chunk):
        part = known.get(word)
        if part is None:
            ids = bpe.ids_of(word)
            part = (" ".join(map(str, ids)).encode(), bpe.decode(ids).encode())
            if len(word) <= LONGEST_REMEMBERED:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[word] = part
        if part[0]:
            parts.append(part)
    if len(parts) == 1:
        return parts[0]
    return b" ".join([p[0] for p in parts]), b" ".join([p[1] for p in parts])


def bpe_digest(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every text and decode it again: (id, n_tokens, ids_sha256, decoded_sha256).

    One row per input row. A null or empty text has no tokens, its digests are those of
    the empty string; ids may be null or repeated. A text is read whole, whatever its
    length. There is no exchange: work follows the partitions of the input.
    """

    def rows(batches):
        bpe = word_bpe(path)
        known, words = _remembered.setdefault(path, ({}, {}))
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in utf8(batch.column(1)):
                chunks = folded_chunks(text)
                parts = list(map(known.get, chunks))
                if None in parts:
                    for at, (chunk, part) in enumerate(zip(chunks, parts, strict=True)):
                        if part is None:
                            part = parts[at] = known.get(chunk) or _text_of(bpe, chunk, words)
                            if len(chunk) <= LONGEST_REMEMBERED:
                                if len(known) >= REMEMBERED:
                                    known.clear()
                                known[chunk] = part
                    if (b"", b"") in parts:
                        parts = [p for p in parts if p[0]]
                ids = b" ".join([p[0] for p in parts])
                counts.append(ids.count(b" ") + 1 if ids else 0)
                encoded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(b" ".join([p[1] for p in parts])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(rows, schema).withColumnRenamed("id", id_column)
