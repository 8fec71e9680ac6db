"""Token counts: exact counts at every prefix of a text, by dynamic programming.

For byte pair merging, the last token of a prefix is unique: it is the one token that ends
there and is stable beside the last token of the prefix it leaves. (Two tokens are stable
side by side when merging their joined bytes gives the two again.) So one pass over a text
yields the count at each of its prefixes, and questions about truncation or a budget are
answered from the stored counts without encoding anything again.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import islice
from operator import sub

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The pieces a byte-level tokenizer cuts text into, a white space run taken
# together with the piece after it. A contraction counts only where no blank precedes it.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SPACE = r"\p{White_Space}"
UNIT = regex.compile(
    rf"{SPACE}*(?:(?<! )(?:{'|'.join(CONTRACTIONS)})|\p{{L}}+|\p{{N}}+|[^{SPACE}\p{{L}}\p{{N}}]+)|{SPACE}+"
)
LEADING_SPACE = regex.compile(rf"{SPACE}*")
# The same white space for the faster standard module; a phrase, up to the next white space,
# is whole units.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PHRASE = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")

LONG_UNIT = 48  # characters; longer units and phrases rarely come again
CACHED_UNITS = 200_000
SHARED_LENGTH = 8  # bytes of a prefix that many pieces begin with
SHARED_PREFIXES = 400_000
CACHED_PAIRS = 1_000_000
PHRASES_AT_ONCE = 100_000
DOCS_AT_ONCE = 256


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: the printable Latin-1
    characters stand for themselves, the other bytes for 256, 257 and so on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def recall(cache: dict[str, bytes], key: str, work: Callable[[str], bytes]) -> bytes:
    """The remembered work for a key; a full cache starts anew."""
    if (found := cache.get(key)) is None:
        found = work(key)
        if len(key) <= LONG_UNIT:
            if len(cache) >= CACHED_UNITS:
                cache.clear()
            cache[key] = found
    return found


class PrefixCounter:
    """Counts the tokens of every prefix under one byte-level merge vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()

        def raw(shown: str) -> bytes:
            return bytes(alphabet[c] for c in shown)

        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.vocabulary = {raw(t) for t in spec["model"]["vocab"] if t not in set(self.specials)}
        self.longest = max(map(len, self.vocabulary))
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.units: dict[str, bytes] = {}
        self.phrases: dict[str, bytes] = {}
        self.shared: dict[bytes, int] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """Plain merging, lowest rank first; used on two joined tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [self.ranks.get(p, len(self.ranks)) for p in zip(parts, parts[1:])]
            least = min(ranked)
            if least == len(self.ranks):
                break
            at = ranked.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stable(self, left: bytes, right: bytes) -> bool:
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def byte_counts(self, piece: bytes) -> list[int]:
        """Tokens of each byte prefix of one piece, the empty one first."""
        last, counts, shared = [b""], [0], self.shared
        if len(shared) >= SHARED_PREFIXES:
            shared.clear()
        for end in range(1, len(piece) + 1):
            if end > SHARED_LENGTH:
                start = self.last_start(piece, end, last)
            elif (start := shared.get(prefix := piece[:end])) is None:
                start = shared[prefix] = self.last_start(piece, end, last)
            last.append(piece[start:end])
            counts.append(counts[start] + 1)
        return counts

    def last_start(self, piece: bytes, end: int, last: list[bytes]) -> int:
        """Where the last token of a prefix starts, given those of the shorter prefixes."""
        # Often the token before has grown by the byte; only one token can end here.
        guess = end - 1 - len(last[-1])
        for start in (guess, *range(max(0, end - self.longest), end)):
            token = piece[start:end]
            if token in self.vocabulary:
                if start == 0:
                    return start
                fits = self.pairs.get((last[start], token))
                if self.stable(last[start], token) if fits is None else fits:
                    return start
        raise ValueError("the vocabulary lacks a byte")

    def counts(self, piece: str) -> list[int]:
        """Tokens of each character prefix of one piece, the empty one first."""
        data = piece.encode()
        every = self.byte_counts(data)
        if len(data) == len(piece):
            return every
        return [every[0]] + [every[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit. A trailing white space run is one piece; once
        something follows, its last character is cut off and leads the next piece if blank."""
        lone = not unit[1:2].isspace() if unit[0] == " " else not unit[0].isspace()
        if lone and unit not in CONTRACTIONS:  # the common case, one piece
            return self.counts(unit)
        space = LEADING_SPACE.match(unit).end()
        counts = self.counts(unit[:space])
        body = unit[space:]
        if not body:
            return counts
        if space and unit[space - 1] == " ":
            base, following = counts[space - 1], self.counts(" " + body)[2:]
        else:
            base = counts[space - 1] + self.counts(unit[space - 1])[-1] if space else 0
            following = self.counts(body)[1:]
            if body in CONTRACTIONS:  # until complete, an apostrophe and letters
                following[1:-1] = [following[0] + n for n in self.counts(body[1:-1])[1:]]
        return counts + [base + n for n in following]

    def unit_steps(self, unit: str) -> bytes:
        """Change of the count with each character of a unit, as 16 bit numbers."""
        counts = self.unit_counts(unit)
        steps = array("h", map(sub, counts[1:], counts))
        if sys.byteorder == "big":
            steps.byteswap()
        return steps.tobytes()

    def phrase_steps(self, phrase: str) -> bytes:
        return b"".join([recall(self.units, u, self.unit_steps) for u in UNIT.findall(phrase)])

    def plain_steps(self, text: str) -> bytes:
        """Steps of a text without special tokens."""
        known, phrases, work = self.phrases.get, self.phrases, self.phrase_steps
        if len(text) <= 4 * PHRASES_AT_ONCE:
            return b"".join([known(p) or recall(phrases, p, work) for p in PHRASE.findall(text)])
        found, parts = PHRASE.finditer(text), []
        while some := [m.group() for m in islice(found, PHRASES_AT_ONCE)]:
            parts.append(b"".join([recall(phrases, p, work) for p in some]))
        return b"".join(parts)

    def steps(self, text: str) -> bytes:
        """Steps of a whole text. A special token's string is ordinary text until its last
        character makes it one token and ends the piece before it."""
        if self.special is None or not self.special.search(text):
            return self.plain_steps(text)
        parts, at = [], 0
        for found in self.special.finditer(text):
            before = total(self.plain_steps(text[at : found.start()]))
            almost = self.plain_steps(text[at : found.end() - 1])
            parts += [almost, np.array([before + 1 - total(almost)], "<i2").tobytes()]
            at = found.end()
        return b"".join([*parts, self.plain_steps(text[at:])])


def total(steps: bytes) -> int:
    return int(np.frombuffer(steps, "<i2").sum(dtype=np.int64))


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter per worker process, so that its caches serve all its tasks."""
    return PrefixCounter(path)


def prefix_batches(
    batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema, stored: bool
) -> Iterator[pa.RecordBatch]:
    count = counter(path)
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            part = batch.slice(at, DOCS_AT_ONCE)
            steps = [count.steps(t) if t else b"" for t in part.column(1).to_pylist()]
            columns = [part.column(0), pa.array(map(total, steps), pa.int64())]
            if stored:
                columns.append(pa.array(steps, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def token_prefixes(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", stored: bool = True
) -> DataFrame:
    """One row per input row: id, `n_tokens`, and the prefix table `steps` if `stored`.

    `tokenizer` is the path of a byte-level merge vocabulary (.json) on every node. `steps`
    holds, for each character, by how much it changes the count of the text up to it, as
    little-endian 16 bit numbers; `tokens_at` and `fitting_prefix` answer from it. Counts
    are those of the tokenizer's library without added tokens; strings of special tokens in
    a text are one token each. Whole texts are read, in one pass and without a shuffle.

    Null and empty texts have 0 tokens and an empty table. Repeated rows repeat their
    result; other columns are not read; an empty table gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())]
    if stored:
        fields.append(T.StructField("steps", T.BinaryType()))
    schema = T.StructType(fields)
    work = partial(prefix_batches, path=tokenizer, schema=to_arrow_schema(schema), stored=stored)
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, schema)


@F.pandas_udf(T.LongType())
def tokens_at(steps: pd.Series, characters: pd.Series) -> pd.Series:
    """Tokens of the first `characters` characters; more than there are counts all."""
    return pd.Series(
        [total(s[: 2 * max(0, int(n))]) for s, n in zip(steps, characters, strict=True)], dtype="int64"
    )


@F.pandas_udf(T.LongType())
def _fitting(steps: pd.Series, budget: pd.Series) -> pd.Series:
    def longest(changes: bytes, most: int) -> int:
        counts = np.frombuffer(changes, "<i2").cumsum(dtype=np.int64)
        fits = np.flatnonzero(counts <= most)
        return int(fits[-1]) + 1 if len(fits) else 0

    return pd.Series([longest(s, b) for s, b in zip(steps, budget, strict=True)], dtype="int64")


def fitting_prefix(steps: Column, budget: int) -> Column:
    """Characters of the longest prefix of at most `budget` tokens."""
    return _fitting(steps, F.lit(budget))
