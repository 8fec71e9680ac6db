"""Token counts against the tokenizer's library, at every prefix."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from doseline.llm import token_counts
from doseline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
PARTS = [
    "a", "th", "ing", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "<|endoftext|>", "<|endof", "é", "ß", "漢字",
    "1", "23", "!", "...", " ", " ", "🙂", "\x85", "\x1c", "½", "_", " '", "l", "ll",
]


LIBRARY = Tokenizer.from_file(PATH)


def size(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), st.text(max_size=20)))
def test_every_prefix_has_the_library_count(text):
    steps = np.frombuffer(token_counts.counter(PATH).steps(text), "<i2")
    assert [0, *steps.cumsum().tolist()] == [size(text[:i]) for i in range(len(text) + 1)]


def test_every_token_is_its_own_encoding():
    count = token_counts.counter(PATH)
    assert all(count.byte_counts(t)[-1] == 1 for t in count.vocabulary)


def test_query_equals_the_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op1_token_counts"](spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        n = size(docs[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "word " * 200_000, "x"), (3, "word " * 200_000, "x"), (None, "a b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(tuple(r) for r in token_counts.token_prefixes(docs, PATH, stored=False).na.fill(-1).collect())
    assert got == [(-1, 2), (1, 0), (2, 0), (3, 200_001), (3, 200_001)]
    assert token_counts.token_prefixes(docs.limit(0), PATH).count() == 0


def test_questions_are_answered_from_the_table(spark):
    text = "Der schnelle Fuchs, it's a  test.\n\nDone <|endoftext|> again"
    table = token_counts.token_prefixes(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH)
    for n in (0, 5, 19, len(text), 999):
        (row,) = table.select(token_counts.tokens_at("steps", token_counts.F.lit(n)).alias("n")).collect()
        assert row.n == size(text[:n])
    for budget in (0, 1, 7, 999):
        (row,) = table.select(token_counts.fitting_prefix(table.steps, budget).alias("n")).collect()
        assert row.n == max(i for i in range(len(text) + 1) if size(text[:i]) <= budget)
