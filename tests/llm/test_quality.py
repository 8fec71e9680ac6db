"""The quality classifier: features against brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from doseline.llm import quality
from doseline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBé \t\n\x85漢", max_size=30))
def test_features_are_words_and_ngrams_of_each_word(text):
    words = text.encode().split()
    grams = [g for w in words for s in ["<" + w.decode() + ">"] for n in (3, 4) for g in (s[i : i + n] for i in range(len(s) - n + 1))]
    again = sum(a == b for a, b in zip(words, words[1:]))
    found = quality.block_features(text.encode())
    assert len(found) == len(words) + len(grams) + again
    tables = np.bincount(found // quality.BUCKETS, minlength=4)
    assert tables.tolist() == [len(words), sum(len(g) == 3 for g in grams), sum(len(g) == 4 for g in grams), again]
    alone = [quality.block_features(w) for w in words]
    assert sorted(found[found != quality.AGAIN]) == sorted(x for a in alone for x in a)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_quality"](spark, SMALL).collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 for d, r in got.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(labels[d], r) for d, r in got.items() if r.held_out and d in labels]
    assert sum(q == r.predicted for q, r in held) / len(held) > 0.95
    good, bad = ([r.score for q, r in held if q == k] for k in (1, 0))
    assert np.mean([[g > b for g in good] for b in bad]) > 0.97


def test_odd_rows(spark):
    rows = [(i, ("good fine text here " if i % 2 else "### &&& !!! ") * 5) for i in range(40)]
    odd = [(100, None), (101, ""), (102, "fine text " * 200_000), (102, "fine text " * 200_000), (None, "### !!!")]
    docs = spark.createDataFrame([(*r, "x") for r in rows + odd], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, None, 0), (None, 1, 0), (5, 7, 0)], "doc_id long, quality int, text int")
    got = [(r.doc_id, r.score) for r in quality.quality_scores(docs, labels).collect()]
    assert len(got) == 45 and all(0 <= s <= 1 for _, s in got)
    by = dict(got)
    assert by[100] == by[101] and by[102] > 0.9 and by[None] < 0.1
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_training_is_repeatable(spark):
    rows = [(i % 2, np.array([i % 7, 9], "<i4"), np.array([0.5, 0.5], "<f4")) for i in range(50)]
    assert (quality.train(rows).pull == quality.train(rows).pull).all()
