"""Shared lines go from every document; brute force over random texts and odd rows."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from doseline.llm import line_dedup

SPACE = " \t\n\v\f\r"


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, least_chars, least_docs):
    docs = Counter(k for _, text in rows for k in {key(line) for line in (text or "").split("\n")})
    out = []
    for name, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least_chars or docs[key(x)] < least_docs]
        out.append((name, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("least_chars", "least_docs", "broadcast"), [(1, 10, "10m"), (1, 3, "-1"), (0, 4, "10m"), (3, 2, "-1")])
def test_random_texts_equal_brute_force(spark, least_chars, least_docs, broadcast):
    draw = np.random.default_rng(least_docs)
    stock = ["", " ", "a", "Ab ", "\tab\r", "ÄB", "äb", "x ", "long line here", "日本", "  c\vd  ", *(f"line {i}" for i in range(40))]
    rows = [
        (int(d) if d % 7 else None, "\n".join(draw.choice(stock, draw.integers(0, 9)))) for d in range(150)
    ] + [(1, "twice"), (1, "twice"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = line_dedup.drop_shared_lines(docs, least_chars=least_chars, least_docs=least_docs).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, got), key=str) == plain(rows, least_chars, least_docs)
    assert any(r.n_dropped for r in got)


def test_odd_rows(spark):
    common = "Shared line"
    long = "\n".join([common, *(f"own {i}" for i in range(50_000)), common.upper() + " "])
    rows = [(i, common, 1, "x", 2) for i in range(9)] + [(9, long, 1, None, 2), (None, common + "\nmine", 1, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, _places string, _t1 int")
    got = {r.doc_id: r for r in line_dedup.drop_shared_lines(docs).collect()}
    assert (got[0].n_lines, got[0].n_dropped, got[0].kept_text) == (1, 1, "")
    assert (got[9].n_lines, got[9].n_dropped) == (50_002, 2)
    whole = "\n".join(f"own {i}" for i in range(50_000))
    assert hashlib.sha256(got[9].kept_text.encode()).digest() == hashlib.sha256(whole.encode()).digest()
    assert got[None].kept_text == "mine"
    # One document that repeats a line, however often, does not make it shared.
    many = spark.createDataFrame([(1, "\n".join(["same"] * 100))], "doc_id long, text string")
    assert line_dedup.drop_shared_lines(many).first().n_dropped == 0
    assert line_dedup.drop_shared_lines(docs.limit(0)).count() == 0


def test_other_names(spark):
    docs = spark.createDataFrame([("k", "a\nb"), ("l", "A")], "text string, _text string")
    got = line_dedup.drop_shared_lines(docs, id_col="text", text_col="_text", least_docs=2).collect()
    assert sorted(map(tuple, got)) == [("k", 2, 1, "b"), ("l", 1, 1, "")]
