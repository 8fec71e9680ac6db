"""Substring dedup against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from doseline.llm import substring_dedup as sub
from doseline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(docs: list[tuple], window: int = 13) -> list[tuple]:
    """(id, n_words, n_removed, kept words) by comparing every window."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    order = [float("inf") if i is None else i for i, _ in split]
    least: dict[tuple, float] = {}
    for o, (_, w) in zip(order, split):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(o, least.get(key, o))
    out = []
    for o, (i, w) in zip(order, split):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < o:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def hashed(rows):
    return sorted((-1 if i is None else i, n, r, hashlib.sha256(t.encode()).hexdigest()) for i, n, r, t in rows)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op5_substring_dedup"](spark, SMALL).collect()]
    assert sorted(got) == hashed(plain(docs))
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("chunk", [1, 500, 1 << 20])
def test_factors_of_random_texts(spark, seed, chunk):
    """Through the task functions, in chunks of any size, so that ties and overlaps abound."""
    draw = np.random.default_rng(seed)
    words = ["a", "bé", "c\x85", "dd"]
    docs = [(int(draw.integers(0, 60)), " ".join(draw.choice(words, draw.integers(0, 40)))) for _ in range(60)]
    docs = list(dict(docs).items()) + [(None, docs[0][1]), (None, docs[0][1])]
    docs += docs[:3]
    own = np.array([sub.NO_ID if i is None else i for i, _ in docs])
    texts = [t.encode() for _, t in docs]
    batch = sub.pa.RecordBatch.from_arrays([sub.pa.array([i for i, _ in docs], sub.pa.int64()), sub.pa.array(texts)], names=["i", "t"])
    old, sub.CHUNK_BYTES = sub.CHUNK_BYTES, chunk
    try:
        asked = sub.pa.Table.from_batches(sub.ask_batches(iter([batch]), 4, 3)).sort_by("block")
    finally:
        sub.CHUNK_BYTES = old
    found = sub.pa.Table.from_batches(sub.match_batches(iter(asked.to_batches(max_chunksize=5)))).to_pydict()
    got = []
    for i, (label, _), t in zip(own, docs, texts):
        keys = np.array([k for o, k in zip(found["id"], found["key"]) if o == i], np.int64)
        n, removed, _, parse, text = sub.cut(t, keys, 4, True)
        assert sum(p["length"] for p in parse) >= removed and all(p["length"] >= 4 for p in parse)
        got.append((label, n, removed, text))
    assert hashed(got) == hashed(plain(docs, 4))


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    long = " ".join(f"w{i}" for i in range(400_000))
    rows = [
        (7, f"x {passage} y", "z"), (3, f"{passage}\n", "z"), (4, None, "z"), (5, "", "z"), (6, " \t", "z"),
        (8, long, "z"), (9, f"{long} {passage} end", "z"), (None, passage, None), (8, long, "z"),
        (10, "same " * 300_000, "z"), (11, " ".join(["same"] * 12), "z"), (12, " ".join(["same"] * 13), "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string, spans string")
    got = sub.drop_repeats(docs)
    assert hashed((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == hashed(
        plain([r[:2] for r in rows])
    )
    assert [tuple(s) for s in got.where("doc_id = 7").first().spans] == [(1, 50)]
    assert sub.drop_repeats(docs.limit(0)).count() == 0


def test_windows_with_one_key_are_told_apart_by_their_words(spark):
    """Thue-Morse words and their opposites have one 64-bit polynomial hash, whatever its base."""
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = morse.translate(str.maketrans("ab", "ba"))
    (one, two), _ = sub.hash_words(f"{morse} {other}".encode())
    assert one == two
    passage = [f"w{i}" for i in range(30)]
    mine, yours = ([*passage[:15], word, *passage[15:]] for word in (morse, other))
    rows = [
        (4, " ".join(mine)), (5, " ".join(yours)), (6, " ".join(["x", *yours, "y"])), (3, " ".join(["z", *yours[9:], "z"])),
        (8, " ".join(mine)), (9, " ".join(mine[3:])), (7, "clean " + " ".join(yours[4:18])), (None, " ".join(yours)),
        (None, " ".join(f"only{i}" for i in range(40))), (6, " ".join(f"more{i}" for i in range(40))),
    ]
    for frame in (spark.createDataFrame(rows, "doc_id long, text string").repartition(n) for n in (1, 7)):
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in sub.drop_repeats(frame).collect()]
        assert hashed(got) == hashed(plain(rows))


def test_a_copy_without_id_leaves_other_rows_without_id_alone(spark):
    copied, clean = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    docs = spark.createDataFrame([(1, copied), (None, copied), (None, clean)], "doc_id long, text string").coalesce(1)
    assert sorted(r.n_removed for r in sub.drop_repeats(docs).collect()) == [0, 0, 20]
