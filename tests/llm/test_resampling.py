"""Weights, scores and ranks against a plain loop; the parallel sort on many segments and ties."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import floor, log
from zlib import crc32

import numpy as np
import pytest

from doseline.llm import resampling


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, longest):
    own = words(text)
    return [" ".join(own[at : at + n]) for n in range(1, longest + 1) for at in range(len(own) - n + 1)]


def plain(rows, targets, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    def count(texts):
        return Counter(crc32(f.encode()) % buckets for text in texts for f in features(text, longest))

    s, t = count(x for _, x in rows), count(targets)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [
        floor(1000 * log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)
    ]
    out = []
    for name, text in rows:
        own = features(text, longest)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'null' if name is None else name}".encode()).hexdigest()[:8], 16)
        out.append([name, len(own), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(many, seed=5):
    draw = np.random.default_rng(seed)
    stock = [f"{w}{e}" for w in ("Alpha", "beta", "Éta", "gamma9", "日本", "x") for e in ("", "1", "s", "-y", "'z")]
    rows = [(int(d), " ".join(draw.choice(stock, draw.integers(0, 60)))) for d in range(many)]
    return rows + [(None, " ".join(["Alpha"] * 30))] * 40 + [(3, "beta " * 25)] * 3 + [(many, None), (many + 1, "")]


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (2, 55), (3, 100)])
def test_equals_plain_loop(spark, monkeypatch, longest, percent):
    monkeypatch.setattr(resampling, "ROWS_SQUARED", 2)  # so that the sort has a dozen segments
    rows = corpus(400)
    targets = ["alpha beta éta", "Éta éta 日本", None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    aimed = spark.createDataFrame([(t,) for t in targets], "text string")
    got = resampling.resample(docs, aimed, longest=longest, percent=percent, buckets=500).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, targets, longest, 500, percent=percent)


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_segments_are_even_in_spite_of_ties(spark, partitions):
    """All rows share one score and id; runs and places still part them."""
    frame = spark.range(20_000).selectExpr("0L AS score", "CAST(NULL AS long) AS _id", "1L AS n_features", "true AS _drawable")
    runs = resampling.sorted_runs(frame.repartition(partitions))
    splitters = resampling.splitters_of(runs, 20_000, 8)
    assert len(splitters) == 7
    rows = [resampling.order_key((r.score, r._id, r.n_features, r._run, r._place)) for r in runs.collect()]
    sizes = Counter(sum(s < r for s in splitters) for r in rows)
    assert len(sizes) == 8 and max(sizes.values()) < 2 * 20_000 / 8
    ranks = resampling.ranks(runs, 20_000, 20_000).collect()
    assert sorted(r["rank"] for r in ranks) == list(range(1, 20_001))


def test_odd_rows(spark):
    rows = [(1, "word " * 200_000, 9), (2, None, 9), (2, "a b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _run int")
    nothing = spark.createDataFrame([], "text string")
    got = resampling.resample(docs, nothing, percent=100).collect()
    assert sorted(map(tuple, got), key=str) == plain([r[:2] for r in rows], [], percent=100)
    assert resampling.resample(docs.limit(0), nothing).count() == 0
    names = spark.createDataFrame([("b", "x " * 20), ("a", "x " * 20), (None, "x " * 20)], "score string, rank string")
    got = resampling.resample(names, names, "score", "rank", "rank", percent=100)
    assert got.columns[0] == "score" and sorted(r["rank"] for r in got.collect()) == [1, 2, 3]
