"""Spaced seeds find every overlap with few substitutions; the plan stays native."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from doseline.llm import decontamination as deco


def test_masks_hit_every_overlap():
    for n in range(deco.LEAST_WORDS, deco.WINDOW + 1):
        for off in combinations(range(n), max(0, (n - 3) // 5)):
            assert any(
                all(at + k not in off for k in mask) for mask in deco.MASKS for at in range(n - mask[-1])
            ), (n, off)


def plain(docs, items):
    out = {}
    for d, words in docs:
        for i, item in items:
            win = min(13, len(item))
            for s in range(len(item) - win + 1):
                for at in range(len(words) - win + 1):
                    same = sum(a == b for a, b in zip(words[at : at + win], item[s : s + win]))
                    if same >= win - max(0, (win - 3) // 5):
                        out[d, i] = min(at, out.get((d, i), at))
    return sorted((d, i, s) for (d, i), s in out.items())


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_random_overlaps_equal_brute_force(spark, broadcast):
    draw = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, list(draw.choice(vocabulary, n))) for i, n in enumerate([1, 2, 3, 4, 4, 5, 6, 8, 11, 12, 13, 14, 25, 40])]
    docs = []
    for d in range(50):
        words = list(draw.choice(vocabulary, draw.integers(0, 30)))
        _, item = items[int(draw.integers(len(items)))]
        piece = list(item)
        for k in draw.choice(len(piece), min(len(piece), int(draw.integers(0, 4))), replace=False):
            piece[k] = "other"
        docs.append((d, words[:9] + piece + words[9:]))
    frame = spark.createDataFrame([(d, ", ".join(w).upper()) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = sorted(tuple(r) for r in deco.contaminated(frame, bench, broadcast_seeds=broadcast).collect())
    assert got == plain(docs, items) and len(got) > 20


def test_odd_rows(spark):
    item = "the quick brown fox jumps over the lazy dog near a river bank"
    long = "filler " * 300_000 + item
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (4, item, "x"), (4, item, "x"), (None, item, None), (5, "the quick", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "the quick"), (4, item)], "item_id long, text string")
    got = [((r.doc_id or -1), r.item_id, r.start_word) for r in deco.contaminated(docs, items).collect()]
    assert sorted(got, key=str) == sorted(
        [(d, i, s) for d, s in ((-1, 0), (3, 300_000), (4, 0)) for i in (1, 4, None)] + [(5, None, 0)], key=str
    )
    kept = deco.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert deco.contaminated(docs.limit(0), items).count() == deco.contaminated(docs, items.limit(0)).count() == 0


def test_short_items_and_scripts_without_blanks(spark):
    chinese, thai = "今天天气很好我们去公园", "สวัสดีครับ"
    rows = [(1, "xx the Secret passphrase, is here yy"), (2, chinese), (3, f"前{chinese}后"), (4, "secret passphrase is"), (5, thai), (6, "今天")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "secret passphrase is here"), (2, chinese), (3, thai), (4, "天气")], "item_id long, text string")
    got = sorted(tuple(r) for r in deco.contaminated(docs, items).collect())
    assert got == [(1, 1, 2), (2, 2, 0), (2, 4, 2), (3, 2, 1), (3, 4, 3), (5, 3, 0)]


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e"), (2, "a")], "item_id long, text string")
    plan = deco.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
