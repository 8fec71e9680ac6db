from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import rows

from doseline.operators.intervals import merge_intervals, prior_episode, range_sum

BASE = date(2019, 1, 1)


def brute_merge(stays, mode):
    out = []
    for key in sorted({k for k, _, _ in stays}):
        own = sorted({(s, e) for k, s, e in stays if k == key})
        if mode == "runmax":
            own = sorted({(s, max(e for s2, e in own if s2 == s)) for s, _ in own})
        grp, groups, last = 0, {}, None
        for s, e in own:
            if last is None or s > last:
                grp += 1
            last = e if mode == "lag" or last is None else max(last, e)
            lo, hi = groups.get(grp, (s, e))
            groups[grp] = (min(lo, s), max(hi, e))
        out += [(key, g, lo.isoformat(), hi.isoformat()) for g, (lo, hi) in groups.items()]
    return sorted(out)


@pytest.mark.parametrize("mode", ["lag", "runmax"])
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_matches_brute_force(spark, mode, seed):
    rng = random.Random(seed)
    stays = []
    for _ in range(400):
        key = 1 if rng.random() < 0.4 else rng.randint(2, 30)
        start = BASE + timedelta(days=rng.randint(0, 900))
        length = rng.choice([0, 0, 1, 5, 20, 200, -4 if mode == "lag" else 3])
        stays.append((key, start, start + timedelta(days=length)))
    df = spark.createDataFrame(stays * 2, "k int, s date, e date").repartition(3)
    assert rows(merge_intervals(df, ["k"], "s", "e", mode)) == brute_merge(stays, mode)


def test_long_stay_over_two_short_ones(frame):
    df = frame(
        "k int, s date, e date", (1, "2020-01-01", "2020-12-31"), (1, "2020-02-01", "2020-02-03"),
        (1, "2020-06-01", "2020-06-02"), (1, "2020-12-31", "2021-01-04"),
    )
    assert rows(merge_intervals(df, ["k"], "s", "e", "runmax")) == [(1, 1, "2020-01-01", "2021-01-04")]
    assert rows(merge_intervals(df, ["k"], "s", "e")) == [
        (1, 1, "2020-01-01", "2020-12-31"), (1, 2, "2020-06-01", "2020-06-02"),
        (1, 3, "2020-12-31", "2021-01-04"),
    ]
    with pytest.raises(ValueError):
        merge_intervals(df, ["k"], "s", "e", "other")


def test_range_sum_keeps_empty_intervals(frame):
    spans = frame(
        "k int, s date, e date", (1, "2020-01-01", "2020-01-31"), (1, "2020-01-15", "2020-02-10"),
        (2, "2020-01-01", "2020-01-31"), (1, None, None),
    )
    points = frame("k int, d date, a long", (1, "2020-01-15", 3), (1, "2020-01-31", 4), (1, "2020-02-10", 5))
    assert rows(range_sum(spans, points, "k", "s", "e", "d", "a", "total")) == [
        (1, "2020-01-01", "2020-01-31", 7), (1, "2020-01-15", "2020-02-10", 12), (1, None, None, 0),
        (2, "2020-01-01", "2020-01-31", 0),
    ]


def brute_prior(current, episodes, max_gap, min_end):
    out = []
    for key, auth, start in current:
        found = [
            (e, a, s) for k, a, s, e in episodes
            if k == key and a != auth and e is not None and 0 <= (start - e).days <= max_gap
            and (min_end is None or e >= min_end)
        ]
        e, a, s = max(found, default=(None, None, None), key=lambda f: f[:2])
        out.append((auth, a, s and s.isoformat(), e and e.isoformat()))
    return sorted(out)


@pytest.mark.parametrize("min_end", [None, BASE + timedelta(days=200)])
def test_prior_episode_matches_brute_force(spark, min_end):
    rng = random.Random(7)
    episodes = []
    for auth in range(1, 401):
        key = 1 if rng.random() < 0.4 else rng.randint(2, 25)
        start = BASE + timedelta(days=rng.randint(0, 500))
        # Some end on the day they start, so that their own row is the nearest one.
        end = rng.choice([None, start, start, start + timedelta(days=rng.randint(1, 120))])
        episodes.append((key, auth, start, end))
    current = [(k, a, s) for k, a, s, _ in episodes]
    cur = spark.createDataFrame(current, "k int, auth_no long, auth_start date")
    eps = spark.createDataFrame(episodes, "k int, auth_no long, start_date date, expire_date date")
    out = prior_episode(cur, eps, ["k"], 90, min_end)
    got = rows(out, "auth_no", "prev_auth_no", "prev_auth_start", "prev_auth_expire")
    assert got == brute_prior(current, episodes, 90, min_end)


def test_prior_episode_gap_edges(frame):
    cur = frame("k int, auth_no long, auth_start date", (1, 10, "2020-06-01"))

    def found(end):
        eps = frame("k int, auth_no long, start_date date, expire_date date", (1, 9, "2020-01-01", end))
        return rows(prior_episode(cur, eps, ["k"]), "prev_auth_no")[0][0]

    assert [found(e) for e in ("2020-06-02", "2020-06-01", "2020-03-03", "2020-03-02")] == [None, 9, 9, None]
