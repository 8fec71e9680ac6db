from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as Dec

import numpy as np
import pytest
from conftest import rows

from doseline.operators import linkage

NOW = datetime(2020, 7, 3, 12)


def stratum(sid, no, start, level, ratio=None, age="A", rule="SHA"):
    return {
        "au_stratum_id": sid, "auth_no": no, "start_date": start, "end_date": "2020-06-30", "strat_level": level,
        "stratum_sda_id": ratio, "age_group": age, "sda_rule": rule, "sda_pay_multiplier": 1,
    }


def master(no, start, expire, kcid, program="400", status="AA", agency=1):
    return (kcid, no, agency, start, expire, program, status, "2019-01-01 00:00:00", "OK")


@pytest.fixture(scope="module")
def world(make):
    """One authorization per rule; each is stratified for the quarter of 2020-04-01."""
    auths = make(
        "au_master",
        master(1, "2019-01-01", None, 1), master(2, "2020-03-20", None, 2), master(3, "2019-01-01", None, 3),
        master(4, "2020-03-20", None, 4), master(5, "2020-03-20", None, 5), master(6, "2019-01-01", None, 6, "500"),
        master(102, "2019-01-01", "2020-03-10", 2), master(104, "2019-01-01", "2020-03-10", 4, "3B1"),
        master(105, "2019-01-01", "2019-12-20", 5), master(204, "2019-01-01", "2020-03-01", 4),
    )
    strata = make(
        "au_stratum",
        stratum(11, 1, "2020-04-01", "M"), stratum(10, 1, "2020-01-01", "M", 900),
        stratum(21, 2, "2020-04-01", "H"), stratum(20, 102, "2020-01-01", "L", 901),
        stratum(31, 3, "2020-04-01", "H"), stratum(30, 3, "2020-01-01", "M", 902),
        stratum(41, 4, "2020-04-01", "M"), stratum(40, 104, "2020-01-01", "M", 903),
        stratum(51, 5, "2020-04-01", "M"), stratum(61, 6, "2020-04-01", "M"),
        stratum(1, 1, "2019-10-01", "M"),
    )
    ratios = make(
        "au_stratum_sda",
        *[
            {"stratum_sda_id": i, "auth_no": a, "end_date": e, "sda": s, "enroll_days": d}
            for i, a, e, s, d in [
                (911, 1, "2020-02-29", "0.900", 31), (912, 2, "2020-02-29", "0.100", 90),
                (913, 3, "2020-02-29", "0.100", 90), (914, 4, "2020-02-29", "0.100", 30),
                (915, 5, "2020-02-29", "0.100", 30), (910, 1, "2020-02-29", "0.100", 90),
                (916, 5, "2020-01-31", "0.100", 90), (903, 104, "2019-11-30", "0.450", 90),
                (900, 1, "2019-11-30", None, 0),
            ]
        ],
    )
    corridor = make(
        "cd_stratum_pay_corridor", ("400", "A", 0, "0.899", "0.800"), ("401", "A", 0, "0.899", "0.800"),
        ("400", "A", "0.900", 1, "0.950"), ("400", "A", "0.900", 1, "0.940"), ("S01", "A", 0, 9, "0.500"),
    )
    return strata, auths, ratios, corridor


def test_every_rule(world):
    links = linkage.link_strata(*world)
    out = rows(links, "au_stratum_id", "new_sda_rule", "new_stratum_sda_id", "new_sda", "new_sda_pay_multiplier")
    assert out == [
        (11, "NOR", 911, Dec("0.900"), Dec("0.950")),
        (21, "FPC", 912, Dec("0.100"), Dec("1.000")),
        (31, "FPC", 913, Dec("0.100"), Dec("1.000")),
        (41, "PQD", 903, Dec("0.450"), Dec("0.800")),
        (51, "FPN", 915, Dec("0.100"), Dec("1.000")),
    ]
    assert rows(links.where("auth_no = 4"), "prev_auth_no", "prev_auth_end") == [(104, "2020-03-10")]


def test_thirty_days_are_not_enough_for_the_normal_rule(frame):
    df = frame(
        """id int, first_strat string, pqd_strat string, last_strat string, strat_level string, phs_start_date date,
        strat_check_end date, enroll_days int, pqd_sda_id long, stratum_sda_id long""",
        (1, "M", None, None, "M", "2020-04-01", "2020-07-01", 31, 7, 8),
        (2, "M", None, None, "M", "2020-04-01", "2020-07-01", 30, 7, 8),
        (3, "M", None, None, "M", "2020-04-01", "2020-07-01", None, None, None),
        (4, "M", "L", "M", "M", "2020-07-01", "2020-07-01", 90, 7, 8),
        (5, "M", "L", "M", "M", "2020-07-02", "2020-07-01", 90, 7, 8),
    )
    assert rows(linkage.payment_rule(df), "id", "new_sda_rule", "new_stratum_sda_id") == [
        (1, "NOR", 8), (2, "PQD", 7), (3, "FPN", None), (4, "FPC", 8), (5, "NOR", 8),
    ]


def test_first_stratum_special_date(make):
    strata = make("au_stratum", stratum(1, 1, "2019-09-01", "L"), stratum(2, 1, "2020-01-01", "M"), stratum(3, 2, "2020-01-01", "H"))
    assert rows(linkage.first_stratum(strata)) == [(1, "L", "2020-01-01"), (2, "H", "2020-04-01")]


def test_endpoints_equal_the_separate_lookups(world):
    strata, auths, _, _ = world
    candidates = linkage.unlinked_strata(strata, auths)
    assert [r[0] for r in rows(candidates, "au_stratum_id")] == [11, 21, 31, 41, 51]
    ids = candidates.select("auth_no").distinct()
    ends = linkage.strata_endpoints(strata)
    apart = (
        linkage.first_stratum(strata)
        .join(linkage.last_stratum(strata, candidates), "auth_no", "left")
        .join(linkage.last_stratum(strata).toDF("auth_no", "pqd_strat", "pqd_sda_id"), "auth_no", "left")
    )
    assert rows(ends.join(ids, "auth_no"), *apart.columns) == rows(apart.join(ids, "auth_no"))


def test_apply_links_changes_only_linked_rows(world):
    strata, *_ = world
    after = linkage.apply_links(strata, linkage.link_strata(*world), NOW)
    assert after.columns == strata.columns
    out = rows(after, "au_stratum_id", "sda_rule", "stratum_sda_id", "modify_stamp")
    assert (11, "NOR", 911, NOW.isoformat()) in out and (10, "SHA", 900, None) in out
    assert len(out) == strata.count()
    kept = set(rows(after.where("modify_stamp IS NULL"))) <= set(rows(strata))
    assert kept and linkage.LINKED_SINCE == date(2020, 1, 1)


def test_a_stratum_without_a_date_is_neither_first_nor_last(make):
    strata = make(
        "au_stratum", stratum(1, 1, None, "L"), stratum(2, 1, "2020-01-01", "M"), stratum(3, 1, "2020-04-01", "H"),
        stratum(9, 1, None, "X"),
    )
    assert rows(linkage.first_stratum(strata)) == [(1, "M", "2020-04-01")]
    assert rows(linkage.last_stratum(strata), "last_strat") == [("H",)]
    assert rows(linkage.strata_endpoints(strata, date(2020, 1, 1)), "first_strat", "pqd_strat") == [("M", "H")]


@pytest.mark.parametrize("seed", range(3))
def test_endpoints_from_a_state_equal_those_of_all_strata(spark, seed):
    """However the strata are dealt to states, and wherever the awaiting ones are."""
    draw = np.random.default_rng(seed)
    days = [None, *(date(2018 + q // 4, q % 4 * 3 + 1, 1) for q in range(12))]
    data = [
        (i, int(draw.integers(12)), days[draw.integers(len(days))], "LMH"[draw.integers(3)],
         int(draw.integers(50)) if draw.random() < 0.6 else None)
        for i in range(300)
    ]
    strata = spark.createDataFrame(data, "au_stratum_id long, auth_no long, start_date date, strat_level string, stratum_sda_id long")
    since = date(2019, 4, 1)
    want = [r for r in rows(linkage.strata_endpoints(strata, since)) if any(v is not None for v in r[1:])]
    parts = [strata.where(f"pmod(hash(au_stratum_id), 3) = {k}") for k in range(3)]
    state = linkage.settled_strata(parts[0], since)
    for part in (*parts[1:], parts[0]):  # one of them twice
        state = linkage.combined_states(state, linkage.settled_strata(part, since))
    for rest in (linkage.awaiting_strata(strata, since), strata):
        got = linkage.endpoints_from_state(state, rest, since)
        assert [r for r in rows(got) if any(v is not None for v in r[1:])] == want

    def plain(no):
        own = sorted((d, i, level, ratio) for i, a, d, level, ratio in data if a == no and d)
        held = [s for s in own if s[0] < since or s[3] is not None]
        return own[0][2], held[-1][2] if held else None, held[-1][3] if held else None, own[-1][2], own[-1][3]

    names = ("first_strat", "last_strat", "last_stratum_sda_id", "pqd_strat", "pqd_sda_id")
    for no, *values in rows(linkage.endpoints_from_state(state, strata, since), "auth_no", *names):
        assert tuple(values) == plain(no)


def test_awaiting_strata_are_read_by_quarter(spark, make, tmp_path):
    make("au_stratum", stratum(1, 1, "2019-10-01", "M"), stratum(2, 1, "2020-01-01", "M")).write.partitionBy(
        "start_date"
    ).parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = linkage.awaiting_strata(stored)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "start_date" in filters and "IsNull(stratum_sda_id)" in plan
