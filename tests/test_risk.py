from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows

from doseline.operators import lookups, population, risk

CALC = "2020-06-15"
POP = "kcid long, auth_no long, agency_id int, program string, age_group string, p1_id string"


@pytest.fixture(scope="module")
def pop(frame):
    return frame(
        POP, (1, 11, 1, "400", "A", "P1"), (2, 21, 1, "400", "A", None), (3, 31, 2, "401", "C", "P3"),
        (4, 41, 2, "401", "C", "P4"),
    )


def test_latest_score_cutoff_and_ties(make):
    scores = make(
        "ep_locus", (1, 1, "2020-09-15", 1, 10), (1, 1, "2020-09-16", 2, 99), (1, 1, "2020-09-15", 3, 12),
        (1, 2, "2019-01-01", 4, 7),
    )
    out = risk.latest_scores(scores, CALC)
    assert rows(out, "kcid", "agency_id", "composite_score") == [(1, 1, 12), (1, 2, 7)]


def test_assessments_fall_back_to_other_agencies(pop, make):
    adult = make(
        "ep_locus", (1, 1, "2020-01-01", 1, 10), (2, 3, "2020-02-01", 2, 21), (2, 2, "2020-02-01", 3, 22),
        (2, 4, "2019-02-01", 4, 23), (3, 9, "2020-01-01", 5, 33),
    )
    child = make("ep_calocus", (4, 2, "2020-01-01", 6, 44))
    a = risk.adult_assessment(pop, adult, CALC)
    assert rows(a, "kcid", "LOCUS", "LOCUS_missing_data") == [
        (1, 10, "N"), (2, 22, "N"), (3, 33, "N"), (4, 0, "N"),
    ]
    c = risk.child_assessment(pop, child, adult, CALC)
    assert rows(c, "kcid", "CALOC", "CALOC_missing_data") == [
        (1, 10, "N"), (2, 22, "N"), (3, 33, "N"), (4, 44, "N"),
    ]
    none = risk.adult_assessment(pop, make("ep_locus"), CALC)
    assert rows(none, "kcid", "LOCUS", "LOCUS_missing_data") == [
        (1, 0, "Y"), (2, 0, "Y"), (3, 0, "N"), (4, 0, "N"),
    ]


def test_foster_from_either_source(pop, make):
    homes = make("ep_residence", (1, "26", "2031-01-01"), (2, "10", "2020-01-01"))
    cover = make(
        "ep_coverage_mco", (1, "FOSTR", "2020-01-01"), (2, "FOSTR", "2020-07-16"),
        (3, "FOSTR", "2020-07-15"), (4, "OTHER", "2020-01-01"),
    )
    out = risk.foster_history(pop, homes, cover, CALC)
    assert rows(out, "kcid", "FOSTR") == [(1, 1), (2, 0), (3, 1), (4, 0)]


def test_homeless_uses_latest_day_and_counts_once(pop, make):
    homes = make(
        "ep_residence", (1, "82", "2020-07-15"), (1, "82", "2020-07-15"), (2, "82", "2020-01-01"),
        (2, "10", "2020-02-01"), (3, "10", "2020-02-01"), (3, "82", "2020-02-01"), (4, "82", "2020-07-16"),
    )
    assert rows(risk.homeless_now(pop, homes, CALC), "kcid", "HMLES") == [(1, 1), (2, 0), (3, 1), (4, 0)]


CVD = ["ischemic_heart_dis", "mi", "hypertension", "stroke", "hyperlipid", "heart_failure", "atrial_fib"]


def test_condition_flags_and_coverage(make):
    codes = [*CVD, "diabetes", "asthma", "copd", "unknown"]
    claims = make("mcaid_claim_ccw", *[(f"id{i}", f"ccw_{c}", "2020-06-15") for i, c in enumerate(codes)],
                  ("lost", "ccw_mi", "2020-01-01"), ("id10", "ccw_mi", "2020-06-16"))
    elig = make(
        "mcaid_elig_timevar", *[(f"id{i}", "2010-01-01", "2018-06-15") for i in range(len(codes))],
        ("id0", "2019-01-01", "2019-02-01"), ("late", "2020-06-16", "2021-01-01"),
        ("gone", "2010-01-01", "2018-06-14"),
    )
    header = make("mcaid_claim_header", ("id1", "2018-06-15"), ("id2", "2018-06-14"), ("lost", "2020-01-01"))
    out = {r[0]: r[1:] for r in rows(risk.condition_flags(claims, elig, header, CALC))}
    assert set(out) == {f"id{i}" for i in range(len(codes))}
    assert [out[f"id{i}"][:4] for i in range(len(codes))] == [(0, 1, 0, 0)] * 7 + [
        (1, 0, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 0, 0),
    ]
    assert (out["id0"][4], out["id1"][4], out["id2"][4]) == ("Y", "N", "Y")
    flags = dict(rows(risk.coverage_missing_flag(elig, header, CALC)))
    assert flags == {k: v[4] for k, v in out.items()}


def test_chronic_conditions_without_medicaid_id_keep_assessment(pop, make):
    assessed = make("ma_cond_ass", (11, "152"), (11, "152"), (11, "999"), (21, "155"), (21, "154"))
    claims = make("mcaid_claim_ccw", ("P1", "ccw_asthma", "2020-01-01"), ("P1", "ccw_mi", "2020-01-01"),
                  ("P3", "ccw_copd", "2020-01-01"))
    elig = make("mcaid_elig_timevar", ("P1", "2019-01-01", "2021-01-01"))
    header = make("mcaid_claim_header", ("P1", "2020-01-01"))
    out = risk.chronic_conditions(pop, assessed, claims, elig, header, CALC)
    assert rows(out, "kcid", "asthma", "diabetes", "copd", "cvd", "CHRON", "CHRON_missing_data") == [
        (1, 1, 0, 0, 1, 2, "N"), (2, 0, 0, 1, 1, 2, "Y"), (3, 0, 0, 0, 0, 0, "Y"), (4, 0, 0, 0, 0, 0, "Y"),
    ]
    assert not [c for c in out.columns if c.startswith(("caa_", "ccw_"))]


@pytest.fixture(scope="module")
def crisis(make):
    auth = make(
        "crisis_au_master",
        (1, 1, "2020-01-01", None, "SRS", "AA"), (1, 2, "2015-01-01", "2019-06-15", "DTX", "TM"),
        (1, 3, "2015-01-01", "2030-01-01", "SRS", "AA"), (1, 4, "2020-01-01", None, "SRS", "PN"),
        (2, 5, "2020-01-01", None, "IP", "AA"), (2, 6, "2020-01-01", None, "IP", "AA"),
        (2, 7, "2020-02-01", None, "SRS", "AA"), (9, 8, "2020-02-01", None, "DTX", "AA"),
    )
    ip = make("ip_master", (5, "I"), (5, "I"), (5, "V"), (6, "V"), (7, "I"), (7, "V"))
    return auth, ip


def test_crisis_counts(crisis):
    # A stay spanning the whole window is missed; one with two inpatient types counts twice.
    assert rows(risk.crisis_counts(*crisis, CALC)) == [(1, 1, 1, 0), (2, 2, 0, 1), (9, 0, 1, 0)]


def test_no_type_and_an_empty_type_are_two_types(make):
    auth = make("crisis_au_master", (1, 1, "2020-01-01", None, "SRS", "AA"), (1, 2, "2020-01-01", None, "IP", "AA"))
    ip = make("ip_master", (1, None), (1, ""), (1, "V"), (1, None), (2, None))
    assert rows(risk.crisis_counts(auth, ip, CALC)) == [(1, 3, 0, 0)]


def test_high_utilization_of_either_source(pop, crisis, make):
    hospital = make(
        "cmt_hospital_report", (1, "Emergency", "2019-06-15"), (1, "Emergency", "2019-06-14"),
        (3, "Inpatient", "2020-06-15"), (3, "Other", "2020-06-15"),
    )
    out = risk.high_utilization(pop, *crisis, hospital, CALC)
    cols = ["kcid", "nSRS", "nDTX", "nITA", "nED", "nIP", "HUTIL"]
    assert rows(out, *cols) == [
        (1, 1, 1, 0, 1, 0, 3), (2, 2, 0, 1, 0, 0, 3), (3, 0, 0, 0, 0, 1, 1), (4, 0, 0, 0, 0, 0, 0),
    ]
    twice = pop.unionByName(pop.where("kcid = 1").selectExpr("kcid", "12L AS auth_no", "agency_id", "program", "age_group", "p1_id"))
    literal = risk.high_utilization(twice, *crisis, hospital, CALC, literal=True)
    assert rows(literal, *cols)[:2] == [(1, 2, 2, 0, 1, 0, 5)] * 2
    assert rows(risk.high_utilization(twice, *crisis, hospital, CALC), *cols)[:2] == [(1, 1, 1, 0, 1, 0, 3)] * 2


def test_justice_events(pop, make):
    jail = make(
        "ep_jail", (1, "2018-12-31", "2020-01-01"), (2, "2020-03-01", None), (2, "2020-03-01", None),
        (3, "2010-01-01", "2015-06-14"), (4, "2018-01-01", "2019-12-14"),
    )
    muni = make("muni_jail", (2, "2020-03-01", None), (2, "2020-03-02", "2020-03-05"), (None, "2020-01-01", None))
    out = risk.justice_events(pop, jail, muni, CALC)
    assert rows(out, "kcid", "NUMCJ", "LNGCJ") == [(1, 1, 1), (2, 2, 0), (3, 0, 0), (4, 0, 0)]


def test_currency_cutoff(make):
    muni = make("muni_jail", (1, "2020-01-01", None), (2, "2020-03-01", None))
    assert rows(population.currency_cutoff(muni, "booking_start", CALC)) == [("2020-03-01",)]
    assert rows(population.currency_cutoff(muni, "booking_start", "2020-02-01")) == [("2020-02-01",)]


def test_asam_level_text(pop, make):
    asam = make(
        "ep_asam_placement", (1, 1, "2020-01-01", "OP", 1, "2.1-WM"), (1, 1, "2020-02-01", "IP", 2, "1"),
        (2, 1, "2020-09-15", "OP", 3, "OTP"), (2, 1, "2020-09-16", "OP", 4, "1"),
        (3, 2, "2020-01-01", "OP", 5, " 3.5 "), (4, 1, "2020-01-01", "OP", 6, "1"),
    )
    out = risk.asam_level(pop, asam, CALC)
    assert rows(out, "kcid", "ASAM") == [
        (1, Decimal("2.1")), (2, Decimal("5.0")), (3, Decimal("3.5")), (4, Decimal("0.0")),
    ]
    bad = make("ep_asam_placement", (1, 1, "2020-01-01", "OP", 1, "none"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        risk.asam_level(pop, bad, CALC).collect()


def test_injection_window_edges(pop, make):
    use = make(
        "ep_substance_use", (1, 2, "2019-06-16"), (2, 2, "2019-06-15"), (3, 2, "2020-07-15"),
        (4, 2, "2020-07-16"), (4, 1, "2020-01-01"),
    )
    assert rows(risk.injection_use(pop, use, CALC), "kcid", "IDU") == [(1, 1), (2, 0), (3, 1), (4, 0)]


def test_lookup_matches_plain_join_and_spreads_nulls(frame):
    left = frame("id long, k long, s string", (1, 5, "a"), (2, None, None), (3, 6, "b"), (4, None, "c"))
    # The last row's key is the very stand-in of the second left row.
    stand_in = left.where("id = 2").selectExpr("xxhash64(id)").first()[0]
    right = frame("key long, v string", (5, "five"), (None, "none"), (stand_in, "false match"))
    out = lookups.lookup(left, right, "k", "key", "id")
    assert out.columns == ["id", "k", "s", "v"]
    assert rows(out, "id", "v") == [(1, "five"), (2, None), (3, None), (4, None)]
    text = frame("key string, w int", ("a", 1), ("c", 3), (None, 9))
    assert rows(lookups.lookup(left, text, "s", "key", "id"), "id", "w") == [(1, 1), (2, None), (3, None), (4, 3)]


def test_assessments_together_equal_one_after_the_other(pop, make):
    adult = make("ep_locus", (1, 1, "2020-01-01", 1, 10), (3, 9, "2020-01-01", 2, 33), (4, 2, "2020-01-01", 3, None))
    child = make("ep_calocus", (4, 2, "2020-01-01", 4, 44), (2, 1, "2020-01-01", 5, 5))
    together = risk.assessments(pop, adult, child, CALC)
    apart = risk.child_assessment(risk.adult_assessment(pop, adult, CALC), child, adult, CALC)
    assert rows(together, *apart.columns) == rows(apart)


def test_population_rules(make):
    def auth(no, start="2020-04-10", expire="2020-05-01", program="400", status="AA", post="2020-01-01 00:00:00", data="OK"):
        return (no, no, 1, start, expire, program, status, post, data)

    master = make(
        "au_master", auth(1), auth(2, expire=None), auth(3, start="2020-03-31", expire=None),
        auth(4, data=None), auth(5, data="ID"), auth(6), auth(7, post="2020-06-12 23:59:00"),
        auth(8, post="2020-06-13 00:00:00"), auth(9, program="S01"), auth(10, status="XX"),
        auth(11, program="3B1"), auth(12),
    )
    attributes = make("case_rate", *[(n, n, "A", None, None) for n in range(1, 12)])
    person = make("g_person", (1, "2000-04-01"), (2, "2000-04-02"))
    plan = make("au_initial_plan", (11, "MID"))
    strata = make("au_stratum", {"auth_no": 6, "start_date": "2020-04-01"}, {"auth_no": 1, "start_date": "2020-01-01"})
    p1 = make("g_p1_client", (1, "P1"))
    out = population.select_population(
        master, person, plan, attributes, strata, p1, "2020-04-01", "2020-06-30", CALC
    )
    assert rows(out, "auth_no", "program", "current_program", "age", "p1_id") == [
        (1, "400", "400", 20, "P1"), (2, "400", "400", 19, None), (7, "400", "400", None, None),
        (11, "401", "3B1", None, None),
    ]
    assert rows(out, "phs_start_date", "phs_end_date", "calc_date")[0] == ("2020-04-01", "2020-06-30", CALC)
