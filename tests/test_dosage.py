from __future__ import annotations

from datetime import date
from decimal import Decimal as Dec

import pytest
from conftest import rows

from doseline.operators import dosage
from doseline.session import Stages

S, E = date(2019, 12, 1), date(2020, 2, 29)
ALWAYS = ("2000-01-01", "2099-12-31")
MEMBERS = "kcid long, auth_no long, program string, age_group string"


def master(no, start, expire, kcid=1, program="400", status="AA", agency=1):
    return (kcid, no, agency, start, expire, program, status, "2019-01-01 00:00:00", "OK")


def stratum(no, start, end, level="M", age="A"):
    return {"auth_no": no, "start_date": start, "end_date": end, "strat_level": level, "age_group": age}


@pytest.fixture(scope="module")
def tiers(make):
    return make(
        "cd_stratum_tier", ("400", "A", 0, 5, "M", 6, *ALWAYS), ("400", "A", 6, 9, "H", 12, *ALWAYS),
        ("400", "C", 0, 5, "M", 6, "2000-01-01", "2019-12-31"), ("400", "C", 0, 5, "M", 9, "2020-01-01", "2099-12-31"),
    )


@pytest.fixture(scope="module")
def ratios(spark, make, frame, tiers):
    """All cases in one calculation; persons and authorizations are numbered by case."""
    members = frame(
        MEMBERS, (1, 1, "2X1", "A"), *[(n, n, "400", "A") for n in (27, 28, 31)], (4, 4, "400", "A"),
        (5, 5, "400", None), (6, 6, "S01", "A"), (70, 72, "400", "A"), (8, 8, "400", "C"), (9, 9, "400", "A"),
    )
    auths = make(
        "au_master", master(1, "2019-12-11", "2020-02-10"),
        *[master(n, "2020-01-01", f"2020-01-{n}", n) for n in (27, 28, 31)], master(4, "2019-01-01", None, 4),
        master(5, "2019-01-01", None, 5), master(6, "2020-03-01", None, 6, "S01"),
        master(72, "2020-01-20", None, 70), master(71, "2019-06-01", "2020-01-10", 70),
        master(77, "2019-05-01", "2020-01-10", 70, status="PN"),
        master(78, "2019-05-01", "2020-01-15", 70, program="S01"),
        master(79, "2019-05-01", "2020-01-15", 70, agency=2), master(8, "2019-01-01", None, 8),
        master(9, "2019-01-01", None, 9),
    )
    strata = make(
        "au_stratum", stratum(1, "2019-10-01", "2019-12-31"), stratum(1, "2020-01-01", "2020-03-31", "H"),
        *[stratum(n, "2020-01-01", "2020-03-31") for n in (27, 28, 31)],
        stratum(4, "2019-10-01", "2020-03-31", "Z"), stratum(6, "2019-10-01", None),
        stratum(72, "2020-01-01", "2020-03-31"), stratum(71, "2019-10-01", "2019-12-31"),
        stratum(71, "2020-01-01", "2020-03-31"), stratum(8, "2019-10-01", "2020-03-31", age="C"),
        stratum(9, "2019-10-01", "2020-03-31"),
    )
    services = make(
        "ea_cpt_service", (1, "2019-12-10", 60, 1), (1, "2019-12-11", 90, 1), (1, "2020-01-01", 120, 2),
        (1, "2020-01-02", 50, 3), (1, "2020-01-02", -30, 1), (1, "2020-01-02", 0, 1), (1, "2020-02-11", 60, 1),
        *[(n, "2020-01-05", 60, 1) for n in (27, 28, 31, 4, 8)], (72, "2020-02-01", 60, 1),
        (71, "2020-01-05", 30, 1), (71, "2020-01-11", 30, 1), *[(9, "2020-01-05", 1_000_000, 1)] * 3,
    )

    def calculate(tier_as_of=None):
        out = dosage.dose_ratio(
            members, strata, tiers, auths, services, S, E, tier_as_of=tier_as_of, keep=Stages(spark).keep
        )
        return {r.auth_no: r for r in out.collect()}

    return {"literal": calculate(), "dated": calculate(date(2020, 1, 1))}


def test_two_strata_cut_by_the_authorization(ratios):
    out = ratios["literal"][1]
    # 21 days of 0.2 hours and 41 days of 0.4; 1.5 and 2 hours delivered.
    assert (out.enroll_days, out.calendar_month, out.svc_hrs) == (62, 1, Dec("3.500"))
    assert out.hrs_expected == Dec("9.968")  # 30 * (20.600 / 62, cut at 0.332258)
    assert out.svc_hrs_prorated == Dec("1.694")
    assert out.sda == Dec("0.170")


@pytest.mark.parametrize(("days", "has_ratio"), [(27, False), (28, False), (31, True)])
def test_minimum_days_and_calendar_month(ratios, days, has_ratio):
    out = ratios["literal"][days]
    assert out.enroll_days == days
    assert (out.sda is not None) == has_ratio


def test_nothing_expected_or_no_strata(ratios):
    out = ratios["literal"]
    assert (out[4].enroll_days, out[4].hrs_expected, out[4].sda, out[4].svc_hrs) == (91, Dec("0.000"), None, Dec("1.000"))
    assert (out[5].enroll_days, out[5].hrs_expected, out[5].svc_hrs_prorated, out[5].sda) == (0, None, None, None)
    assert (out[6].enroll_days, out[6].calendar_month) == (0, 0)


def test_continued_authorization_adds_up(ratios):
    out = ratios["literal"][72]
    assert (out.prev_auth_no, out.enroll_days, out.svc_hrs, out.calendar_month) == (71, 41 + 41, Dec("1.500"), 1)
    assert out.hrs_expected == Dec("6.000")


def test_tier_versions_fan_out_unless_dated(ratios):
    literal, dated = ratios["literal"][8], ratios["dated"][8]
    # Two versions: days double, and each of the two equal intervals gets the hours of both.
    assert (literal.enroll_days, literal.svc_hrs) == (182, Dec("4.000"))
    assert (dated.enroll_days, dated.svc_hrs, dated.hrs_expected) == (91, Dec("1.000"), Dec("9.000"))


def test_extreme_hours_do_not_overflow(ratios):
    assert ratios["literal"][9].svc_hrs == Dec("50000.000")


def test_prior_must_end_inside_the_window(make, frame):
    cur = frame(
        "kcid long, auth_no long, agency_id int, tx_focus string, auth_start date", (1, 2, 1, "MH", "2020-01-20"),
    )
    auths = [master(1, "2019-06-01", "2019-11-30")]
    assert rows(dosage.continued_from(cur, make("au_master", *auths), S), "prev_auth_no") == [(None,)]
    auths = [master(1, "2019-06-01", "2019-12-01"), master(3, "2019-07-01", "2019-12-01")]
    assert rows(dosage.continued_from(cur, make("au_master", *auths), S), "prev_auth_no") == [(3,)]


def test_with_sda_fills_all_but_the_ratio(frame):
    pop = frame(MEMBERS + ", start_date date, expire_date date", (1, 1, "400", None, None, None), (2, 2, "400", "A", None, None))
    ratios = frame(
        MEMBERS + """, prev_auth_no long, calendar_month int, enroll_days int, hrs_expected decimal(18,3),
        svc_hrs decimal(18,3), svc_hrs_prorated decimal(18,3), sda decimal(18,3)""",
        (1, 1, "400", None, 9, 1, 0, None, Dec(1), None, None),
    )
    out = dosage.with_sda(pop, ratios)
    assert "start_date" not in out.columns
    assert rows(out, "auth_no", "prev_auth_no", "enroll_days", "hrs_expected", "svc_hrs", "svc_hrs_prorated", "sda") == [
        (1, 9, 0, Dec("0.000"), Dec("1.000"), Dec("0.000"), None),
        (2, None, 0, Dec("0.000"), Dec("0.000"), Dec("0.000"), None),
    ]
