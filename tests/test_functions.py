from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from doseline.functions import codes, dates, decimals, ranges
from doseline.functions.dates import Periods


@pytest.mark.parametrize(
    ("calc", "expected"),
    [
        ("2020-01-01", ("2020-01-01", "2020-03-31", "2019-09-01", "2019-11-30")),
        ("2020-03-31", ("2020-01-01", "2020-03-31", "2019-09-01", "2019-11-30")),
        ("2020-06-30", ("2020-04-01", "2020-06-30", "2019-12-01", "2020-02-29")),
        ("2021-04-02", ("2021-04-01", "2021-06-30", "2020-12-01", "2021-02-28")),
        ("2020-12-31", ("2020-10-01", "2020-12-31", "2020-06-01", "2020-08-31")),
    ],
)
def test_periods_agree_on_driver_and_columns(frame, calc, expected):
    df = dates.with_periods(frame("calc date", (calc,)), "calc")
    assert rows(df, "pop_start", "pop_end", "sda_start", "sda_end") == [expected]
    p = Periods.of(date.fromisoformat(calc))
    assert tuple(str(d) for d in (p.pop_start, p.pop_end, p.sda_start, p.sda_end)) == expected


def test_months_after_clamps_but_does_not_stick():
    assert dates.months_after(date(2020, 12, 31), -10) == date(2020, 2, 29)
    assert dates.months_after(date(2021, 2, 28), 1) == date(2021, 3, 28)


def test_month_bounds(frame):
    bounds = dates.month_bounds(F.col("s"))
    df = frame("s date", ("2019-12-01",)).select(*[c.alias(n) for n, c in bounds.items()])
    assert rows(df) == [
        ("2019-12-01", "2019-12-31", "2020-01-01", "2020-01-31", "2020-02-01", "2020-02-29")
    ]


def test_age_turns_on_the_birthday(frame):
    df = frame("dob date", ("2000-01-01",), ("1999-12-31",), ("2000-01-02",), (None,), ("2020-05-01",))
    aged = df.select("dob", dates.age_at(F.col("dob"), date(2020, 1, 1)).alias("age"))
    assert dict(rows(aged)) == {
        "2000-01-01": 20, "1999-12-31": 20, "2000-01-02": 19, "2020-05-01": 0, None: None,
    }


def test_year_boundaries_count_calendar_years(frame):
    df = frame("a date, b date", ("2018-12-31", "2020-01-01"), ("2019-01-01", "2019-12-31"))
    assert rows(df.select(dates.year_boundaries(F.col("a"), F.col("b")))) == [(0,), (2,)]


def test_recode_program(frame):
    df = frame(
        "program string, plan string", ("400", "MID"), ("2X1", "F19"), ("3A1", "MID"), ("3B1", "X"),
        ("MOM", None), ("S01", "F19"), (None, "F19"),
    )
    out = df.select("program", codes.recode_program(F.col("program"), F.col("plan")).alias("r"))
    assert dict(rows(out)) == {
        "400": "400", "2X1": "400", "3A1": "401", "3B1": "MOP", "MOM": "MOP", "S01": "", None: "",
    }


def test_focus_without_unfunded_codes(frame):
    df = frame("p string", ("MOP",), ("SOP",), ("3B1",), ("501",), ("XX",))
    both = df.select(
        "p", codes.tx_focus(F.col("p")).alias("wide"), codes.tx_focus(F.col("p"), False).alias("narrow")
    )
    assert rows(both) == [
        ("3B1", "MH", "MH"), ("501", "SUD", "SUD"), ("MOP", "MH", ""), ("SOP", "SUD", ""), ("XX", "", ""),
    ]


def test_missing_flag(frame):
    df = frame(
        "id int, score int, program string, age string",
        (1, None, "400", "A"), (2, 5, "400", "A"), (3, None, "S01", "A"), (4, None, "400", "C"),
        (5, None, None, None),
    )
    flag = codes.missing_flag(F.col("score"), F.col("program"), F.col("age"), codes.ADULT_ASSESSED, ["A", "G"])
    assert rows(df.select("id", flag.alias("f"))) == [(1, "Y"), (2, "N"), (3, "N"), (4, "N"), (5, "Y")]


def test_overlap_with_open_ends(frame):
    df = frame(
        "id int, s date, e date",
        (1, "2020-01-05", None), (2, "2019-12-05", None), (3, "2019-01-01", "2021-01-01"),
        (4, "2019-01-01", "2020-01-01"), (5, "2020-03-31", "2020-09-01"), (6, "2020-04-01", "2020-09-01"),
        (7, None, "2020-02-01"), (8, None, None),
    )
    hit = ranges.overlaps(F.col("s"), F.col("e"), "2020-01-01", "2020-03-31")
    assert [i for i, h in rows(df.select("id", hit.alias("h"))) if h] == [1, 3, 4, 5, 7]


def test_clipping(frame):
    df = frame(
        "id int, s date, e date, a date, z date",
        (1, "2020-01-01", "2020-12-31", "2020-04-15", "2020-05-20"),
        (2, "2020-04-10", None, "2019-01-01", "2030-01-01"),
        (3, "2020-04-10", "2020-04-20", "2020-07-01", "2020-08-01"),
        (4, "2020-04-10", "2020-04-20", "2020-01-01", "2020-03-30"),
        (5, None, None, "2020-04-15", "2020-05-20"),
    )
    s, e = ranges.clip_to_window(F.col("s"), F.col("e"), "2020-04-01", "2020-06-30")
    window = df.select("id", s.alias("s"), e.alias("e"), "a", "z")
    cs, ce = ranges.clip_to_auth(F.col("s"), F.col("e"), F.col("a"), F.col("z"), "2020-04-01", "2020-06-30")
    held = window.select("id", cs.alias("s"), ce.alias("e"))
    days = ranges.inclusive_days(F.col("s"), F.col("e"))
    assert rows(held.select("id", "s", "e", days.alias("d"))) == [
        (1, "2020-04-15", "2020-05-20", 36),
        (2, "2020-04-10", "2020-06-30", 82),
        (3, None, None, None),
        (4, None, None, None),
        (5, None, "2020-05-20", None),
    ]


def test_backward_range_has_no_days_but_touching_one_has_zero(frame):
    df = frame("s date, e date", ("2020-01-05", "2020-01-03"), ("2020-01-05", "2020-01-04"))
    assert rows(df.select(ranges.inclusive_days(F.col("s"), F.col("e")))) == [(0,), (None,)]


def test_calendar_month(frame):
    df = frame(
        "id int, s date, e date", (1, "2020-03-01", "2020-03-31"), (2, "2020-03-02", "2020-04-29"),
        (3, "2020-04-02", "2020-05-31"), (4, None, "2020-12-31"),
    )
    hit = ranges.covers_calendar_month(F.col("s"), F.col("e"), "2020-03-01")
    assert rows(df.select("id", hit.alias("h"))) == [(1, 1), (2, 0), (3, 1), (4, 0)]


def test_expected_hours_cut_the_daily_rate(frame):
    df = frame("d int, h decimal(6,3)", (3, Decimal("6.125")), (91, Decimal("10.750")), (None, Decimal("1")), (5, None))
    out = df.select("d", decimals.expected_hours(F.col("d"), F.col("h")).alias("x"))
    # 3 days of 0.2041666 are 0.6124998; an uncut rate would round to 0.613.
    assert dict(rows(out)) == {
        3: Decimal("0.612"), 91: Decimal("32.608"), None: Decimal("0.000"), 5: Decimal("0.000"),
    }


def test_micro_hours_cut_each_service(frame):
    df = frame("m int", (20,), (40,), (60,), (1,))
    assert sorted(v for (v,) in rows(df.select(decimals.micro_hours(F.col("m"))))) == [
        16666, 333333, 666666, 1000000,
    ]
