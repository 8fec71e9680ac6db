from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal as Dec

import numpy as np
import pytest
from conftest import day, rows

from doseline.operators import scoring
from doseline.sources.tables import trim_codes

ALWAYS = ("2000-01-01", "2099-12-31")


@pytest.fixture(scope="module")
def inputs(frame):
    return frame(
        """kcid long, auth_no long, program string, age_group string, calc_date date, age int,
        LOCUS int, LOCUS_missing_data string, HMLES int, HMLES_missing_data string, extra int""",
        (1, 11, "400", "A", "2020-06-15", 30, 10, "N", 1, "N", 0),
        (2, 21, "400", "A", "2020-06-15", 5, 15, "Y", 0, "N", 0),
        (3, 31, "400", None, "2020-06-15", 6, 20, "N", 1, "N", 0),
        (4, 41, "MOP", "A", "2020-06-15", None, 20, "N", 1, "N", 0),
    )


@pytest.fixture(scope="module")
def model(make):
    return trim_codes(make(
        "cd_stratum_pop_model",
        ("400", "A", "LOCUS  ", 1, 10, 2, *ALWAYS), ("400", "A", "LOCUS", 10, 12, 3, *ALWAYS),
        ("400", "A", "LOCUS", 20, 30, 9, *ALWAYS), ("400", "A", "HMLES", 1, 1, 4, "2000-01-01", "2020-06-14"),
        ("400", "A", "HMLES", 1, 1, 5, "2020-06-15", "2099-12-31"),
    ))


def test_active_metrics_trims_and_intersects(make):
    config = make(
        "cd_stratum_metric", ("LOCUS   ", *ALWAYS), ("LOCUS", *ALWAYS), ("HMLES", "2000-01-01", "2020-06-14"),
        ("OTHER", *ALWAYS),
    )
    assert scoring.metric_names(config, "2020-06-15", ["LOCUS", "HMLES"]) == ["LOCUS"]
    assert scoring.metric_names(config, "2020-06-14", ["LOCUS", "HMLES"]) == ["HMLES", "LOCUS"]


def test_score_lines_and_totals(inputs, model):
    long = scoring.to_score_input(inputs, ["LOCUS", "HMLES"])
    assert long.count() == 8
    twice = long.unionByName(long)
    kept = scoring.restrict_to_model(twice, model)
    assert rows(kept, "auth_no", "metric") == [(11, "HMLES"), (11, "LOCUS"), (21, "HMLES"), (21, "LOCUS")]
    lines = scoring.score_lines(twice, model)
    # 10 lies in two ranges that share it; 15 lies in none.
    assert rows(lines, "auth_no", "metric", "value", "score") == [
        (11, "HMLES", Dec("1.000"), Dec("5.000")), (11, "LOCUS", Dec("10.000"), Dec("2.000")),
        (11, "LOCUS", Dec("10.000"), Dec("3.000")), (21, "HMLES", Dec("0.000"), Dec("0.000")),
        (21, "LOCUS", Dec("15.000"), Dec("0.000")),
    ]
    totals = scoring.total_score(lines)
    assert rows(totals, "auth_no", "total_score", "missing_data") == [
        (11, Dec("10.000"), "N"), (21, Dec("0.000"), "Y"),
    ]


def test_totals_skip_null_keys(frame):
    lines = frame(
        "auth_no long, program string, age_group string, calc_date date, score decimal(18,3), missing_data string",
        (1, "400", None, "2020-06-15", Dec(1), "N"), (2, "400", "A", "2020-06-15", Dec(2), None),
    )
    assert rows(scoring.total_score(lines), "auth_no", "total_score", "missing_data") == [(2, Dec("2.000"), None)]


def test_tiers_and_young_children(inputs, make, frame):
    tiers = make(
        "cd_stratum_tier", ("400", "A", 0, 5, "L", 2.5, *ALWAYS), ("400", "A", 5.001, 20, "M", 6, *ALWAYS),
        ("400", "A", 5.001, 20, "X", 7, "2000-01-01", "2020-06-14"),
    )
    totals = frame(
        "auth_no long, program string, age_group string, calc_date date, total_score decimal(18,3), missing_data string",
        (11, "400", "A", "2020-06-15", Dec(5), "N"), (21, "400", "A", "2020-06-15", Dec(20), "Y"),
    )
    tiered = scoring.tier_lookup(totals, tiers)
    assert rows(tiered, "auth_no", "strat_level", "svc_hrs_req") == [
        (11, "L", Dec("2.500")), (21, "M", Dec("6.000")),
    ]
    leveled = scoring.assign_level(inputs, tiered)
    assert rows(leveled, "auth_no", "strat_level", "svc_hrs_req") == [
        (11, "L", Dec("2.500")), (21, "H", Dec("6.000")), (31, None, None), (41, None, None),
    ]
    assert rows(scoring.level_counts(leveled)) == [("H", 1), ("L", 1)]
    assert day(None) is None


def test_scores_in_the_row_equal_those_of_lines(inputs, model, make):
    tiers = make("cd_stratum_tier", ("400", "A", 0, 5, "L", 2.5, *ALWAYS), ("400", "A", 5.001, 20, "M", 6, *ALWAYS))
    metrics = ["LOCUS", "HMLES"]
    lines = scoring.score_lines(scoring.to_score_input(inputs, metrics), model)
    scored = scoring.score_in_row(inputs, metrics, model)
    assert scored.count() == inputs.count()
    assert rows(scoring.lines_of(scored).select(*lines.columns)) == rows(lines)
    want = scoring.assign_level(inputs, scoring.tier_lookup(scoring.total_score(lines), tiers))
    columns = ("kcid", "auth_no", "total_score", "missing_data", "strat_level", "svc_hrs_req")
    got = scoring.level_in_row(scored.drop("lines"), tiers)
    assert rows(got, *columns) == rows(want, *columns) and got.count() == 4
    plan = scoring.score_in_row(inputs, metrics, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Aggregate") == 1  # of the model


def test_random_scores_in_the_row(frame, make):
    draw = np.random.default_rng(4)
    flags, metrics = ["N", "Y", None], ["M1", "M2", "M3"]

    def entry():
        low = int(draw.integers(0, 20))
        first = date(2020, 1, 1) + timedelta(days=int(draw.integers(0, 300)))
        return (
            str(draw.choice(["400", "401"])), str(draw.choice(["A", "C"])), str(draw.choice(metrics + ["M9"])) + "  ",
            low, low + int(draw.integers(0, 9)), int(draw.integers(1, 9)), first, first + timedelta(days=200),
        )

    model = make("cd_stratum_pop_model", *[entry() for _ in range(60)])
    data = [
        (i, i, str(draw.choice(["400", "401", "402"])), [None, "A", "C"][draw.integers(3)],
         date(2020, 1, 1) + timedelta(days=int(draw.integers(0, 500))), 9,
         *[v for _ in metrics for v in (None if draw.random() < 0.1 else int(draw.integers(0, 30)), flags[draw.integers(3)])])
        for i in range(200)
    ]
    columns = ", ".join(f"{m} int, {m}_missing_data string" for m in metrics)
    people = frame(f"kcid long, auth_no long, program string, age_group string, calc_date date, age int, {columns}", *data)
    lines = scoring.score_lines(scoring.to_score_input(people, metrics), model)
    scored = scoring.score_in_row(people, metrics, model)
    assert rows(scoring.lines_of(scored).select(*lines.columns)) == rows(lines) != []
    totals = scoring.total_score(lines)
    known = scored.where("total_score IS NOT NULL")
    assert rows(known, *totals.columns) == rows(totals)


def test_overlapping_tiers_are_an_error(inputs, model, make):
    tiers = make("cd_stratum_tier", ("400", "A", 0, 20, "L", 2.5, *ALWAYS), ("400", "A", 5, 20, "M", 6, *ALWAYS))
    with pytest.raises(Exception, match="overlap"):
        scoring.level_in_row(scoring.score_in_row(inputs, ["LOCUS"], model), tiers).collect()
