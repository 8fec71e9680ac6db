"""Configuration tables and dates of the check queries, shared by Spark and SQL."""

from __future__ import annotations

from datetime import date, datetime

CALC = date(1999, 1, 15)
Q_START, Q_END = date(1999, 1, 1), date(1999, 3, 31)
SDA_START, SDA_END = date(1998, 9, 1), date(1998, 11, 30)
SINCE = date(1998, 1, 1)
RESET_QUARTER = date(1998, 7, 1)
NOW = datetime(1999, 1, 15, 6, 30)

ALWAYS = "DATE '1990-01-01', DATE '2099-12-31'"
OLD = "DATE '1990-01-01', DATE '1998-12-31'"
NEW = "DATE '1999-01-01', DATE '2099-12-31'"

PROGRAMS = ["400", "401", "MOP"]
AGES = ["A", "C", "G"]

# (metric, low, high, score); values between the ranges score nothing.
ADULT_LINES = [("LOCUS", 1, 19, 1), ("LOCUS", 20, 49, 3), ("LOCUS", 60, 119, 5.5), ("LOCUS", 120, 9999, 8)]
CHILD_LINES = [("CALOC", 1, 29, 2), ("CALOC", 30, 79, 4.25), ("CALOC", 90, 9999, 7.5), ("FOSTR", 1, 1, 3)]
SHARED_LINES = [
    ("HMLES", 1, 1, 4), ("CHRON", 1, 1, 1.5), ("CHRON", 2, 4, 3), ("HUTIL", 1, 2, 2),
    ("HUTIL", 3, 9999, 4.5), ("NUMCJ", 1, 9999, 2), ("LNGCJ", 1, 1, 1.25),
]


def _model() -> list[str]:
    rows = []
    for program in PROGRAMS:
        for age in AGES:
            own = CHILD_LINES if age == "C" else ADULT_LINES
            for metric, low, high, score in own + SHARED_LINES:
                key = f"'{program}', '{age}', '{metric}', {low}, {high}"
                rows.append(f"({key}, {score + 1}, {OLD})")
                rows.append(f"({key}, {score}, {NEW})")
    # The payer-less program has one more line, which shares the end point of another.
    rows.append(f"('MOP', 'A', 'LOCUS', 49, 55, 2, {ALWAYS})")
    return rows


def _tiers() -> list[str]:
    rows = []
    levels = [("L", 0, 9, 2.5), ("M", 9.001, 14, 6.125), ("H", 14.001, 9999, 10.75)]
    for program in PROGRAMS:
        for age in AGES:
            for level, low, high, hours in levels:
                key = f"'{program}', '{age}', {low}, {high}, '{level}'"
                if age == "C":
                    rows.append(f"({key}, {hours}, {OLD})")
                    rows.append(f"({key}, {hours + 1.001}, {NEW})")
                else:
                    rows.append(f"({key}, {hours}, {ALWAYS})")
    return rows


def _corridors() -> list[str]:
    bands = [(0, 0.499, 0.85), (0.5, 0.799, 0.925), (0.85, 1.1, 1), (1.101, 9999, 1.075)]
    return [
        f"('{program}', '{age}', {low}, {high}, {rate})"
        for program in ("400", "401", "S01")
        for age in AGES
        for low, high, rate in bands
    ]


METRICS = ["LOCUS", "CALOC", "FOSTR", "HMLES", "CHRON", "HUTIL", "NUMCJ", "LNGCJ"]

_TEXT = "VARCHAR(20)"
_NUM = "DECIMAL(18,3)"
_SPECS = {
    "cd_stratum_metric": (
        {"metric": _TEXT, "start_date": "DATE", "end_date": "DATE"},
        [f"('{m}  ', {ALWAYS})" for m in METRICS]
        + [f"('LOCUS', {NEW})", f"('ASAM', {OLD})", f"('OTHER', {ALWAYS})"],
    ),
    "cd_stratum_pop_model": (
        {"program": _TEXT, "age_group": _TEXT, "metric": _TEXT, "range_low": _NUM,
         "range_high": _NUM, "score": _NUM, "start_date": "DATE", "end_date": "DATE"},
        _model(),
    ),
    "cd_stratum_tier": (
        {"program": _TEXT, "age_group": _TEXT, "range_low": _NUM, "range_high": _NUM,
         "strat_level": _TEXT, "svc_hrs_req": "DECIMAL(6,3)", "start_date": "DATE",
         "end_date": "DATE"},
        _tiers(),
    ),
    "cd_stratum_pay_corridor": (
        {"program": _TEXT, "age_group": _TEXT, "sda_low": _NUM, "sda_high": _NUM,
         "sda_pay_multiplier": "DECIMAL(6,3)"},
        _corridors(),
    ),
}


def config_sql(name: str) -> str:
    """One configuration table as a SELECT that both engines understand."""
    columns, rows = _SPECS[name]
    casts = ", ".join(
        c if kind == _TEXT else f"CAST({c} AS {kind}) AS {c}" for c, kind in columns.items()
    )
    return f"SELECT {casts} FROM (VALUES {', '.join(rows)}) AS t({', '.join(columns)})"


CONFIG_TABLES = list(_SPECS)
