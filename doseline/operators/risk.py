"""Risk inputs: each attaches its columns and its missing-data flag to the population."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseline.functions.codes import (
    ADULT_ASSESSED,
    ASSESSED_CODES,
    CHILD_ASSESSED,
    CLAIM_CODES,
    CRISIS_PROGRAMS,
    CVD_CLAIM_CODES,
    FOSTER_COVERAGE,
    FOSTER_RESIDENCES,
    HELD_STATUSES,
    HOMELESS_RESIDENCE,
    HOSPITAL_CLASSES,
    INJECTION_METHOD,
    INPATIENT_PROGRAM,
    INVOLUNTARY,
    OUTPATIENT_ASSESSMENT,
    missing_flag,
)
from doseline.functions.dates import as_date, year_boundaries
from doseline.functions.ranges import overlaps
from doseline.operators.intervals import merge_intervals
from doseline.operators.lookups import (
    attach,
    latest_by,
    latest_state,
    latest_with_fallback,
    limited,
    lookup,
    presence_flag,
)

Day = date | str | Column
CONDITIONS = ["asthma", "diabetes", "copd", "cvd"]
UTILIZATION = ["nSRS", "nDTX", "nITA", "nED", "nIP"]


def _months(day: Day, months: int) -> Column:
    return F.add_months(as_date(day), months)


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace nulls by 0 in the named columns."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols})


def _flag_no(*names: str) -> dict[str, Column]:
    return {f"{name}_missing_data": F.lit("N") for name in names}


# --- Assessments ----------------------------------------------------------------------


def latest_scores(scores: DataFrame, calc: Day) -> DataFrame:
    """Latest assessment per person and agency, dated up to three months after `calc`."""
    known = scores.where(F.col("event_date") <= _months(calc, 3)).select(
        "kcid", "agency_id", "event_date", "record_id", "composite_score"
    )
    return latest_by(known, ["kcid", "agency_id"], [F.desc("event_date"), F.desc("record_id")])


def _with_flag(scored: DataFrame, alias: str, programs: list[str], ages: list[str]) -> DataFrame:
    flag = missing_flag(F.col(alias), F.col("program"), F.col("age_group"), programs, ages)
    return zero_fill(scored.withColumn(f"{alias}_missing_data", flag), [alias])


def _attach_score(pop: DataFrame, own: DataFrame, other: DataFrame, alias: str) -> DataFrame:
    return latest_with_fallback(pop, own, other, "kcid", "agency_id", "composite_score", alias)


def adult_assessment(pop: DataFrame, adult: DataFrame, calc: Day) -> DataFrame:
    """LOCUS: own agency's latest adult score, else the person's latest anywhere, else 0."""
    latest = latest_scores(adult, calc)
    return _with_flag(_attach_score(pop, latest, latest, "LOCUS"), "LOCUS", ADULT_ASSESSED, ["A", "G"])


def child_assessment(pop: DataFrame, child: DataFrame, adult: DataFrame, calc: Day) -> DataFrame:
    """CALOC: own agency's latest child score, else the latest adult score, else 0."""
    own, other = latest_scores(child, calc), latest_scores(adult, calc)
    return _with_flag(_attach_score(pop, own, other, "CALOC"), "CALOC", CHILD_ASSESSED, ["C"])


def assessments(pop: DataFrame, adult: DataFrame, child: DataFrame, calc: Day) -> DataFrame:
    """LOCUS and CALOC together.

    The same as one after the other, but both agency scores are joined before the score
    from anywhere, so the population is shuffled twice and not four times.
    """
    adults, children = (limited(latest_scores(t, calc), pop, "kcid") for t in (adult, child))
    keys = ["kcid", "agency_id"]
    anywhere = latest_by(adults, ["kcid"], [F.desc("event_date"), F.asc("agency_id")])
    scored = (
        pop.join(adults.select(*keys, F.col("composite_score").alias("_adult")), keys, "left")
        .join(children.select(*keys, F.col("composite_score").alias("_child")), keys, "left")
        .join(anywhere.select("kcid", F.col("composite_score").alias("_any")), "kcid", "left")
        .withColumns(
            {"LOCUS": F.coalesce("_adult", "_any"), "CALOC": F.coalesce("_child", "_any")}
        )
        .drop("_adult", "_child", "_any")
    )
    flagged = _with_flag(scored, "LOCUS", ADULT_ASSESSED, ["A", "G"])
    return _with_flag(flagged, "CALOC", CHILD_ASSESSED, ["C"])


# --- Residence and coverage -----------------------------------------------------------


def foster_history(pop: DataFrame, residence: DataFrame, coverage: DataFrame, calc: Day) -> DataFrame:
    """FOSTR: ever lived in foster care, or covered as such up to a month after `calc`."""
    homes = residence.where(F.col("resid_arrng_code").isin(FOSTER_RESIDENCES)).select("kcid")
    covered = coverage.where(
        (F.col("plan_type") == FOSTER_COVERAGE) & (F.col("start_date") <= _months(calc, 1))
    ).select("kcid")
    flagged = presence_flag(pop, [homes, covered], "kcid", "FOSTR")
    return flagged.withColumns(_flag_no("FOSTR"))


def homeless_state(residence: DataFrame, calc: Day) -> DataFrame:
    """Per person, whether the latest residence up to a month after `calc` is homelessness."""
    known = residence.where(F.col("start_date") <= _months(calc, 1))
    homeless = F.col("resid_arrng_code") == HOMELESS_RESIDENCE
    return latest_state(known, "kcid", "start_date", homeless, "HMLES")


def homeless_now(pop: DataFrame, residence: DataFrame, calc: Day) -> DataFrame:
    """HMLES: homeless at the latest known residence."""
    state = limited(homeless_state(residence, calc), pop, "kcid")
    flagged = attach(pop, state, ["kcid"], {"HMLES": 0})
    return flagged.withColumns(_flag_no("HMLES"))


# --- Chronic conditions ---------------------------------------------------------------


def _coverage_rows(eligibility: DataFrame, calc: Day, years: int) -> DataFrame:
    in_lookback = overlaps(
        F.col("from_date"), F.col("to_date"), _months(calc, -12 * years), calc
    )
    return eligibility.where(in_lookback).select("id_mcaid", F.lit(1).alias("elig"))


def _claim_rows(claims: DataFrame, calc: Day, years: int) -> DataFrame:
    recent = F.col("first_service_date").between(_months(calc, -12 * years), as_date(calc))
    return claims.where(recent).select("id_mcaid", F.lit(1).alias("claim"))


def _eligible_ids(rows: list[DataFrame], extra: list[str]) -> DataFrame:
    # All sources are stacked and reduced by one aggregate: one shuffle, no joins.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    peaks = [F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ["elig", "claim", *extra]]
    flag = F.when(F.col("claim") == 1, "N").otherwise("Y")
    return (
        stacked.groupBy("id_mcaid")
        .agg(*peaks)
        .where(F.col("elig") == 1)
        .select(F.col("id_mcaid").alias("p1_id"), *extra, flag.alias("CHRON_missing_data"))
    )


def coverage_missing_flag(
    eligibility: DataFrame, claims: DataFrame, calc: Day, years: int = 2
) -> DataFrame:
    """Ids eligible in the look-back; Y unless a claim falls into it too."""
    return _eligible_ids(
        [_coverage_rows(eligibility, calc, years), _claim_rows(claims, calc, years)], []
    )


def condition_flags(
    conditions: DataFrame, eligibility: DataFrame, claims: DataFrame, calc: Day, years: int = 2
) -> DataFrame:
    """Claim-based condition flags of the eligible ids, with their missing-data flag."""
    code = F.col("ccw_desc")
    flags = {
        "ccw_diabetes": code == "ccw_diabetes",
        "ccw_cvd": code.isin(CVD_CLAIM_CODES),
        "ccw_asthma": code == "ccw_asthma",
        "ccw_copd": code == "ccw_copd",
    }
    diagnosed = conditions.where(
        code.isin(CLAIM_CODES) & (F.col("from_date") <= as_date(calc))
    ).select("id_mcaid", *[is_it.cast("int").alias(name) for name, is_it in flags.items()])
    rows = [_coverage_rows(eligibility, calc, years), _claim_rows(claims, calc, years), diagnosed]
    return _eligible_ids(rows, list(flags))


def assessed_flags(assessed: DataFrame) -> DataFrame:
    """Per authorization, one 0/1 column per condition found by care assessment."""
    code = F.col("condition_code")
    return assessed.groupBy("auth_no").agg(
        *[
            F.coalesce(F.max((code == value).cast("int")), F.lit(0)).alias(f"caa_{name}")
            for value, name in ASSESSED_CODES.items()
        ]
    )


def assessed_conditions(pop: DataFrame, assessed: DataFrame) -> DataFrame:
    """Attach the care-assessment flags, 0 where none was made."""
    columns = {f"caa_{name}": 0 for name in ASSESSED_CODES.values()}
    return attach(pop, limited(assessed_flags(assessed), pop, "auth_no"), ["auth_no"], columns)


def chronic_conditions(
    pop: DataFrame,
    assessed: DataFrame,
    conditions: DataFrame,
    eligibility: DataFrame,
    claims: DataFrame,
    calc: Day,
) -> DataFrame:
    """Condition flags from either source, and CHRON, how many of the four apply.

    Assessed flags follow the authorization, so they hold without a Medicaid id; claim
    flags follow the id, and without one the flag stays Y.
    """
    claimed = limited(condition_flags(conditions, eligibility, claims, calc), pop, "p1_id")
    both = lookup(assessed_conditions(pop, assessed), claimed, "p1_id", "p1_id", "auth_no")
    either = {
        c: F.greatest(F.col(f"caa_{c}"), F.coalesce(F.col(f"ccw_{c}"), F.lit(0))) for c in CONDITIONS
    }
    total = reduce(Column.__add__, [F.col(c) for c in CONDITIONS])
    return (
        both.withColumns(either)
        .withColumns(
            {
                "CHRON": total,
                "CHRON_missing_data": F.coalesce("CHRON_missing_data", F.lit("Y")),
            }
        )
        .drop(*[f"{source}_{c}" for source in ("caa", "ccw") for c in CONDITIONS])
    )


# --- Utilization ----------------------------------------------------------------------


def crisis_events(auth: DataFrame, ip: DataFrame, calc: Day) -> DataFrame:
    """Crisis, withdrawal and involuntary stays that start or end in the last 12 months.

    A stay counts once per distinct inpatient type recorded for it.
    """
    lo, hi = _months(calc, -12), as_date(calc)
    program = F.col("program")
    recent = auth.where(
        program.isin(*CRISIS_PROGRAMS.values(), INPATIENT_PROGRAM)
        & F.col("status_code").isin(HELD_STATUSES)
        & (F.col("start_date").between(lo, hi) | F.col("expire_date").between(lo, hi))
    ).select("kcid", "auth_no", "program")
    # No type and an empty one are two types.
    involuntary = F.coalesce(F.col("ip_type") == INVOLUNTARY, F.lit(False))
    types = (
        ip.select("auth_no", "ip_type")
        .distinct()
        .groupBy("auth_no")
        .agg(F.count(F.lit(1)).alias("_types"), F.max(involuntary.cast("int")).alias("_ita"))
    )
    types = limited(types, recent, "auth_no")
    matched = attach(recent, types, ["auth_no"], {"_types": 1, "_ita": 0})
    counts = {
        name: F.when(program == code, F.col("_types")).otherwise(0)
        for name, code in CRISIS_PROGRAMS.items()
    }
    counts["nITA"] = F.when(program == INPATIENT_PROGRAM, F.col("_ita")).otherwise(0)
    return matched.select(
        "kcid",
        (program != INPATIENT_PROGRAM).cast("int").alias("_crisis"),
        *[amount.cast("long").alias(name) for name, amount in counts.items()],
    ).where((F.col("_crisis") == 1) | (F.col("nITA") == 1))


def crisis_counts(auth: DataFrame, ip: DataFrame, calc: Day) -> DataFrame:
    """nSRS, nDTX and nITA per person with any such stay."""
    names = ["nSRS", "nDTX", "nITA"]
    return (
        crisis_events(auth, ip, calc)
        .groupBy("kcid")
        .agg(*[F.sum(name).alias(name) for name in names])
    )


def hospital_events(hospital: DataFrame, calc: Day) -> DataFrame:
    """Hospital reports of the last 12 months as 0/1 per class."""
    recent = F.col("admit_date").between(_months(calc, -12), as_date(calc))
    return hospital.where(recent).select(
        "kcid",
        *[
            F.coalesce((F.col("major_class") == value).cast("long"), F.lit(0)).alias(name)
            for name, value in HOSPITAL_CLASSES.items()
        ],
    )


def hospital_counts(hospital: DataFrame, calc: Day) -> DataFrame:
    """nED and nIP per person reported by a hospital in the last 12 months."""
    events = hospital_events(hospital, calc)
    return events.groupBy("kcid").agg(*[F.sum(n).alias(n) for n in HOSPITAL_CLASSES])


def utilization(
    auth: DataFrame, ip: DataFrame, hospital: DataFrame, calc: Day, weights: DataFrame | None = None
) -> DataFrame:
    """The five counts and their sum HUTIL per person.

    The two sources are stacked and summed in one aggregate. `weights` (kcid, _weight)
    multiplies the crisis counts and limits them to the persons it lists.
    """
    stays = crisis_events(auth, ip, calc).drop("_crisis")
    if weights is not None:
        names = ["nSRS", "nDTX", "nITA"]
        stays = stays.groupBy("kcid").agg(*[F.sum(n).alias(n) for n in names])
        stays = stays.join(weights, "kcid").select(
            "kcid", *[(F.col(n) * F.col("_weight")).alias(n) for n in names]
        )
    events = stays.unionByName(hospital_events(hospital, calc), allowMissingColumns=True)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in UTILIZATION]
    total = reduce(Column.__add__, [F.col(name) for name in UTILIZATION])
    return events.groupBy("kcid").agg(*sums).withColumn("HUTIL", total)


def high_utilization(
    pop: DataFrame, auth: DataFrame, ip: DataFrame, hospital: DataFrame, calc: Day, literal: bool = False
) -> DataFrame:
    """Attach the utilization counts, 0 where there are none.

    `literal` counts a person's crisis stays once per authorization in the population.
    """
    weights = pop.groupBy("kcid").agg(F.count(F.lit(1)).alias("_weight")) if literal else None
    counts = limited(utilization(auth, ip, hospital, calc, weights), pop, "kcid")
    fill = dict.fromkeys([*UTILIZATION, "HUTIL"], 0)
    return attach(pop, counts, ["kcid"], fill).withColumns(_flag_no("HUTIL"))


# --- Criminal justice -----------------------------------------------------------------


def normalize_stays(jail: DataFrame, municipal: DataFrame, lo: Day, hi: Day) -> DataFrame:
    """Distinct stays of both sources touching [lo, hi]; an open stay ends where it starts."""

    def closed(df: DataFrame, person: str, start: str, end: str) -> DataFrame:
        # For an open stay the dates as stored decide alike, and can be filtered in the scan.
        return df.where(overlaps(F.col(start), F.col(end), lo, hi)).select(
            F.col(person).alias("kcid"),
            F.col(start).alias("book_date"),
            F.coalesce(F.col(end), F.col(start)).alias("release_date"),
        )

    matched = municipal.where(F.col("kcid_match").isNotNull())
    return (
        closed(jail, "kcid", "book_date", "release_date")
        .unionByName(closed(matched, "kcid_match", "booking_start", "booking_end"))
        .distinct()
    )


def stay_features(merged: DataFrame, calc: Day) -> DataFrame:
    """NUMCJ, stays ending in the last six months or later, and LNGCJ, any long stay."""
    recent = F.col("release_date") >= _months(calc, -6)
    long_stay = year_boundaries(F.col("book_date"), F.col("release_date")) >= 2
    return merged.groupBy("kcid").agg(
        F.sum(recent.cast("int")).alias("NUMCJ"),
        F.max(long_stay.cast("int")).alias("LNGCJ"),
    )


def justice_events(
    pop: DataFrame, jail: DataFrame, municipal: DataFrame, cutoff: Day, mode: str = "lag"
) -> DataFrame:
    """Attach NUMCJ and LNGCJ over the five years before the data-currency cutoff."""
    stays = limited(normalize_stays(jail, municipal, _months(cutoff, -60), cutoff), pop, "kcid")
    merged = merge_intervals(stays, ["kcid"], "book_date", "release_date", mode)
    features = attach(pop, stay_features(merged, cutoff), ["kcid"], {"NUMCJ": 0, "LNGCJ": 0})
    return features.withColumns(_flag_no("NUMCJ", "LNGCJ"))


# --- Substance use (not part of the quarterly run) ------------------------------------


def asam_level(pop: DataFrame, asam: DataFrame, calc: Day) -> DataFrame:
    """ASAM: the latest indicated outpatient level at the same agency, else 0.

    A suffix -WM is dropped and OTP stands for 5; other text fails the cast.
    """
    lo, hi = _months(calc, -24), _months(calc, 3)
    due = asam.where(
        F.col("event_date").between(lo, hi) & (F.col("event_type") == OUTPATIENT_ASSESSMENT)
    ).select("kcid", "agency_id", "event_date", "record_id", "level_indicated")
    latest = latest_by(due, ["kcid", "agency_id"], [F.desc("event_date"), F.desc("record_id")])
    text = F.replace(F.col("level_indicated"), F.lit("-WM"), F.lit(""))
    level = F.trim(F.replace(text, F.lit("OTP"), F.lit("5"))).cast("decimal(4,1)")
    levels = limited(latest.select("kcid", "agency_id", level.alias("ASAM")), pop, "kcid")
    return attach(pop, levels, ["kcid", "agency_id"], {"ASAM": 0}).withColumns(_flag_no("ASAM"))


def injection_use(pop: DataFrame, use: DataFrame, calc: Day) -> DataFrame:
    """IDU: injection reported between 365 days before and one month after `calc`.

    The latest report up to that month lies in the window exactly when any report does.
    """
    window = F.col("event_date").between(F.date_sub(as_date(calc), 365), _months(calc, 1))
    recent = use.where((F.col("method") == INJECTION_METHOD) & window).select("kcid")
    return presence_flag(pop, [recent], "kcid", "IDU").withColumns(_flag_no("IDU"))
