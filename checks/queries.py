"""The registered check queries: one per operator, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from checks.config import CALC, NOW, Q_END, Q_START, RESET_QUARTER, SDA_END, SDA_START, SINCE
from checks.oracle import LE, LS, NOW as NOW_SQL, QE, QS, RESET_SQL, SINCE_SQL, _milli, _touch
from checks.proxies import Proxies
from doseline.functions import codes, dates, ranges
from doseline.functions.decimals import from_micro
from doseline.operators import dosage, intervals, linkage, lookups, population, publish, risk, scoring
from doseline.plans import quarter
from doseline.session import Stages, configure
from doseline.sources import services, tables
from doseline.sources.schemas import HISTORY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

POP_COLUMNS = (
    "kcid, auth_no, phs_start_date, phs_end_date, calc_date, agency_id, start_date, expire_date, "
    "program, current_program, tx_focus, age_group, special_population, language_differential, age, p1_id"
)


def check(name: str, sql: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a query built from the proxies, with the SQL it must equal."""

    def register(build: Callable[[Proxies], DataFrame]) -> Callable[[Proxies], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Proxies(configure(spark), sf_dir))

        QUERIES[name] = run
        SQL[name] = sql
        return build

    return register


# --- Shared steps ---------------------------------------------------------------------


def _pop(t: Proxies) -> DataFrame:
    return population.select_population(
        t["au_master"], t["g_person"], t["au_initial_plan"], t["case_rate"], t["au_stratum"],
        t["g_p1_client"], Q_START, Q_END, CALC,
    )


def _cutoff(t: Proxies) -> date:
    return population.currency_cutoff(t["muni_jail"], "booking_start", CALC).first()[0]


def _inputs(t: Proxies) -> DataFrame:
    pop = t.once("pop", lambda: _pop(t))
    return t.once("inputs", lambda: quarter.with_inputs(pop, t, CALC, quarter.Options()))


def _long(t: Proxies) -> DataFrame:
    inputs = _inputs(t)
    names = scoring.metric_names(t["cd_stratum_metric"], CALC, inputs.columns)
    return scoring.to_score_input(inputs, names)


def _lines(t: Proxies) -> DataFrame:
    return scoring.score_lines(_long(t), t["cd_stratum_pop_model"])


def _tiers(t: Proxies) -> DataFrame:
    return scoring.tier_lookup(scoring.total_score(_lines(t)), t["cd_stratum_tier"])


def _leveled(t: Proxies) -> DataFrame:
    return scoring.assign_level(_inputs(t), _tiers(t))


def _stays(t: Proxies) -> DataFrame:
    cutoff = _cutoff(t)
    return risk.normalize_stays(
        t["ep_jail"], t["muni_jail"], dates.months_after(cutoff, -60), cutoff
    )


def _merged(t: Proxies, mode: str = "lag") -> DataFrame:
    return intervals.merge_intervals(_stays(t), ["kcid"], "book_date", "release_date", mode)


def _active(t: Proxies, tier_as_of: date | None = None) -> DataFrame:
    return dosage.active_strata(
        t["members"], t["au_stratum"], t["cd_stratum_tier"], t["au_master"], SDA_START, SDA_END, tier_as_of
    )


def _clipped(t: Proxies) -> DataFrame:
    return dosage.clip_strata(_active(t), SDA_START, SDA_END)


def _daily(t: Proxies) -> DataFrame:
    return dosage.service_hours(t["ea_cpt_service"], SDA_START, SDA_END)


def _totals(t: Proxies) -> DataFrame:
    return dosage.auth_totals(dosage.with_expected(_clipped(t)), _daily(t))


def _linked(t: Proxies) -> DataFrame:
    return dosage.continued_from(_totals(t), t["au_master"], SDA_START)


def _dose(t: Proxies) -> DataFrame:
    return dosage.dose_totals(
        t["members"], t["au_stratum"], t["cd_stratum_tier"], t["au_master"],
        t["ea_cpt_service"], SDA_START, SDA_END,
        keep=t.keep,
    )


def _spanned(t: Proxies) -> DataFrame:
    return dosage.with_calendar_month(dosage.enrolment_span(_dose(t)), SDA_START)


def _complete(t: Proxies) -> DataFrame:
    leveled = _leveled(t)
    ratios = dosage.dose_ratio(
        t.once("pop", lambda: _pop(t)), t["au_stratum"], t["cd_stratum_tier"], t["au_master"],
        t["ea_cpt_service"], SDA_START, SDA_END,
        keep=t.keep,
    )
    return dosage.with_sda(leveled, ratios)


def _new_strata(t: Proxies) -> DataFrame:
    after = publish.highest_id(t["au_stratum"], "au_stratum_id")
    rows = t.once("stratum_rows", lambda: publish.stratum_rows(_complete(t)))
    return publish.new_strata(rows, after, NOW)


def _candidates(t: Proxies) -> DataFrame:
    return linkage.unlinked_strata(t["au_stratum"], t["au_master"], SINCE)


def _links(t: Proxies) -> DataFrame:
    return linkage.link_strata(
        t["au_stratum"], t["au_master"], t["au_stratum_sda"], t["cd_stratum_pay_corridor"], SINCE,
        keep=t.keep,
    )


# --- Periods and population -----------------------------------------------------------


@check(
    "reporting_periods",
    """SELECT auth_no, start_date, q AS pop_start, CAST(q + INTERVAL 3 MONTH AS DATE) - 1 AS pop_end,
    CAST(q - INTERVAL 4 MONTH AS DATE) AS sda_start, CAST(q - INTERVAL 1 MONTH AS DATE) - 1 AS sda_end
    FROM (SELECT *, CAST(date_trunc('quarter', start_date) AS DATE) AS q FROM auth)""",
)
def reporting_periods(t: Proxies) -> DataFrame:
    return dates.with_periods(t["au_master"].select("auth_no", "start_date"), "start_date")


@check("currency_cutoff", "SELECT cutoff_date FROM cutoff")
def currency_cutoff(t: Proxies) -> DataFrame:
    return population.currency_cutoff(t["muni_jail"], "booking_start", CALC)


@check(
    "program_recode",
    """SELECT auth_no, CASE WHEN program IN ('400','401') THEN program WHEN program = 'S01' THEN ''
    WHEN plan = 'F19' THEN '400' WHEN plan = 'MID' THEN '401' ELSE 'MOP' END AS program
    FROM auth JOIN plan USING (auth_no)""",
)
def program_recode(t: Proxies) -> DataFrame:
    joined = t["au_master"].join(t["au_initial_plan"], "auth_no", "left")
    return joined.select("auth_no", codes.recode_program(F.col("program"), F.col("plan")).alias("program"))


@check(
    "interval_overlap",
    f"""SELECT auth_no, CAST({_touch('start_date', 'expire_date', QS, QE)} AS INTEGER) AS in_quarter
    FROM auth""",
)
def interval_overlap(t: Proxies) -> DataFrame:
    hit = F.coalesce(ranges.overlaps(F.col("start_date"), F.col("expire_date"), Q_START, Q_END), F.lit(False))
    return t["au_master"].select("auth_no", hit.cast("int").alias("in_quarter"))


@check(
    "not_yet_stratified",
    f"SELECT auth_no FROM auth WHERE auth_no NOT IN (SELECT auth_no FROM au_stratum WHERE start_date = {QS})",
)
def not_yet_stratified(t: Proxies) -> DataFrame:
    return population.exclude_stratified(t["au_master"], t["au_stratum"], Q_START, Q_END).select("auth_no")


@check(
    "age_at_date",
    """SELECT auth_no, CAST(trunc((CAST(strftime(start_date, '%Y%m%d') AS INTEGER)
    - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) / 10000) AS INTEGER) AS age
    FROM auth LEFT JOIN person USING (kcid)""",
)
def age_at_date(t: Proxies) -> DataFrame:
    joined = t["au_master"].join(t["g_person"], "kcid", "left")
    return joined.select("auth_no", dates.age_at(F.col("dob"), F.col("start_date")).alias("age"))


@check("population", f"SELECT {POP_COLUMNS} FROM pop")
def population_query(t: Proxies) -> DataFrame:
    return _pop(t)


# --- Risk inputs ----------------------------------------------------------------------


@check(
    "latest_score",
    """SELECT kcid, agency_id, event_date, record_id, composite_score FROM own_scores
    WHERE event_type = 'click'""",
)
def latest_score(t: Proxies) -> DataFrame:
    return risk.latest_scores(t["ep_locus"], CALC)


@check(
    "latest_score_fallback",
    """SELECT kcid, a.agency_id, auth_no, coalesce(o.composite_score, x.composite_score) AS score
    FROM auth a LEFT JOIN (SELECT * FROM own_scores WHERE event_type = 'view') o USING (kcid, agency_id)
    LEFT JOIN any_scores x USING (kcid)""",
)
def latest_score_fallback(t: Proxies) -> DataFrame:
    own, other = risk.latest_scores(t["ep_calocus"], CALC), risk.latest_scores(t["ep_locus"], CALC)
    found = lookups.latest_with_fallback(
        t["au_master"], own, other, "kcid", "agency_id", "composite_score", "score"
    )
    return found.select("kcid", "agency_id", "auth_no", "score")


@check(
    "missing_flag",
    """SELECT auth_no, CASE WHEN program = 'S01' OR age_group NOT IN ('A','G') OR o.composite_score IS NOT NULL
    THEN 'N' ELSE 'Y' END AS missing_data
    FROM auth a JOIN case_rate c USING (kcid, auth_no)
    LEFT JOIN (SELECT * FROM own_scores WHERE event_type = 'click') o USING (kcid, agency_id)""",
)
def missing_flag(t: Proxies) -> DataFrame:
    own = risk.latest_scores(t["ep_locus"], CALC).select("kcid", "agency_id", "composite_score")
    scored = t["au_master"].join(t["case_rate"], ["kcid", "auth_no"]).join(own, ["kcid", "agency_id"], "left")
    flag = codes.missing_flag(
        F.col("composite_score"), F.col("program"), F.col("age_group"), codes.ADULT_ASSESSED, ["A", "G"]
    )
    return scored.select("auth_no", flag.alias("missing_data"))


@check("adult_assessment", f"SELECT {POP_COLUMNS}, LOCUS, LOCUS_missing_data FROM inputs")
def adult_assessment(t: Proxies) -> DataFrame:
    return risk.adult_assessment(t.once("pop", lambda: _pop(t)), t["ep_locus"], CALC)


@check("child_assessment", f"SELECT {POP_COLUMNS}, CALOC, CALOC_missing_data FROM inputs")
def child_assessment(t: Proxies) -> DataFrame:
    return risk.child_assessment(t.once("pop", lambda: _pop(t)), t["ep_calocus"], t["ep_locus"], CALC)


@check("foster_flag", f"SELECT {POP_COLUMNS}, FOSTR, 'N' AS FOSTR_missing_data FROM inputs")
def foster_flag(t: Proxies) -> DataFrame:
    return risk.foster_history(t.once("pop", lambda: _pop(t)), t["ep_residence"], t["ep_coverage_mco"], CALC)


@check("latest_state_flag", f"SELECT {POP_COLUMNS}, HMLES, 'N' AS HMLES_missing_data FROM inputs")
def latest_state_flag(t: Proxies) -> DataFrame:
    return risk.homeless_now(t.once("pop", lambda: _pop(t)), t["ep_residence"], CALC)


@check("condition_pivot", "SELECT * FROM condition_pivot")
def condition_pivot(t: Proxies) -> DataFrame:
    return risk.condition_flags(
        t["mcaid_claim_ccw"], t["mcaid_elig_timevar"], t["mcaid_claim_header"], CALC
    )


@check("coverage_flag", "SELECT id AS p1_id, flag AS CHRON_missing_data FROM covered")
def coverage_flag(t: Proxies) -> DataFrame:
    return risk.coverage_missing_flag(t["mcaid_elig_timevar"], t["mcaid_claim_header"], CALC)


@check(
    "assessed_conditions",
    f"SELECT {POP_COLUMNS}, caa_asthma, caa_diabetes, caa_copd, caa_cvd FROM assessed_pop",
)
def assessed_conditions(t: Proxies) -> DataFrame:
    return risk.assessed_conditions(t.once("pop", lambda: _pop(t)), t["ma_cond_ass"])


@check(
    "chronic_conditions",
    f"""SELECT {POP_COLUMNS}, CHRON_missing_data, asthma, diabetes, copd, cvd, CHRON FROM inputs""",
)
def chronic_conditions(t: Proxies) -> DataFrame:
    return risk.chronic_conditions(
        t.once("pop", lambda: _pop(t)), t["ma_cond_ass"], t["mcaid_claim_ccw"], t["mcaid_elig_timevar"],
        t["mcaid_claim_header"], CALC,
    )


@check("utilization_counts", "SELECT kcid, nSRS, nDTX, nITA FROM crisis")
def utilization_counts(t: Proxies) -> DataFrame:
    return risk.crisis_counts(t["crisis_au_master"], t["ip_master"], CALC)


@check("hospital_counts", "SELECT kcid, nED, nIP FROM hospital_counts")
def hospital_counts(t: Proxies) -> DataFrame:
    return risk.hospital_counts(t["cmt_hospital_report"], CALC)


@check(
    "high_utilization",
    f"""SELECT {POP_COLUMNS}, nSRS, nDTX, nITA, nED, nIP, HUTIL, 'N' AS HUTIL_missing_data FROM inputs""",
)
def high_utilization(t: Proxies) -> DataFrame:
    return risk.high_utilization(
        t.once("pop", lambda: _pop(t)), t["crisis_au_master"], t["ip_master"], t["cmt_hospital_report"], CALC
    )


@check(
    "high_utilization_literal",
    f"""SELECT {POP_COLUMNS}, nSRS, nDTX, nITA, nED, nIP, nSRS + nDTX + nITA + nED + nIP AS HUTIL,
    'N' AS HUTIL_missing_data FROM (
      SELECT p.*, coalesce(c.nSRS, 0) * n AS nSRS, coalesce(c.nDTX, 0) * n AS nDTX,
        coalesce(c.nITA, 0) * n AS nITA, coalesce(h.nED, 0) AS nED, coalesce(h.nIP, 0) AS nIP
      FROM (SELECT *, count(*) OVER (PARTITION BY kcid) AS n FROM pop) p
      LEFT JOIN crisis c USING (kcid) LEFT JOIN hospital_counts h USING (kcid))""",
)
def high_utilization_literal(t: Proxies) -> DataFrame:
    """Crisis stays counted once per authorization of the person in the population."""
    return risk.high_utilization(
        t.once("pop", lambda: _pop(t)), t["crisis_au_master"], t["ip_master"], t["cmt_hospital_report"], CALC, True
    )


@check("stays_union", "SELECT kcid, book_date, release_date FROM stays")
def stays_union(t: Proxies) -> DataFrame:
    return _stays(t)


@check("merge_intervals_lag", "SELECT * FROM merged")
def merge_intervals_lag(t: Proxies) -> DataFrame:
    return _merged(t)


@check("merge_intervals_runmax", "SELECT * FROM merged_runmax")
def merge_intervals_runmax(t: Proxies) -> DataFrame:
    return _merged(t, "runmax")


@check("stay_features", "SELECT * FROM stay_features")
def stay_features(t: Proxies) -> DataFrame:
    return risk.stay_features(_merged(t), _cutoff(t))


@check(
    "justice_events",
    f"""SELECT {POP_COLUMNS}, NUMCJ, LNGCJ, 'N' AS NUMCJ_missing_data, 'N' AS LNGCJ_missing_data
    FROM inputs""",
)
def justice_events(t: Proxies) -> DataFrame:
    return risk.justice_events(t.once("pop", lambda: _pop(t)), t["ep_jail"], t["muni_jail"], _cutoff(t))


@check(
    "asam_level",
    f"""SELECT {POP_COLUMNS}, CAST(coalesce(level, 0) AS DECIMAL(4,1)) AS ASAM, 'N' AS ASAM_missing_data
    FROM pop LEFT JOIN asam_latest USING (kcid, agency_id)""",
)
def asam_level(t: Proxies) -> DataFrame:
    return risk.asam_level(t.once("pop", lambda: _pop(t)), t["ep_asam_placement"], CALC)


@check(
    "recent_event_flag",
    f"""SELECT {POP_COLUMNS}, CASE WHEN kcid IN (SELECT kcid FROM (
        SELECT kcid, max(event_date) AS latest FROM injection WHERE event_date <= DATE '1999-02-15'
        GROUP BY kcid) WHERE latest >= DATE '1998-01-15') THEN 1 ELSE 0 END AS IDU,
    'N' AS IDU_missing_data FROM pop""",
)
def recent_event_flag(t: Proxies) -> DataFrame:
    return risk.injection_use(t.once("pop", lambda: _pop(t)), t["ep_substance_use"], CALC)


@check(
    "inputs_with_substance",
    f"""SELECT {POP_COLUMNS}, LOCUS, CALOC, FOSTR, HMLES, CHRON, HUTIL, NUMCJ, LNGCJ,
    CAST(coalesce(level, 0) AS DECIMAL(4,1)) AS ASAM,
    CASE WHEN kcid IN (SELECT kcid FROM (
        SELECT kcid, max(event_date) AS latest FROM injection WHERE event_date <= DATE '1999-02-15'
        GROUP BY kcid) WHERE latest >= DATE '1998-01-15') THEN 1 ELSE 0 END AS IDU
    FROM inputs LEFT JOIN asam_latest USING (kcid, agency_id)""",
)
def inputs_with_substance(t: Proxies) -> DataFrame:
    """All risk inputs of the job, those for substance use included."""
    pop = t.once("pop", lambda: _pop(t))
    columns = [c.strip() for c in POP_COLUMNS.split(",")]
    metrics = ["LOCUS", "CALOC", "FOSTR", "HMLES", "CHRON", "HUTIL", "NUMCJ", "LNGCJ", "ASAM", "IDU"]
    return quarter.with_inputs(pop, t.all(), CALC, quarter.Options(substance_inputs=True)).select(*columns, *metrics)


# --- Scoring --------------------------------------------------------------------------


@check(
    "active_metrics",
    """SELECT metric, count(*) AS n_lines, CAST(sum(value) AS DECIMAL(28,3)) AS sum_value
    FROM long WHERE metric IN (SELECT metric FROM metrics) GROUP BY metric""",
)
def active_metrics(t: Proxies) -> DataFrame:
    active = scoring.active_metrics(t["cd_stratum_metric"], CALC, _inputs(t).columns)
    return (
        _long(t)
        .join(active, "metric", "left_semi")
        .groupBy("metric")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("value").alias("sum_value"))
    )


@check("unpivot_metrics", "SELECT * FROM long")
def unpivot_metrics(t: Proxies) -> DataFrame:
    return _long(t)


@check("model_restrict", "SELECT * FROM restricted")
def model_restrict(t: Proxies) -> DataFrame:
    return scoring.restrict_to_model(_long(t), t["cd_stratum_pop_model"])


@check("score_lines", "SELECT * FROM lines")
def score_lines(t: Proxies) -> DataFrame:
    return _lines(t)


@check("total_score", "SELECT * FROM totals")
def total_score(t: Proxies) -> DataFrame:
    return scoring.total_score(_lines(t))


@check("tier_lookup", "SELECT * FROM tiered")
def tier_lookup(t: Proxies) -> DataFrame:
    return _tiers(t)


@check(
    "assign_level",
    "SELECT kcid, auth_no, age, total_score, missing_data, strat_level, svc_hrs_req FROM leveled",
)
def assign_level(t: Proxies) -> DataFrame:
    return _leveled(t).select(
        "kcid", "auth_no", "age", "total_score", "missing_data", "strat_level", "svc_hrs_req"
    )


@check(
    "level_counts",
    """SELECT strat_level, count(*) AS "count" FROM leveled WHERE strat_level IS NOT NULL GROUP BY 1""",
)
def level_counts(t: Proxies) -> DataFrame:
    return scoring.level_counts(_leveled(t))


def _in_row(t: Proxies) -> DataFrame:
    inputs = _inputs(t)
    names = scoring.metric_names(t["cd_stratum_metric"], CALC, inputs.columns)
    return scoring.score_in_row(inputs, names, t["cd_stratum_pop_model"])


@check("scores_in_row", "SELECT * FROM lines")
def scores_in_row(t: Proxies) -> DataFrame:
    """The score lines made inside the rows of the population."""
    return scoring.lines_of(_in_row(t))


@check(
    "levels_in_row",
    "SELECT kcid, auth_no, age, total_score, missing_data, strat_level, svc_hrs_req FROM leveled",
)
def levels_in_row(t: Proxies) -> DataFrame:
    """Total, flag and level made inside the rows of the population."""
    return scoring.level_in_row(_in_row(t).drop("lines"), t["cd_stratum_tier"]).select(
        "kcid", "auth_no", "age", "total_score", "missing_data", "strat_level", "svc_hrs_req"
    )


# --- Service-dose ratio ---------------------------------------------------------------


@check(
    "month_bounds",
    """SELECT auth_no, s AS mo1_start, last_day(s) AS mo1_end,
    CAST(s + INTERVAL 1 MONTH AS DATE) AS mo2_start, last_day(s + INTERVAL 1 MONTH) AS mo2_end,
    CAST(s + INTERVAL 2 MONTH AS DATE) AS mo3_start, last_day(s + INTERVAL 2 MONTH) AS mo3_end
    FROM (SELECT auth_no, CAST(date_trunc('quarter', start_date) - INTERVAL 4 MONTH AS DATE) AS s FROM auth)""",
)
def month_bounds(t: Proxies) -> DataFrame:
    periods = dates.with_periods(t["au_master"].select("auth_no", "start_date"), "start_date")
    bounds = dates.month_bounds(F.col("sda_start"))
    return periods.select("auth_no", *[c.alias(name) for name, c in bounds.items()])


STRATA_COLUMNS = (
    "kcid, auth_no, program, age_group, agency_id, auth_start, auth_expire, tx_focus, sda_start, "
    "sda_end, strat_level, svc_hrs_req"
)


@check("active_strata", f"SELECT {STRATA_COLUMNS} FROM a_active")
def active_strata(t: Proxies) -> DataFrame:
    return _active(t)


@check(
    "active_strata_dated",
    f"SELECT {STRATA_COLUMNS} FROM a_dated",
)
def active_strata_dated(t: Proxies) -> DataFrame:
    """Tier hours as they were valid on the calculation date."""
    return _active(t, CALC)


@check(
    "clip_to_window",
    f"""SELECT auth_no, greatest(least(start_date, {LE}), {LS}) AS sda_start,
    greatest(least(coalesce(expire_date, {LE}), {LE}), {LS}) AS sda_end FROM auth""",
)
def clip_to_window(t: Proxies) -> DataFrame:
    start, end = ranges.clip_to_window(F.col("start_date"), F.col("expire_date"), SDA_START, SDA_END)
    return t["au_master"].select("auth_no", start.alias("sda_start"), end.alias("sda_end"))


@check("clip_to_auth", f"SELECT {STRATA_COLUMNS} FROM a_clipped")
def clip_to_auth(t: Proxies) -> DataFrame:
    return _clipped(t)


@check("enroll_days", "SELECT kcid, auth_no, sda_start, sda_end, svc_hrs_req, enroll_days FROM a_costed")
def enroll_days(t: Proxies) -> DataFrame:
    days = ranges.inclusive_days(F.col("sda_start"), F.col("sda_end"))
    return _clipped(t).select(
        "kcid", "auth_no", "sda_start", "sda_end", "svc_hrs_req", days.alias("enroll_days")
    )


@check(
    "expected_hours",
    f"""SELECT kcid, auth_no, sda_start, sda_end, enroll_days, svc_hrs_req,
    {_milli('expected_units')} AS svc_hrs_expected FROM a_costed""",
)
def expected_hours(t: Proxies) -> DataFrame:
    return dosage.with_expected(_clipped(t)).select(
        "kcid", "auth_no", "sda_start", "sda_end", "enroll_days", "svc_hrs_req", "svc_hrs_expected"
    )


@check(
    "service_hours_daily",
    """SELECT auth_no, event_date, CAST(CAST(micro_hrs AS DECIMAL(20,0)) * 0.000001 AS DECIMAL(26,6)) AS svc_hrs
    FROM daily WHERE auth_no IN (SELECT auth_no FROM all_members)""",
)
def service_hours_daily(t: Proxies) -> DataFrame:
    daily = dosage.service_hours(
        t["ea_cpt_service"], SDA_START, SDA_END, t["members"].select("auth_no")
    )
    return daily.select("auth_no", "event_date", from_micro(F.col("micro_hrs")).alias("svc_hrs"))


def _kept_hours(t: Proxies) -> DataFrame:
    """The daily hours of the look-back, kept by month while the services come in three batches."""
    root = f"{t.stages().root}/services"
    # The view joins two tables, and each batch reads it twice.
    received = t.once("received_services", lambda: t["ea_cpt_service"])
    for number in range(3):
        part = received.where(F.pmod(F.hash("auth_no", "event_date"), F.lit(3)) == number)
        services.add_services(t.spark, part, root, f"batch-{number}")
        if number < 2:
            services.refresh_daily_hours(t.spark, root)
    services.refresh_daily_hours(t.spark, root)
    return services.read_daily_hours(t.spark, root, SDA_START, SDA_END)


@check("kept_daily_hours", SQL["service_hours_daily"])
def kept_daily_hours(t: Proxies) -> DataFrame:
    kept = _kept_hours(t).join(t["members"].select("auth_no").distinct(), "auth_no", "left_semi")
    return kept.select("auth_no", "event_date", from_micro(F.col("micro_hrs")).alias("svc_hrs"))


@check(
    "hours_in_interval",
    f"SELECT auth_no, sda_start, sda_end, n_strata, {_milli('hour_units')} AS svc_hrs FROM a_spans",
)
def hours_in_interval(t: Proxies) -> DataFrame:
    return dosage.hours_in_intervals(_clipped(t), _daily(t))


AUTH_COLUMNS = "kcid, auth_no, auth_start, auth_expire, agency_id, program, age_group, tx_focus"


@check(
    "auth_totals",
    f"""SELECT {AUTH_COLUMNS}, enroll_days, {_milli('expected_units')} AS svc_hrs_expected,
    {_milli('hour_units')} AS svc_hrs FROM a_sums""",
)
def auth_totals(t: Proxies) -> DataFrame:
    return _totals(t)


@check(
    "prior_episode",
    """SELECT kcid, auth_no, program, prev_auth_no, prev_auth_start, prev_auth_expire FROM a_linked""",
)
def prior_episode(t: Proxies) -> DataFrame:
    return _linked(t).select(
        "kcid", "auth_no", "program", "prev_auth_no", "prev_auth_start", "prev_auth_expire"
    )


@check(
    "prior_totals",
    f"""SELECT kcid, auth_no, prev_auth_no, enroll_days AS prev_enroll_days,
    {_milli('expected_units')} AS prev_svc_hrs_expected, {_milli('hour_units')} AS prev_svc_hrs FROM a_p_sums""",
)
def prior_totals(t: Proxies) -> DataFrame:
    linked = t.once("dose_current", lambda: _linked(t))
    prior = dosage.prior_strata(linked, t["au_stratum"], t["cd_stratum_tier"], SDA_START, SDA_END)
    clipped = dosage.clip_strata(prior, SDA_START, SDA_END, "prev_")
    return dosage.prior_totals(linked, dosage.with_expected(clipped), _daily(t))


@check(
    "enrolment_span",
    "SELECT kcid, auth_no, prev_auth_no, longest_start, longest_expire FROM a_dose",
)
def enrolment_span(t: Proxies) -> DataFrame:
    return dosage.enrolment_span(_dose(t)).select(
        "kcid", "auth_no", "prev_auth_no", "longest_start", "longest_expire"
    )


@check("calendar_month", "SELECT kcid, auth_no, calendar_month FROM a_months")
def calendar_month(t: Proxies) -> DataFrame:
    return _spanned(t).select("kcid", "auth_no", "calendar_month")


RATIO_COLUMNS = f"""kcid, auth_no, program, age_group, prev_auth_no, calendar_month,
    CAST(days AS INTEGER) AS enroll_days, {_milli('hours')} AS svc_hrs,
    {_milli('expected_units')} AS hrs_expected, {_milli('prorated_units')} AS svc_hrs_prorated"""


@check("prorated_hours", f"SELECT {RATIO_COLUMNS} FROM a_prorated")
def prorated_hours(t: Proxies) -> DataFrame:
    return dosage.prorate(_spanned(t))


@check("sda_from_kept_hours", f"SELECT {RATIO_COLUMNS}, {_milli('sda_units')} AS sda FROM a_ratio")
def sda_from_kept_hours(t: Proxies) -> DataFrame:
    """The ratio without reading the services, from daily hours kept by month."""
    return dosage.dose_ratio(
        t["members"], t["au_stratum"], t["cd_stratum_tier"], t["au_master"],
        t["ea_cpt_service"].where("false"), SDA_START, SDA_END, keep=t.keep, hours=_kept_hours(t),
    )


@check("sda", f"SELECT {RATIO_COLUMNS}, {_milli('sda_units')} AS sda FROM a_ratio")
def sda(t: Proxies) -> DataFrame:
    return dosage.dose_ratio(
        t["members"], t["au_stratum"], t["cd_stratum_tier"], t["au_master"],
        t["ea_cpt_service"], SDA_START, SDA_END, keep=t.keep,
    )


SDA_OUTPUT = (
    "kcid, auth_no, program, age_group, strat_level, total_score, prev_auth_no, calendar_month, "
    "enroll_days, hrs_expected, svc_hrs, svc_hrs_prorated, sda"
)


@check("with_sda", f"SELECT {SDA_OUTPUT} FROM complete")
def with_sda(t: Proxies) -> DataFrame:
    return _complete(t).select(*SDA_OUTPUT.split(", "))


# --- Linkage and payment rule ---------------------------------------------------------

CANDIDATE_COLUMNS = (
    "kcid, auth_no, agency_id, start_date, expire_date, tx_focus, au_stratum_id, phs_start_date, "
    "phs_end_date, age_group, strat_level, sda_rule"
)


@check("unlinked_strata", f"SELECT {CANDIDATE_COLUMNS} FROM h_cand")
def unlinked_strata(t: Proxies) -> DataFrame:
    return _candidates(t)


@check("link_current_sda", f"SELECT {CANDIDATE_COLUMNS}, stratum_sda_id, enroll_days FROM h_current")
def link_current_sda(t: Proxies) -> DataFrame:
    return linkage.link_current(_candidates(t), t["au_stratum_sda"])


@check("first_stratum", "SELECT auth_no, first_strat, strat_check_end FROM h_first")
def first_stratum(t: Proxies) -> DataFrame:
    return linkage.first_stratum(t["au_stratum"])


@check("last_stratum", "SELECT auth_no, last_strat, last_stratum_sda_id FROM h_last")
def last_stratum(t: Proxies) -> DataFrame:
    return linkage.last_stratum(t["au_stratum"], _candidates(t))


@check("link_prior_episode", f"SELECT {CANDIDATE_COLUMNS}, prev_auth_no, prev_auth_end FROM h_prior")
def link_prior_episode(t: Proxies) -> DataFrame:
    return linkage.link_prior(_candidates(t), t["au_master"])


@check(
    "prior_last_stratum",
    """SELECT au_stratum_id, prev_auth_no, pqd_strat, pqd_sda_id
    FROM h_prior LEFT JOIN h_latest ON h_latest.auth_no = prev_auth_no""",
)
def prior_last_stratum(t: Proxies) -> DataFrame:
    prior = linkage.link_prior(_candidates(t), t["au_master"])
    found = linkage.link_prior_stratum(prior, linkage.last_stratum(t["au_stratum"]))
    return found.select("au_stratum_id", "prev_auth_no", "pqd_strat", "pqd_sda_id")


def _settled_sql(strata: str) -> str:
    """First and last settled stratum per authorization, in SQL."""
    return f"""SELECT auth_no, min(start_date) AS first_date,
        first(strat_level ORDER BY start_date, au_stratum_id) AS first_strat,
        max(start_date) AS last_date,
        first(strat_level ORDER BY start_date DESC, au_stratum_id DESC) AS last_strat,
        first(stratum_sda_id ORDER BY start_date DESC, au_stratum_id DESC) AS last_stratum_sda_id
    FROM {strata} WHERE start_date IS NOT NULL AND (stratum_sda_id IS NOT NULL OR start_date < {SINCE_SQL})
    GROUP BY auth_no"""


def _flat_state(state: DataFrame) -> DataFrame:
    return state.select(
        "auth_no", F.col("first.start_date").alias("first_date"), F.col("first.strat_level").alias("first_strat"),
        F.col("last.start_date").alias("last_date"), F.col("last.strat_level").alias("last_strat"),
        F.col("last.stratum_sda_id").alias("last_stratum_sda_id"),
    )


@check("settled_state", _settled_sql("au_stratum"))
def settled_state(t: Proxies) -> DataFrame:
    """The state of settled strata, combined from those of single quarters."""
    strata, day = t["au_stratum"], F.col("start_date")
    parts = [day < RESET_QUARTER, day.between(RESET_QUARTER, Q_START), day > Q_START]
    first, *others = [linkage.settled_strata(strata.where(part), SINCE) for part in parts]
    for other in others:
        first = linkage.combined_states(first, other)
    return _flat_state(first)


@check(
    "stratum_endpoints",
    f"""SELECT a.auth_no, a.first_strat, s.last_strat, s.last_stratum_sda_id, a.pqd_strat, a.pqd_sda_id
    FROM (SELECT auth_no, first(strat_level ORDER BY start_date, au_stratum_id) AS first_strat,
            first(strat_level ORDER BY start_date DESC, au_stratum_id DESC) AS pqd_strat,
            first(stratum_sda_id ORDER BY start_date DESC, au_stratum_id DESC) AS pqd_sda_id
          FROM au_stratum WHERE start_date IS NOT NULL GROUP BY auth_no) a
    LEFT JOIN ({_settled_sql('au_stratum')}) s USING (auth_no)""",
)
def stratum_endpoints(t: Proxies) -> DataFrame:
    """The endpoints of all strata from the state and the awaiting strata alone."""
    strata = t["au_stratum"]
    found = linkage.endpoints_from_state(
        linkage.settled_strata(strata, SINCE), linkage.awaiting_strata(strata, SINCE), SINCE
    )
    return found.drop("strat_check_end")


RULE_COLUMNS = (
    "au_stratum_id, auth_no, phs_start_date, strat_level, first_strat, strat_check_end, last_strat, "
    "last_stratum_sda_id, prev_auth_no, pqd_strat, pqd_sda_id, enroll_days, new_sda_rule, new_stratum_sda_id"
)


@check("payment_rule", f"SELECT {RULE_COLUMNS} FROM h_ruled")
def payment_rule(t: Proxies) -> DataFrame:
    return _links(t).select(*RULE_COLUMNS.split(", "))


PAY_COLUMNS = "au_stratum_id, tx_focus, age_group, new_sda_rule, new_stratum_sda_id, new_sda, new_sda_pay_multiplier"


@check("pay_multiplier", f"SELECT {PAY_COLUMNS} FROM h_paid")
def pay_multiplier(t: Proxies) -> DataFrame:
    return _links(t).select(*PAY_COLUMNS.split(", "))


@check("apply_links", "SELECT * FROM h_applied")
def apply_links(t: Proxies) -> DataFrame:
    return linkage.apply_links(t["au_stratum"], _links(t), NOW)


# --- Publishing -----------------------------------------------------------------------


@check("stratum_rows", "SELECT * FROM stratum_rows")
def stratum_rows(t: Proxies) -> DataFrame:
    return publish.stratum_rows(_complete(t))


@check("append_strata", "SELECT * FROM new_strata")
def append_strata(t: Proxies) -> DataFrame:
    return _new_strata(t)


@check(
    "stratum_ids",
    f"SELECT au_stratum_id, auth_no FROM au_stratum WHERE {QS} BETWEEN start_date AND end_date",
)
def stratum_ids(t: Proxies) -> DataFrame:
    return publish.stratum_ids_on(t["au_stratum"], Q_START)


def _scores(t: Proxies) -> DataFrame:
    strata = t["au_stratum"].unionByName(_new_strata(t))
    return publish.score_rows(_lines(t), publish.stratum_ids_on(strata, Q_START))


@check("score_rows", "SELECT * FROM score_rows")
def score_rows(t: Proxies) -> DataFrame:
    return _scores(t)


@check(
    "append_scores",
    f"SELECT *, {NOW_SQL} AS post_stamp, CAST(NULL AS TIMESTAMP) AS modify_stamp FROM score_rows",
)
def append_scores(t: Proxies) -> DataFrame:
    return publish.new_scores(_scores(t), NOW)


@check("sda_rows", "SELECT * FROM sda_rows")
def sda_rows(t: Proxies) -> DataFrame:
    return publish.sda_rows(_complete(t))


@check(
    "sda_rows_quarter",
    f"""SELECT auth_no, {QS} AS start_date, {QE} AS end_date, sda, enroll_days, hrs_expected,
    svc_hrs, svc_hrs_prorated, prev_auth_no FROM complete""",
)
def sda_rows_quarter(t: Proxies) -> DataFrame:
    """Ratio records dated by the quarter."""
    return publish.sda_rows(_complete(t), "quarter")


@check("append_sda", "SELECT * FROM new_sda")
def append_sda(t: Proxies) -> DataFrame:
    after = publish.highest_id(t["au_stratum_sda"], "stratum_sda_id")
    rows = t.once("sda_rows", lambda: publish.sda_rows(_complete(t)))
    return publish.new_sda(rows, after, NOW)


@check("shadow_delta", f"SELECT * FROM au_stratum WHERE start_date >= {QS}")
def shadow_delta(t: Proxies) -> DataFrame:
    return publish.shadow_delta(t["au_stratum"], t["au_stratum_shadow"])


_RESET = f"(start_date = {RESET_SQL} AND sda_rule <> 'SHA')"


@check(
    "reset_payments",
    f"""SELECT * REPLACE (CASE WHEN {_RESET} THEN 'SHA' ELSE sda_rule END AS sda_rule,
    CASE WHEN {_RESET} THEN CAST(1 AS DECIMAL(6,3)) ELSE sda_pay_multiplier END AS sda_pay_multiplier)
    FROM au_stratum""",
)
def reset_payments(t: Proxies) -> DataFrame:
    return publish.reset_payments(t["au_stratum"], RESET_QUARTER)


def _job(t: Proxies, options: quarter.Options) -> dict[str, DataFrame]:
    return quarter.run_quarter(t.spark, t.all(), CALC, options, t.keep)


JOB = quarter.Options(now=NOW, linked_since=SINCE, reset_quarter=RESET_QUARTER)


@check("published_scores", "SELECT * FROM published_scores")
def published_scores(t: Proxies) -> DataFrame:
    """The score table as it stands after the quarter is published."""
    stored = t["au_stratum_score"]
    return stored.unionByName(tables.unwritten(_job(t, JOB)["scores"], stored, tables.KEYS["au_stratum_score"]))


@check("published_ratios", "SELECT * FROM published_ratios")
def published_ratios(t: Proxies) -> DataFrame:
    """The ratio table as it stands after the quarter is published."""
    stored = t["au_stratum_sda"]
    return stored.unionByName(tables.unwritten(_job(t, JOB)["ratios"], stored, tables.KEYS["au_stratum_sda"]))


@check("published_shadow", "SELECT * FROM published_shadow")
def published_shadow(t: Proxies) -> DataFrame:
    """The shadow table as it stands after the quarter is published."""
    stored = t["au_stratum_shadow"]
    return stored.unionByName(tables.unwritten(_job(t, JOB)["shadow"], stored, tables.KEYS["au_stratum_shadow"]))


@check(
    "published_strata",
    f"""SELECT * REPLACE (CASE WHEN {_RESET} THEN 'SHA' ELSE sda_rule END AS sda_rule,
    CASE WHEN {_RESET} THEN CAST(1 AS DECIMAL(6,3)) ELSE sda_pay_multiplier END AS sda_pay_multiplier)
    FROM n_applied""",
)
def published_strata(t: Proxies) -> DataFrame:
    """The stratum table with the quarters the run replaces, as publishing leaves it."""
    replaced = _job(t, JOB)["replaced"]
    dates = replaced.select(F.col("start_date").alias("_date")).distinct()
    return t["au_stratum"].join(dates, F.col("start_date") == F.col("_date"), "left_anti").unionByName(replaced)


@check(
    "quarter_run",
    f"""SELECT * REPLACE (CASE WHEN {_RESET} THEN 'SHA' ELSE sda_rule END AS sda_rule,
    CASE WHEN {_RESET} THEN CAST(1 AS DECIMAL(6,3)) ELSE sda_pay_multiplier END AS sda_pay_multiplier)
    FROM n_applied""",
)
def quarter_run(t: Proxies) -> DataFrame:
    """The whole quarter: the stratum table after scoring, dosing, linking and the reset."""
    return _job(t, JOB)["au_stratum"]


def _published_again(t: Proxies, table: str) -> DataFrame:
    """A table published by a job that died after it had appended the ratios, and was run again whole
    with the date of the next day."""
    root = f"{t.stages().root}/published"
    history = {name: t[name] for name in HISTORY}
    for name, df in history.items():
        tables.append_rows(df, root, name)
    inputs = {name: df for name, df in t.all().items() if name not in HISTORY}
    run = quarter.stage_quarter(t.spark, root, CALC, JOB, Stages(t.spark, f"{root}/_stages"), inputs)
    tables.append_new_rows(t.spark, quarter.staged_rows(t.spark, run)["ratios"], root, "au_stratum_sda")
    later = replace(JOB, now=None, as_of=CALC + timedelta(days=1))
    quarter.run_and_publish(t.spark, root, CALC, later, Stages(t.spark, f"{root}/_stages"), inputs)
    return tables.read_table(t.spark, root, table)


@check("rerun_scores", "SELECT * FROM published_scores")
def rerun_scores(t: Proxies) -> DataFrame:
    return _published_again(t, "au_stratum_score")


@check("rerun_ratios", "SELECT * FROM published_ratios")
def rerun_ratios(t: Proxies) -> DataFrame:
    return _published_again(t, "au_stratum_sda")


@check("rerun_strata", SQL["published_strata"])
def rerun_strata(t: Proxies) -> DataFrame:
    return _published_again(t, "au_stratum")


@check("population_bucketed", f"SELECT {POP_COLUMNS} FROM pop")
def population_bucketed(t: Proxies) -> DataFrame:
    """The population from tables that were dealt by their keys when they were ingested."""
    root = f"{t.stages().root}/bucketed"
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    names = ("au_master", "au_initial_plan", "case_rate", "g_person", "g_p1_client")
    for name in names:
        tables.ingest_table(t[name], root, name, buckets)
    dealt = {name: tables.read_table(t.spark, root, name) for name in names}
    return quarter.population_of({**t.all(), **dealt}, dates.Periods.of(CALC), CALC)


LATER_STATUS = "auth_no % 5 = 0"  # authorizations that are delivered again, closed, after the quarter's run


def _received(t: Proxies) -> str:
    """A folder with the authorizations received in three deliveries: before the quarter's run every
    third a second time, and after it some closed."""
    root = f"{t.stages().root}/received"
    auth = t["au_master"]
    tables.ingest_table(auth.withColumn("status_code", F.expr("IF(auth_no % 3 = 0, 'XX', status_code)")), root, "au_master")
    tables.add_changes(t.spark, auth.where("auth_no % 3 = 0"), root, "au_master", CALC - timedelta(days=9))
    closed = auth.where(LATER_STATUS).withColumns({"status_code": F.lit("CN"), "data_status": F.lit("ID")})
    tables.add_changes(t.spark, closed, root, "au_master", CALC + timedelta(days=30))
    return root


@check(
    "authorizations_as_of",
    f"""SELECT auth_no, kcid, CASE WHEN {LATER_STATUS} THEN 'CN' ELSE status_code END AS status_code,
    status_code AS status_then FROM auth""",
)
def authorizations_as_of(t: Proxies) -> DataFrame:
    """Every authorization with its status by now and on the day of the run."""
    root = _received(t)
    then = tables.read_table(t.spark, root, "au_master", as_of=CALC)
    now = tables.read_table(t.spark, root, "au_master").select("auth_no", "kcid", "status_code")
    return now.join(then.select("auth_no", F.col("status_code").alias("status_then")), "auth_no", "full")


@check("population_as_of", f"SELECT {POP_COLUMNS} FROM pop")
def population_as_of(t: Proxies) -> DataFrame:
    """The population of the quarter selected again after authorizations in it were closed."""
    then = tables.read_table(t.spark, _received(t), "au_master", as_of=CALC)
    return quarter.population_of({**t.all(), "au_master": then}, dates.Periods.of(CALC), CALC)


@check("population_by_now", f"SELECT {POP_COLUMNS} FROM pop WHERE NOT {LATER_STATUS}")
def population_by_now(t: Proxies) -> DataFrame:
    """The same from the latest authorizations: those closed since are gone."""
    now = tables.read_table(t.spark, _received(t), "au_master")
    return quarter.population_of({**t.all(), "au_master": now}, dates.Periods.of(CALC), CALC)


def oracle_queries() -> dict[str, str]:
    """The SQL of every check, complete with the views it needs."""
    return {name: oracle.resolve(sql) for name, sql in SQL.items()}
