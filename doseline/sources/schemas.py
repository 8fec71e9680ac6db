"""Declared schemas of the input, history and configuration tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(6,3)": T.DecimalType(6, 3),
    "decimal(18,3)": T.DecimalType(18, 3),
}


def _schema(columns: str) -> T.StructType:
    """A schema from `name type` pairs; unlike `fromDDL` it needs no running session."""
    pairs = re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", columns)
    # Columns are parted by the commas outside parentheses; none may be skipped.
    if len(pairs) != re.sub(r"\([^)]*\)", "", columns).count(",") + 1:
        raise ValueError(f"cannot read the columns {columns}")
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_STRATUM = """
    au_stratum_id bigint, auth_no bigint, calc_date date, start_date date, end_date date,
    total_score decimal(18,3), strat_level string, age_group string,
    special_population string, language_differential string,
    sda_pay_multiplier decimal(6,3), missing_data string, override_status string,
    post_stamp timestamp, sda_rule string, modify_stamp timestamp, stratum_sda_id bigint
"""
_ASSESSMENT = "kcid bigint, agency_id int, event_date date, record_id bigint, composite_score int"

INPUTS = {
    name: _schema(ddl)
    for name, ddl in {
        "au_master": """kcid bigint, auth_no bigint, agency_id int, start_date date,
            expire_date date, program string, status_code string, post_stamp timestamp,
            data_status string""",
        "crisis_au_master": """kcid bigint, auth_no bigint, start_date date, expire_date date,
            program string, status_code string""",
        "g_person": "kcid bigint, dob date",
        "au_initial_plan": "auth_no bigint, plan string",
        "case_rate": """kcid bigint, auth_no bigint, age_group string,
            special_population string, language_differential string""",
        "g_p1_client": "kcid bigint, p1_id string",
        "ep_locus": _ASSESSMENT,
        "ep_calocus": _ASSESSMENT,
        "ep_residence": "kcid bigint, resid_arrng_code string, start_date date",
        "ep_coverage_mco": "kcid bigint, plan_type string, start_date date",
        "mcaid_claim_ccw": "id_mcaid string, ccw_desc string, from_date date",
        "mcaid_elig_timevar": "id_mcaid string, from_date date, to_date date",
        "mcaid_claim_header": "id_mcaid string, first_service_date date",
        "ma_cond_ass": "auth_no bigint, condition_code string",
        "ip_master": "auth_no bigint, ip_type string",
        "cmt_hospital_report": "kcid bigint, major_class string, admit_date date",
        "ep_jail": "kcid bigint, book_date date, release_date date",
        "muni_jail": "kcid_match bigint, booking_start date, booking_end date",
        "ep_asam_placement": """kcid bigint, agency_id int, event_date date,
            event_type string, record_id bigint, level_indicated string""",
        "ep_substance_use": "kcid bigint, method int, event_date date",
        "ea_cpt_service": "auth_no bigint, event_date date, service_minutes int, source_id int",
    }.items()
}

HISTORY = {
    name: _schema(ddl)
    for name, ddl in {
        "au_stratum": _STRATUM,
        "au_stratum_score": """au_stratum_id bigint, metric string, value decimal(18,3),
            score decimal(18,3), missing_data string, override_ind string,
            post_stamp timestamp, modify_stamp timestamp""",
        "au_stratum_sda": """stratum_sda_id bigint, auth_no bigint, start_date date,
            end_date date, sda decimal(18,3), enroll_days int, hrs_expected decimal(18,3),
            svc_hrs decimal(18,3), svc_hrs_prorated decimal(18,3), post_stamp timestamp,
            modify_stamp timestamp, prev_auth_no bigint""",
        "au_stratum_shadow": _STRATUM,
    }.items()
}

CONFIG = {
    name: _schema(ddl)
    for name, ddl in {
        "cd_stratum_metric": "metric string, start_date date, end_date date",
        "cd_stratum_pop_model": """program string, age_group string, metric string,
            range_low decimal(18,3), range_high decimal(18,3), score decimal(18,3),
            start_date date, end_date date""",
        "cd_stratum_tier": """program string, age_group string, range_low decimal(18,3),
            range_high decimal(18,3), strat_level string, svc_hrs_req decimal(6,3),
            start_date date, end_date date""",
        "cd_stratum_pay_corridor": """program string, age_group string,
            sda_low decimal(18,3), sda_high decimal(18,3),
            sda_pay_multiplier decimal(6,3)""",
    }.items()
}

TABLES = {**INPUTS, **HISTORY, **CONFIG}
