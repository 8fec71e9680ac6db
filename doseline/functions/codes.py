"""Code lists of the domain and the recodes built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: program, status, plan and condition codes -------------------------
RECODED_MH = ["400", "401"]
TIERED_MH = ["2X1", "3A1", "3B1"]
OTHER_MH = ["MOP", "MOM"]
MH_PROGRAMS = ["2X1", "3A1", "3B1", "400", "401"]
SUD_PROGRAMS = ["S01", "S02", "500", "501"]
LINKED_PROGRAMS = ["2X1", "3A1", "3B1", "S01", "S02", "400", "401"]
ADULT_ASSESSED = ["MOP", "400", "401", "2X1", "3A1", "3B1"]
CHILD_ASSESSED = ["MHO", "MOP", "400", "401"]
OPEN_STATUSES = ["AA", "TM", "PN"]
HELD_STATUSES = ["AA", "TM"]
INSUFFICIENT_DATA = "ID"
MEDICAID_PLAN, MIDD_PLAN = "F19", "MID"
FOSTER_RESIDENCES = ["26", "46", "47"]
FOSTER_COVERAGE = "FOSTR"
HOMELESS_RESIDENCE = "82"
CVD_CLAIM_CODES = [
    "ccw_ischemic_heart_dis",
    "ccw_mi",
    "ccw_hypertension",
    "ccw_stroke",
    "ccw_hyperlipid",
    "ccw_heart_failure",
    "ccw_atrial_fib",
]
CLAIM_CODES = ["ccw_diabetes", *CVD_CLAIM_CODES, "ccw_asthma", "ccw_copd"]
ASSESSED_CODES = {"152": "asthma", "153": "diabetes", "154": "copd", "155": "cvd"}
CRISIS_PROGRAMS = {"nSRS": "SRS", "nDTX": "DTX"}
INPATIENT_PROGRAM, INVOLUNTARY = "IP", "I"
HOSPITAL_CLASSES = {"nED": "Emergency", "nIP": "Inpatient"}
INJECTION_METHOD = 2
OUTPATIENT_ASSESSMENT = "OP"
UNCOUNTED_SOURCES = [3, 6, 7, 8]
# --------------------------------------------------------------------------------------


def recode_program(program: Column, plan: Column) -> Column:
    """Program by who pays: 400 Medicaid, 401 levy, MOP unknown; '' outside mental health."""
    by_plan = F.when(plan == MEDICAID_PLAN, "400").when(plan == MIDD_PLAN, "401").otherwise("MOP")
    return (
        F.when(program.isin(RECODED_MH), program)
        .when(program.isin(TIERED_MH + OTHER_MH), by_plan)
        .otherwise("")
    )


def in_scope(program: Column, status: Column) -> Column:
    """Mental-health programs that are active, terminated or pending."""
    return program.isin(MH_PROGRAMS) & status.isin(OPEN_STATUSES)


def sufficient_data(status: Column) -> Column:
    """Not flagged as insufficient; an unknown status does not pass either."""
    return status != INSUFFICIENT_DATA


def tx_focus(program: Column, unfunded: bool = True) -> Column:
    """MH, SUD or ''. `unfunded` also places the payer-less codes MOP and SOP."""
    mh = MH_PROGRAMS + (["MOP"] if unfunded else [])
    sud = SUD_PROGRAMS + (["SOP"] if unfunded else [])
    return F.when(program.isin(mh), "MH").when(program.isin(sud), "SUD").otherwise("")


def tier_program(program: Column) -> Column:
    """The program whose tier hours apply: the older codes use those of 400."""
    return F.when(program.isin(TIERED_MH), "400").otherwise(program)


def missing_flag(
    score: Column, program: Column, age_group: Column, programs: list[str], age_groups: list[str]
) -> Column:
    """Y where an assessment is required by program and age group but absent.

    A null program or age group is not known to be exempt, so it stays required.
    """
    exempt = ~program.isin(programs) | ~age_group.isin(age_groups)
    return F.when(exempt | score.isNotNull(), "N").otherwise("Y")
