"""Selecting the authorizations due for stratification in a quarter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseline.functions.codes import in_scope, recode_program, sufficient_data
from doseline.functions.dates import age_at, as_date
from doseline.functions.ranges import overlaps

SETTLING_DAYS = 3


def currency_cutoff(df: DataFrame, col: str, calc_date: date | str | Column) -> DataFrame:
    """One row: the last recorded start, but never later than the calculation date."""
    latest = df.agg(F.max(F.col(col)).alias("_latest"))
    return latest.select(F.least("_latest", as_date(calc_date)).alias("cutoff_date"))


def settled(post: Column, as_of: date | str | Column, days: int = SETTLING_DAYS) -> Column:
    """Posted at least `days` days ago, so that its risk data has had time to arrive."""
    return post.cast("date") <= F.date_sub(as_date(as_of), days)


def exclude_stratified(auth: DataFrame, strata: DataFrame, start: date, end: date) -> DataFrame:
    """Drop authorizations that have a stratum beginning in the quarter."""
    done = strata.where(F.col("start_date").between(as_date(start), as_date(end)))
    return auth.join(done.select("auth_no"), "auth_no", "left_anti")


def attach_person(auth: DataFrame, person: DataFrame, plan: DataFrame, p1: DataFrame) -> DataFrame:
    """Add plan, date of birth and Medicaid id where known."""
    return (
        auth.join(plan.select("auth_no", "plan"), "auth_no", "left")
        .join(person.select("kcid", "dob"), "kcid", "left")
        .join(p1.select("kcid", "p1_id"), "kcid", "left")
    )


def select_population(
    auth: DataFrame,
    person: DataFrame,
    plan: DataFrame,
    attributes: DataFrame,
    strata: DataFrame,
    p1: DataFrame,
    q_start: date,
    q_end: date,
    as_of: date,
) -> DataFrame:
    """Authorizations to stratify in the quarter, one row each.

    `attributes` supplies the case-rate attributes per (kcid, auth_no); authorizations
    without them are not selected.
    """
    due = (
        auth.where(in_scope(F.col("program"), F.col("status_code")))
        .where(overlaps(F.col("start_date"), F.col("expire_date"), q_start, q_end))
        .where(settled(F.col("post_stamp"), as_of))
        .where(sufficient_data(F.col("data_status")))
        .select("kcid", "auth_no", "agency_id", "start_date", "expire_date", "program")
    )
    case_rates = attributes.select(
        F.col("kcid").alias("_kcid"), "auth_no", "age_group", "special_population", "language_differential"
    )
    # Stratum, case rate and plan are all found by the authorization, so that one partitioning
    # serves them; as a range the person is no key of the join, which would need another.
    same_person = F.col("kcid").between(F.col("_kcid"), F.col("_kcid"))
    open_ones = exclude_stratified(due, strata, q_start, q_end)
    same = (open_ones["auth_no"] == case_rates["auth_no"]) & same_person
    known = open_ones.join(case_rates, same).drop(case_rates["auth_no"], "_kcid")
    return attach_person(known, person, plan, p1).select(
        "kcid",
        "auth_no",
        as_date(q_start).alias("phs_start_date"),
        as_date(q_end).alias("phs_end_date"),
        as_date(as_of).alias("calc_date"),
        "agency_id",
        "start_date",
        "expire_date",
        recode_program(F.col("program"), F.col("plan")).alias("program"),
        F.col("program").alias("current_program"),
        F.lit("MH").alias("tx_focus"),
        "age_group",
        "special_population",
        "language_differential",
        age_at(F.col("dob"), q_start).alias("age"),
        "p1_id",
    )
