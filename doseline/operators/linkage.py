"""Linking strata to dose ratios, and the payment rule and multiplier that follow."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseline.functions.codes import LINKED_PROGRAMS, MH_PROGRAMS, SUD_PROGRAMS, tx_focus
from doseline.functions.dates import as_date
from doseline.operators.dosage import EPISODE_KEYS, Keep, held_episodes, pass_on
from doseline.operators.intervals import prior_episode
from doseline.operators.lookups import latest_by, limited, lookup

# --- Fixed values: rules, thresholds and the one special start date ----------------------
TIER_CHANGE, NORMAL, PRIOR_BENEFIT, NEW_CLIENT, UNLINKED = "FPC", "NOR", "PQD", "FPN", "SHA"
FULL_PAY = ["FPC", "FPN", "SHA"]
MIN_DAYS = 31
MAX_GAP = 90
LINKED_SINCE = date(2020, 1, 1)
SPECIAL_START, SPECIAL_CHECK_END = date(2019, 9, 1), date(2020, 1, 1)
# -----------------------------------------------------------------------------------------

MULTIPLIER = "decimal(6,3)"


def _awaiting(since: date) -> Column:
    return F.col("stratum_sda_id").isNull() & (F.col("start_date") >= as_date(since))


def unlinked_strata(strata: DataFrame, auth: DataFrame, since: date = LINKED_SINCE) -> DataFrame:
    """Strata without a dose ratio that began on or after `since`, with their authorization."""
    program = F.col("program")
    held = auth.where(program.isin(LINKED_PROGRAMS)).select(
        "kcid",
        "auth_no",
        "agency_id",
        "start_date",
        "expire_date",
        tx_focus(program, unfunded=False).alias("tx_focus"),
    )
    waiting = strata.where(_awaiting(since)).select(
        "auth_no",
        "au_stratum_id",
        F.col("start_date").alias("phs_start_date"),
        F.col("end_date").alias("phs_end_date"),
        "age_group",
        "strat_level",
        "sda_rule",
    )
    return held.join(waiting, "auth_no")


def link_current(candidates: DataFrame, ratios: DataFrame) -> DataFrame:
    """Attach the ratio whose period ended one month before the stratum's quarter."""
    due = F.add_months(F.date_add("end_date", 1), 1)
    dated = ratios.select("auth_no", due.alias("phs_start_date"), "stratum_sda_id", "enroll_days")
    newest = latest_by(dated, ["auth_no", "phs_start_date"], [F.desc("stratum_sda_id")])
    return candidates.join(newest, ["auth_no", "phs_start_date"], "left")


def _check_end(start: Column) -> Column:
    special = start == as_date(SPECIAL_START)
    return F.when(special, as_date(SPECIAL_CHECK_END)).otherwise(F.add_months(start, 3))


def _order() -> Column:
    """Order of strata by date and id; one without a date is neither first nor last."""
    return F.when(F.col("start_date").isNotNull(), F.struct("start_date", "au_stratum_id"))


def first_stratum(strata: DataFrame) -> DataFrame:
    """First level per authorization and the last day a tier change may still count."""
    first = F.min_by(F.struct("start_date", "strat_level"), _order())
    return (
        strata.groupBy("auth_no")
        .agg(first.alias("_first"))
        .select(
            "auth_no",
            F.col("_first.strat_level").alias("first_strat"),
            _check_end(F.col("_first.start_date")).alias("strat_check_end"),
        )
    )


def last_stratum(strata: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Latest level and dose-ratio id per authorization.

    The latest date is sought without the strata in `exclude` (au_stratum_id).
    """
    if exclude is not None:
        strata = strata.join(exclude.select("au_stratum_id"), "au_stratum_id", "left_anti")
    last = F.max_by(F.struct("strat_level", "stratum_sda_id"), _order())
    return (
        strata.groupBy("auth_no")
        .agg(last.alias("_last"))
        .select(
            "auth_no",
            F.col("_last.strat_level").alias("last_strat"),
            F.col("_last.stratum_sda_id").alias("last_stratum_sda_id"),
        )
    )


def _endpoint_columns(first: Column, settled: Column, last: Column) -> list[Column]:
    return [
        first["strat_level"].alias("first_strat"),
        _check_end(first["start_date"]).alias("strat_check_end"),
        settled["strat_level"].alias("last_strat"),
        settled["stratum_sda_id"].alias("last_stratum_sda_id"),
        last["strat_level"].alias("pqd_strat"),
        last["stratum_sda_id"].alias("pqd_sda_id"),
    ]


def settled_strata(strata: DataFrame, since: date = LINKED_SINCE) -> DataFrame:
    """The first and the last stratum per authorization among those that no link will change.

    Each is a struct in order of date and id, so that states of any parts of a table, also
    overlapping ones, are put together by `combined_states`. An awaiting stratum joins the
    state when it is linked; one without a date never does, nor has it a place in the order.
    """
    held = strata.where(F.col("start_date").isNotNull() & ~_awaiting(since))
    ends = F.struct("start_date", "au_stratum_id", "strat_level", "stratum_sda_id")
    return held.groupBy("auth_no").agg(F.min(ends).alias("first"), F.max(ends).alias("last"))


def combined_states(one: DataFrame, other: DataFrame) -> DataFrame:
    """The state of all strata that either state was made of."""
    both = one.unionByName(other)
    return both.groupBy("auth_no").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def awaiting_strata(strata: DataFrame, since: date = LINKED_SINCE) -> DataFrame:
    """The strata outside the state. On a stored table both conditions reach the scan, the date as
    a filter of partitions."""
    return strata.where(_awaiting(since))


def endpoints_from_state(state: DataFrame, strata: DataFrame, since: date = LINKED_SINCE) -> DataFrame:
    """The endpoints of all strata, from the state of some and the rows of at least the others."""
    ends = F.when(F.col("start_date").isNotNull(), F.struct("start_date", "au_stratum_id", "strat_level", "stratum_sda_id"))
    rows = strata.select(
        "auth_no", ends.alias("first"), F.when(~_awaiting(since), ends).alias("settled"), ends.alias("last")
    )
    known = state.select("auth_no", "first", F.col("last").alias("settled"), "last")
    merged = rows.unionByName(known).groupBy("auth_no").agg(
        F.min("first").alias("first"), F.max("settled").alias("settled"), F.max("last").alias("last")
    )
    return merged.select("auth_no", *_endpoint_columns(F.col("first"), F.col("settled"), F.col("last")))


def strata_endpoints(strata: DataFrame, since: date = LINKED_SINCE) -> DataFrame:
    """First, last settled and last stratum per authorization in one aggregate.

    A stratum is settled unless it awaits its link, so for an authorization among the
    candidates this leaves out exactly its own candidates.
    """
    level_and_id = F.struct("strat_level", "stratum_sda_id")
    settled_order = F.when(~_awaiting(since), _order())
    first = F.min_by(F.struct("start_date", "strat_level"), _order())
    ends = strata.groupBy("auth_no").agg(
        first.alias("_first"),
        F.max_by(level_and_id, settled_order).alias("_settled"),
        F.max_by(level_and_id, _order()).alias("_last"),
    )
    return ends.select("auth_no", *_endpoint_columns(F.col("_first"), F.col("_settled"), F.col("_last")))


def link_prior(candidates: DataFrame, auth: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """Attach the authorization that ended up to `max_gap` days before, same focus."""
    tiered = limited(auth.where(F.col("program").isin(MH_PROGRAMS + SUD_PROGRAMS)), candidates, "kcid")
    linked = prior_episode(
        candidates.withColumn("auth_start", F.col("start_date")),
        held_episodes(tiered, unfunded=False),
        EPISODE_KEYS,
        max_gap,
    )
    return linked.drop("auth_start", "prev_auth_start").withColumnRenamed(
        "prev_auth_expire", "prev_auth_end"
    )


def link_prior_stratum(candidates: DataFrame, latest: DataFrame) -> DataFrame:
    """Attach level and ratio id of the prior authorization's latest stratum."""
    side = latest.select(
        "auth_no",
        F.col("last_strat").alias("pqd_strat"),
        F.col("last_stratum_sda_id").alias("pqd_sda_id"),
    )
    return lookup(candidates, side, "prev_auth_no", "auth_no", "au_stratum_id")


def payment_rule(df: DataFrame, min_days: int = MIN_DAYS) -> DataFrame:
    """The rule that decides payment and the ratio it refers to.

    In order: the level changed from the prior or the last stratum (full pay), enough
    days enrolled (normal), the prior authorization has a ratio (use it), new client.
    """
    changed_from_prior = (F.col("first_strat") != F.col("pqd_strat")) & (
        F.col("phs_start_date") <= F.col("strat_check_end")
    )
    changed_from_last = F.col("last_strat") != F.col("strat_level")
    rule = (
        F.when(changed_from_prior | changed_from_last, TIER_CHANGE)
        .when(F.col("enroll_days") >= min_days, NORMAL)
        .when(F.col("pqd_sda_id").isNotNull(), PRIOR_BENEFIT)
        .otherwise(NEW_CLIENT)
    )
    uses_prior = rule == PRIOR_BENEFIT
    linked = F.when(uses_prior, F.col("pqd_sda_id")).otherwise(F.col("stratum_sda_id"))
    return df.withColumns({"new_sda_rule": rule, "new_stratum_sda_id": linked})


def pay_multiplier(df: DataFrame, ratios: DataFrame, corridor: DataFrame) -> DataFrame:
    """1.00 for full pay, else the corridor's multiplier for focus, age and ratio.

    The corridor lists programs, several of one focus; equal lines count once. Where
    corridors overlap, the highest multiplier is taken. Each row meets the lines of its focus and
    age at once, as one array, so that it stays one row and nothing is ranked. A ratio id
    that occurs twice counts once, with its higher ratio.
    """
    sda = ratios.groupBy("stratum_sda_id").agg(F.max("sda").alias("new_sda"))
    found = lookup(df, sda, "new_stratum_sda_id", "stratum_sda_id", "au_stratum_id")
    lines = corridor.select(
        tx_focus(F.col("program")).alias("_focus"),
        F.col("age_group").alias("_age"),
        F.struct("sda_low", "sda_high", F.col("sda_pay_multiplier").cast(MULTIPLIER).alias("multiplier")).alias("_line"),
    )
    lines = lines.groupBy("_focus", "_age").agg(F.collect_set("_line").alias("_lines"))
    same = (F.col("tx_focus") == F.col("_focus")) & (F.col("age_group") == F.col("_age"))
    held = F.filter("_lines", lambda line: F.col("new_sda").between(line["sda_low"], line["sda_high"]))
    best = F.array_max(F.transform(held, lambda line: line["multiplier"]))
    full = F.lit(1).cast(MULTIPLIER)
    paid = F.when(F.col("new_sda_rule").isin(FULL_PAY), full).otherwise(F.coalesce(best, full))
    return found.join(lines, same, "left").select(*found.columns, paid.alias("new_sda_pay_multiplier"))


def link_strata(
    strata: DataFrame,
    auth: DataFrame,
    ratios: DataFrame,
    corridor: DataFrame,
    since: date = LINKED_SINCE,
    min_days: int = MIN_DAYS,
    max_gap: int = MAX_GAP,
    keep: Keep = pass_on,
    endpoints: DataFrame | None = None,
) -> DataFrame:
    """Rule, ratio and multiplier for every stratum that awaits its link.

    The endpoints and the candidates are each read twice; `keep` may materialize them. Given
    `endpoints`, of all strata, only those that await their link are needed in `strata`.
    """
    if endpoints is None:
        endpoints = strata_endpoints(strata, since)
    endpoints = keep(endpoints, "stratum_endpoints")
    own = endpoints.select(
        "auth_no", "first_strat", "strat_check_end", "last_strat", "last_stratum_sda_id"
    )
    prior = endpoints.select("auth_no", "pqd_strat", "pqd_sda_id")
    candidates = unlinked_strata(strata, auth, since).join(own, "auth_no", "left")
    current = keep(link_current(candidates, ratios), "link_candidates")
    known = lookup(
        link_prior(current, auth, max_gap), prior, "prev_auth_no", "auth_no", "au_stratum_id"
    )
    return pay_multiplier(payment_rule(known, min_days), ratios, corridor)


def apply_links(strata: DataFrame, links: DataFrame, now: datetime) -> DataFrame:
    """Strata with rule, multiplier and ratio id overwritten where linked."""
    new = links.select(
        "au_stratum_id",
        F.lit(True).alias("_linked"),
        F.col("new_sda_rule").alias("_rule"),
        F.col("new_sda_pay_multiplier").alias("_pay"),
        F.col("new_stratum_sda_id").alias("_ratio"),
    )
    stamp = F.lit(now).cast("timestamp")
    values = {
        "sda_rule": F.col("_rule"),
        "sda_pay_multiplier": F.col("_pay").cast(MULTIPLIER),
        "stratum_sda_id": F.col("_ratio").cast("long"),
        "modify_stamp": stamp,
    }
    is_linked = F.col("_linked").isNotNull()
    columns = [
        F.when(is_linked, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in strata.columns
    ]
    return strata.join(new, "au_stratum_id", "left").select(*columns)
