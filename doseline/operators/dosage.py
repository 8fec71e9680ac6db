"""Service-dose ratio: hours delivered against hours expected over the look-back.

The current authorization and the one it continues go through the same functions; only
the key column differs (`auth_no` or `prev_auth_no`).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseline.functions.codes import HELD_STATUSES, UNCOUNTED_SOURCES, tier_program, tx_focus
from doseline.functions.dates import as_date
from doseline.functions.decimals import (
    HOURS,
    expected_hours,
    from_micro,
    micro_hours,
    truncated_quotient,
)
from doseline.functions.ranges import (
    clip_to_auth,
    clip_to_window,
    covers_calendar_month,
    inclusive_days,
    overlaps,
)
from doseline.operators.intervals import prior_episode, range_sum
from doseline.operators.lookups import limited

MEMBER_KEYS = ["kcid", "auth_no", "program", "age_group"]
EPISODE_KEYS = ["kcid", "agency_id", "tx_focus"]
MIN_DAYS = 28

Keep = Callable[[DataFrame, str], DataFrame]


def pass_on(df: DataFrame, name: str) -> DataFrame:
    return df


def _window_strata(strata: DataFrame, tiers: DataFrame, s: date, e: date, as_of: date | None):
    """Strata touching the window, clipped to it, with the tier's hours per program."""
    start, end = clip_to_window(F.col("start_date"), F.col("end_date"), s, e)
    touching = strata.where(overlaps(F.col("start_date"), F.col("end_date"), s, e)).select(
        F.col("auth_no").alias("_stratum_auth"),
        F.col("age_group").alias("_stratum_age"),
        "strat_level",
        start.alias("sda_start"),
        end.alias("sda_end"),
    )
    if as_of is not None:
        tiers = tiers.where(as_date(as_of).between(F.col("start_date"), F.col("end_date")))
    hours = tiers.select(
        F.col("program").alias("_tier_program"),
        F.col("age_group").alias("_tier_age"),
        F.col("strat_level").alias("_tier_level"),
        "svc_hrs_req",
    )
    return touching, hours


def _with_strata(
    members: DataFrame,
    key: str,
    strata: DataFrame,
    tiers: DataFrame,
    s: date,
    e: date,
    as_of: date | None,
) -> DataFrame:
    touching, hours = _window_strata(strata, tiers, s, e, as_of)
    same_tier = (
        (tier_program(F.col("program")) == F.col("_tier_program"))
        & (F.col("_stratum_age") == F.col("_tier_age"))
        & (F.col("strat_level") == F.col("_tier_level"))
    )
    return (
        members.join(touching, F.col(key) == F.col("_stratum_auth"), "left")
        .withColumn("sda_end", F.coalesce("sda_end", as_date(e)))
        .join(hours, same_tier, "left")
        .select(
            *members.columns, "sda_start", "sda_end", "strat_level", "svc_hrs_req"
        )
    )


def active_strata(
    members: DataFrame,
    strata: DataFrame,
    tiers: DataFrame,
    auth: DataFrame,
    s: date,
    e: date,
    tier_as_of: date | None = None,
) -> DataFrame:
    """Members with the strata in force during the window, clipped to it.

    Several strata, or several tier versions unless `tier_as_of` picks one, give several
    rows; a member without strata keeps one with a null start.
    """
    held = auth.select(
        "auth_no",
        "agency_id",
        F.col("start_date").alias("auth_start"),
        F.col("expire_date").alias("auth_expire"),
    )
    known = (
        members.select(*MEMBER_KEYS)
        .join(held, "auth_no", "left")
        .withColumns(
            {
                "auth_expire": F.coalesce("auth_expire", as_date(e)),
                "tx_focus": tx_focus(F.col("program")),
            }
        )
    )
    return _with_strata(known, "auth_no", strata, tiers, s, e, tier_as_of)


def prior_strata(
    totals: DataFrame,
    strata: DataFrame,
    tiers: DataFrame,
    s: date,
    e: date,
    tier_as_of: date | None = None,
) -> DataFrame:
    """The same for the authorizations that members continue.

    Members that continue one authorization under one program share its strata, so these
    are found once and `members` says for how many they count.
    """
    continued = (
        totals.where(F.col("prev_auth_no").isNotNull())
        .groupBy("prev_auth_no", "program", "prev_auth_start", "prev_auth_expire")
        .agg(F.count(F.lit(1)).alias("members"))
    )
    return _with_strata(continued, "prev_auth_no", strata, tiers, s, e, tier_as_of)


def clip_strata(df: DataFrame, s: date, e: date, prefix: str = "") -> DataFrame:
    """Narrow the strata to the days their authorization was held."""
    start, end = clip_to_auth(
        F.col("sda_start"),
        F.col("sda_end"),
        F.col(f"{prefix}auth_start"),
        F.col(f"{prefix}auth_expire"),
        s,
        e,
    )
    return df.withColumns({"sda_start": start, "sda_end": end})


def with_expected(df: DataFrame) -> DataFrame:
    """Days enrolled and hours expected in each stratum."""
    days = inclusive_days(F.col("sda_start"), F.col("sda_end"))
    return df.withColumns(
        {"enroll_days": days, "svc_hrs_expected": expected_hours(days, F.col("svc_hrs_req"))}
    )


def service_hours(services: DataFrame, s: date, e: date, auths: DataFrame | None = None) -> DataFrame:
    """Delivered hours per authorization and day, as whole millionths in `micro_hrs`.

    `auths` (auth_no) limits the result; it is applied to the daily sums, so that only
    those are shuffled for it.
    """
    counted = services.where(
        F.col("event_date").between(as_date(s), as_date(e))
        & (F.col("service_minutes") > 0)
        & ~F.col("source_id").isin(UNCOUNTED_SOURCES)
    )
    daily = counted.groupBy("auth_no", "event_date").agg(
        F.sum(micro_hours(F.col("service_minutes"))).alias("micro_hrs")
    )
    return daily if auths is None else daily.join(auths.distinct(), "auth_no", "left_semi")


def _with_hours(spans: DataFrame, daily: DataFrame, key: str) -> DataFrame:
    """Add svc_hrs to spans that carry n_strata, how many strata have the same interval.

    Equal intervals of one authorization each receive the hours of all of them, so
    `svc_hrs` is the interval's sum times `n_strata`. One without a start has no hours.
    """
    points = daily.withColumnRenamed("auth_no", key)
    summed = range_sum(spans, points, key, "sda_start", "sda_end", "event_date", "micro_hrs", "_micro")
    hours = from_micro(F.col("_micro") * F.col("n_strata")).cast(HOURS)
    return summed.withColumn("svc_hrs", hours).drop("_micro")


def hours_in_intervals(strata: DataFrame, daily: DataFrame) -> DataFrame:
    """Hours delivered in each distinct (authorization, start, end), and its row count."""
    spans = strata.groupBy("auth_no", "sda_start", "sda_end")
    return _with_hours(spans.agg(F.count(F.lit(1)).alias("n_strata")), daily, "auth_no")


def stratum_totals(
    strata: DataFrame, daily: DataFrame, group: list[str], key: str, weight: Column
) -> DataFrame:
    """Days, expected and delivered hours summed over the strata of each group.

    `weight` is how many members a stratum counts for. All steps are keyed by the
    authorization, so they run on the partitioning of the join that found the strata.
    """
    by_span = strata.groupBy(*group, "sda_start", "sda_end").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.coalesce("enroll_days", F.lit(0))).alias("_days"),
        F.sum("svc_hrs_expected").alias("_expected"),
    )
    # One row per program or member of the authorization shares the interval.
    shared = Window.partitionBy(key, "sda_start", "sda_end")
    spans = by_span.withColumn("n_strata", F.sum(F.col("_rows") * weight).over(shared))
    return (
        _with_hours(spans, daily, key)
        .groupBy(*group)
        .agg(
            F.sum("_days").cast("int").alias("enroll_days"),
            F.sum("_expected").cast(HOURS).alias("svc_hrs_expected"),
            F.sum(F.col("svc_hrs") * F.col("_rows")).cast(HOURS).alias("svc_hrs"),
        )
    )


AUTH_GROUP = [
    "kcid", "auth_no", "auth_start", "auth_expire", "agency_id", "program", "age_group", "tx_focus",
]


def auth_totals(strata: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per current authorization with its summed days and hours."""
    return stratum_totals(strata, daily, AUTH_GROUP, "auth_no", F.lit(1))


def prior_totals(totals: DataFrame, strata: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per continued authorization and member, sums prefixed with prev_."""
    group = ["prev_auth_no", "program", "members"]
    names = ["enroll_days", "svc_hrs_expected", "svc_hrs"]
    sums = stratum_totals(strata, daily, group, "prev_auth_no", F.col("members")).select(
        F.col("prev_auth_no").alias("_prior"), F.col("program").alias("_program"), *names
    )
    continued = totals.where(F.col("prev_auth_no").isNotNull()).select(
        "kcid", "auth_no", "prev_auth_no", "program"
    )
    same = (F.col("prev_auth_no") == F.col("_prior")) & F.col("program").eqNullSafe(F.col("_program"))
    added = continued.join(sums, same).groupBy("kcid", "auth_no", "prev_auth_no")
    return added.agg(
        F.sum("enroll_days").cast("int").alias("prev_enroll_days"),
        *[F.sum(n).cast(HOURS).alias(f"prev_{n}") for n in names[1:]],
    )


def held_episodes(auth: DataFrame, unfunded: bool = True) -> DataFrame:
    """Active or terminated authorizations as episodes that another may continue."""
    return auth.where(F.col("status_code").isin(HELD_STATUSES)).select(
        "kcid",
        "agency_id",
        tx_focus(F.col("program"), unfunded).alias("tx_focus"),
        "auth_no",
        "start_date",
        "expire_date",
    )


def continued_from(totals: DataFrame, auth: DataFrame, s: date, max_gap: int = 90) -> DataFrame:
    """Attach the authorization each one continues, if that was held in the window."""
    return prior_episode(totals, held_episodes(auth), EPISODE_KEYS, max_gap, min_end=s)


def enrolment_span(df: DataFrame) -> DataFrame:
    """The unbroken enrolment: from the continued authorization's start, if there is one."""
    return df.withColumns(
        {
            "longest_start": F.coalesce("prev_auth_start", "auth_start"),
            "longest_expire": F.col("auth_expire"),
        }
    )


def with_calendar_month(df: DataFrame, s: date) -> DataFrame:
    """calendar_month: 1 if the enrolment covers a whole month of the window."""
    covered = covers_calendar_month(F.col("longest_start"), F.col("longest_expire"), s)
    return df.withColumn("calendar_month", covered)


def prorate(df: DataFrame) -> DataFrame:
    """Combine current and continued days and hours, and put both hours on 30 days."""

    def both(name: str, kind: str) -> Column:
        zero = F.lit(0).cast(kind)
        return (F.coalesce(name, zero) + F.coalesce(f"prev_{name}", zero)).cast(kind)

    summed = df.select(
        *MEMBER_KEYS,
        "prev_auth_no",
        "calendar_month",
        both("enroll_days", "int").alias("enroll_days"),
        both("svc_hrs_expected", HOURS).alias("_expected"),
        both("svc_hrs", HOURS).alias("svc_hrs"),
    )
    days = F.when(F.col("enroll_days") != 0, F.col("enroll_days")).cast("decimal(10,0)")
    month = F.lit(30).cast("decimal(2,0)")
    return summed.withColumns(
        {
            "hrs_expected": (truncated_quotient(F.col("_expected"), days, 6) * month).cast(HOURS),
            "svc_hrs_prorated": (F.col("svc_hrs") * month / days).cast(HOURS),
        }
    ).drop("_expected")


def with_ratio(df: DataFrame, min_days: int = MIN_DAYS) -> DataFrame:
    """sda: delivered over expected; null if enrolled too briefly or nothing is expected."""
    eligible = (
        (F.col("enroll_days") >= min_days)
        & (F.coalesce("calendar_month", F.lit(1)) != 0)
        & (F.col("hrs_expected") != 0)
    )
    expected = F.when(eligible, F.col("hrs_expected"))
    return df.withColumn("sda", (F.col("svc_hrs_prorated") / expected).cast(HOURS))


def dose_totals(
    members: DataFrame,
    strata: DataFrame,
    tiers: DataFrame,
    auth: DataFrame,
    services: DataFrame,
    s: date,
    e: date,
    tier_as_of: date | None = None,
    keep: Keep = pass_on,
    hours: DataFrame | None = None,
) -> DataFrame:
    """Per member: own totals, the authorization it continues and that one's totals.

    The daily hours, and the totals with their continuation, are each read twice; `keep`
    may materialize them, so that the service table is scanned once. Given the daily `hours` of
    the window, the service table is not read at all.
    """
    # Only members' hours are asked for, and those of authorizations they may continue,
    # which are the same persons'.
    theirs = limited(auth, members, "kcid")
    asked = theirs.select("auth_no").unionByName(members.select("auth_no"))
    if hours is None:
        daily = service_hours(services, s, e, asked)
    else:
        daily = hours.join(asked.distinct(), "auth_no", "left_semi")
    daily = keep(daily, "daily_hours")
    current = with_expected(
        clip_strata(active_strata(members, strata, tiers, auth, s, e, tier_as_of), s, e)
    )
    linked = keep(continued_from(auth_totals(current, daily), theirs, s), "dose_current")
    prior = with_expected(
        clip_strata(prior_strata(linked, strata, tiers, s, e, tier_as_of), s, e, "prev_")
    )
    sums = prior_totals(linked, prior, daily).drop("prev_auth_no")
    return linked.join(sums, ["kcid", "auth_no"], "left")


def dose_ratio(
    pop: DataFrame,
    strata: DataFrame,
    tiers: DataFrame,
    auth: DataFrame,
    services: DataFrame,
    s: date,
    e: date,
    min_days: int = MIN_DAYS,
    tier_as_of: date | None = None,
    keep: Keep = pass_on,
    hours: DataFrame | None = None,
) -> DataFrame:
    """The service-dose ratio and its parts for each authorization of the population."""
    members = pop.select(*MEMBER_KEYS).distinct()
    totals = dose_totals(members, strata, tiers, auth, services, s, e, tier_as_of, keep, hours)
    return with_ratio(prorate(with_calendar_month(enrolment_span(totals), s)), min_days)


def with_sda(pop: DataFrame, ratios: DataFrame) -> DataFrame:
    """Attach the ratio and its parts, zero where absent; the ratio itself stays null."""
    added = ["prev_auth_no", "calendar_month", "enroll_days", "hrs_expected", "svc_hrs",
             "svc_hrs_prorated", "sda"]
    side = ratios.select(*[F.col(c).alias(f"_m_{c}") for c in MEMBER_KEYS], *added)
    nullable = F.col("age_group").eqNullSafe(F.col("_m_age_group"))
    same = [F.col(c) == F.col(f"_m_{c}") for c in ("kcid", "auth_no", "program")]
    joined = pop.join(side, [*same, nullable], "left").select(*pop.columns, *added)
    filled = ["calendar_month", "enroll_days", "hrs_expected", "svc_hrs", "svc_hrs_prorated"]
    return joined.fillna(dict.fromkeys(filled, 0)).drop("start_date", "expire_date")
