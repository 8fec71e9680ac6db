"""Records for the four history tables, and the pure updates applied to them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseline.functions.dates import as_date
from doseline.operators.linkage import MULTIPLIER, UNLINKED

# --- Fixed values: defaults and columns of the records --------------------------------
NO_OVERRIDES = "NNN"
NOT_OVERRIDDEN = "N"
UNSCORED_METRIC = "CHRON"

STRATUM_RECORD = [
    "auth_no", "calc_date", "start_date", "end_date", "total_score", "strat_level",
    "age_group", "special_population", "language_differential", "missing_data",
]
SDA_RECORD = [
    "auth_no", "start_date", "end_date", "sda", "enroll_days", "hrs_expected", "svc_hrs",
    "svc_hrs_prorated", "prev_auth_no",
]
STRATUM_COLUMNS = [
    "au_stratum_id", "auth_no", "calc_date", "start_date", "end_date", "total_score",
    "strat_level", "age_group", "special_population", "language_differential",
    "sda_pay_multiplier", "missing_data", "override_status", "post_stamp", "sda_rule",
    "modify_stamp", "stratum_sda_id",
]
SCORE_COLUMNS = [
    "au_stratum_id", "metric", "value", "score", "missing_data", "override_ind", "post_stamp",
    "modify_stamp",
]
SDA_COLUMNS = [
    "stratum_sda_id", "auth_no", "start_date", "end_date", "sda", "enroll_days",
    "hrs_expected", "svc_hrs", "svc_hrs_prorated", "post_stamp", "modify_stamp", "prev_auth_no",
]
# --------------------------------------------------------------------------------------

ID_BITS = 16  # of the authorization number, to a block or region


def _quarter_dates(df: DataFrame) -> DataFrame:
    return df.drop("start_date", "end_date").withColumnsRenamed(
        {"phs_start_date": "start_date", "phs_end_date": "end_date"}
    )


def stratum_rows(df: DataFrame) -> DataFrame:
    """The stratum record of each authorization, dated by the quarter."""
    return _quarter_dates(df).select(
        *STRATUM_RECORD, F.lit(NO_OVERRIDES).alias("override_status")
    )


def _before(sizes: DataFrame, key: str, levels: int) -> DataFrame:
    """Rows of `sizes` (start_date, key, _size) with `_before`, the sizes of all earlier ones.

    Keys are summed inside regions of 65,536 keys and the regions in the same way, `levels`
    times; the last line then holds at most 65,536 rows per start date.
    """
    if levels == 0:
        line = Window.orderBy("start_date", key).rowsBetween(Window.unboundedPreceding, -1)
        return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(line), F.lit(0)))
    region = f"_region{levels}"
    placed = sizes.withColumn(region, F.shiftright(key, ID_BITS))
    totals = placed.groupBy("start_date", region).agg(F.sum("_size").alias("_size"))
    earlier = _before(totals, region, levels - 1).drop("_size").withColumnRenamed("_before", "_earlier")
    inside = Window.partitionBy("start_date", region).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    joined = own.join(earlier, ["start_date", region])
    return joined.withColumn("_before", F.col("_before") + F.col("_earlier")).drop(region, "_earlier")


def with_ids(df: DataFrame, id_col: str, after: Column | int) -> DataFrame:
    """Number rows consecutively from `after` + 1 in order of start_date and auth_no.

    Rows are ranked inside blocks of a fixed range of auth_no; the sizes of earlier blocks
    are summed up level by level, three of which reach all 64-bit numbers, however sparse.
    Ids depend on values alone, so a task that runs again gives the same ones.
    """
    rest = [c for c in df.columns if c not in ("auth_no", "start_date")]
    blocked = df.withColumn("_block", F.shiftright("auth_no", ID_BITS))
    in_block = Window.partitionBy("start_date", "_block").orderBy("auth_no", *rest)
    ranked = blocked.withColumn("_rank", F.row_number().over(in_block))
    sizes = blocked.groupBy("start_date", "_block").agg(F.count(F.lit(1)).alias("_size"))
    offsets = _before(sizes, "_block", 2).drop("_size")
    base = after if isinstance(after, Column) else F.lit(after)
    number = (F.col("_rank") + F.col("_before") + base).cast("long")
    return ranked.join(offsets, ["start_date", "_block"]).select(number.alias(id_col), *df.columns)


def highest_id(table: DataFrame, id_col: str) -> int:
    """The largest id in use, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).first()[0]


def _stamps(now: datetime) -> dict[str, Column]:
    return {
        "post_stamp": F.lit(now).cast("timestamp"),
        "modify_stamp": F.lit(None).cast("timestamp"),
    }


def new_strata(rows: DataFrame, after: Column | int, now: datetime) -> DataFrame:
    """Stratum records as table rows: numbered, unlinked and paid in full."""
    defaults = {
        **_stamps(now),
        "sda_pay_multiplier": F.lit(1).cast(MULTIPLIER),
        "sda_rule": F.lit(UNLINKED),
        "stratum_sda_id": F.lit(None).cast("long"),
    }
    return with_ids(rows, "au_stratum_id", after).withColumns(defaults).select(*STRATUM_COLUMNS)


def stratum_ids_on(strata: DataFrame, day: date) -> DataFrame:
    """Ids of the strata in force on a day."""
    in_force = as_date(day).between(F.col("start_date"), F.col("end_date"))
    return strata.where(in_force).select("au_stratum_id", "auth_no")


def score_rows(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Score lines with their stratum's id; the summary metric is not kept."""
    kept = lines.where(F.col("metric").isNull() | (F.col("metric") != UNSCORED_METRIC))
    return kept.join(ids, "auth_no", "left").select(
        "au_stratum_id",
        "metric",
        "value",
        "score",
        "missing_data",
        F.lit(NOT_OVERRIDDEN).alias("override_ind"),
    )


def new_scores(rows: DataFrame, now: datetime) -> DataFrame:
    """Score records as table rows."""
    return rows.withColumns(_stamps(now)).select(*SCORE_COLUMNS)


def sda_rows(df: DataFrame, period: str = "lookback") -> DataFrame:
    """The dose-ratio record of each authorization.

    Linking expects the dates of the look-back the ratio was measured over; `quarter`
    dates it by the stratified quarter instead, as the published tables did.
    """
    if period not in ("lookback", "quarter"):
        raise ValueError(f"period must be 'lookback' or 'quarter', not {period!r}")
    dated = _quarter_dates(df)
    if period == "lookback":
        begin = F.add_months("start_date", -4)
        dated = dated.withColumns(
            {"start_date": begin, "end_date": F.date_sub(F.add_months(begin, 3), 1)}
        )
    return dated.select(*SDA_RECORD)


def new_sda(rows: DataFrame, after: Column | int, now: datetime) -> DataFrame:
    """Dose-ratio records as table rows."""
    return with_ids(rows, "stratum_sda_id", after).withColumns(_stamps(now)).select(*SDA_COLUMNS)


def shadow_delta(strata: DataFrame, shadow: DataFrame) -> DataFrame:
    """Strata whose id the shadow does not have yet."""
    return strata.join(shadow.select("au_stratum_id"), "au_stratum_id", "left_anti").select(
        *strata.columns
    )


def reset_payments(strata: DataFrame, quarter_start: date) -> DataFrame:
    """Put one quarter's strata back to unlinked rule and full payment."""
    reset = (F.col("start_date") == as_date(quarter_start)) & (F.col("sda_rule") != UNLINKED)
    values = {"sda_rule": F.lit(UNLINKED), "sda_pay_multiplier": F.lit(1).cast(MULTIPLIER)}
    return strata.select(
        *[
            F.when(reset, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in strata.columns
        ]
    )
