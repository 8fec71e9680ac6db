"""Interval operators: merging, summing points into intervals, prior episodes.

Each first reduces its input to rows whose number per key is bounded by the calendar
(one per day, or per pair of days), with the reduction starting on the map side. Only
then is a window taken, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doseline.functions.dates import as_date


def merge_intervals(
    df: DataFrame, keys: Sequence[str], start: str, end: str, mode: str = "lag"
) -> DataFrame:
    """Merge touching ranges per key; returns keys, grp, start and end.

    `lag` compares each range with the end of the one just before it in (start, end)
    order, so a long range is forgotten once a short one follows it. `runmax` compares
    with the latest end so far and gives the true union. Rows without a key or a start
    belong to no group.
    """
    if mode == "lag":
        return _merge_by_previous(df, list(keys), start, end)
    if mode == "runmax":
        return _merge_by_reach(df, list(keys), start, end)
    raise ValueError(f"mode must be 'lag' or 'runmax', not {mode!r}")


def _known(cols: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])


def _merge_by_previous(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    # A key is handled in slices of one start month. Inside a slice only the first row
    # needs to know what came before, and one row per slice carries that over.
    # Both readers of `parts` must see the same rows to share their shuffles, so rows that
    # the join below would drop for a null are dropped here.
    rows = (
        df.select(*keys, start, end)
        .distinct()
        .withColumn("_slice", F.trunc(start, "month"))
        .where(_known([*keys, "_slice"]))
    )
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(start, end)
    before = F.lag(end).over(in_slice)
    is_first = F.row_number().over(in_slice) == 1
    opens = F.when(is_first, 0).when(before.isNull() | (F.col(start) > before), 1).otherwise(0)
    parts = (
        rows.withColumn("_opens", opens)
        .withColumn("_part", F.sum("_opens").over(in_slice))
        .groupBy(*keys, "_slice", "_part")
        .agg(
            F.min(start).alias(start),
            F.max(end).alias(end),
            F.max_by(end, F.struct(start, end)).alias("_last_end"),
        )
    )
    slices = parts.groupBy(*keys, "_slice").agg(
        F.min(start).alias("_first_start"),
        F.max("_part").alias("_extra"),
        F.max_by("_last_end", "_part").alias("_last_end"),
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    carried = F.lag("_last_end").over(across)
    fresh = F.when(carried.isNull() | (F.col("_first_start") > carried), 1).otherwise(0)
    offsets = (
        slices.withColumn("_fresh", fresh)
        .withColumn("_through", F.sum(F.col("_fresh") + F.col("_extra")).over(across))
        .select(*keys, "_slice", (F.col("_through") - F.col("_extra")).alias("_offset"))
    )
    return (
        parts.join(offsets, [*keys, "_slice"])
        .groupBy(*keys, (F.col("_offset") + F.col("_part")).cast("int").alias("grp"))
        .agg(F.min(start).alias(start), F.max(end).alias(end))
    )


def _merge_by_reach(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    # Only the longest range from each start day can matter, which bounds a key by days.
    longest = df.where(_known([*keys, start])).groupBy(*keys, start).agg(F.max(end).alias(end))
    order = Window.partitionBy(*keys).orderBy(start)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(end).over(earlier)
    fresh = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    return (
        longest.withColumn("_fresh", fresh)
        .withColumn("grp", F.sum("_fresh").over(order).cast("int"))
        .groupBy(*keys, "grp")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
    )


def range_sum(
    intervals: DataFrame,
    points: DataFrame,
    key: str,
    start: str,
    end: str,
    day: str,
    amount: str,
    alias: str,
) -> DataFrame:
    """Add to each interval the sum of the points of its key that fall inside it.

    `intervals` must be distinct on its columns and `points` reduced to one row per key
    and day; what meets in the join is then bounded by the days of the window.
    """
    inside = (F.col(key) == F.col("_k")) & F.col("_d").between(F.col(start), F.col(end))
    renamed = points.select(
        F.col(key).alias("_k"), F.col(day).alias("_d"), F.col(amount).alias("_a")
    )
    return (
        intervals.join(renamed, inside, "left")
        .groupBy(*intervals.columns)
        .agg(F.coalesce(F.sum("_a"), F.lit(0)).alias(alias))
    )


def prior_episode(
    current: DataFrame,
    episodes: DataFrame,
    keys: Sequence[str],
    max_gap: int = 90,
    min_end: date | str | Column | None = None,
) -> DataFrame:
    """Attach the episode of the same keys that ended last, 0 to `max_gap` days before.

    `current` has the keys, auth_no and auth_start; `episodes` the keys, a unique
    auth_no, start_date and expire_date. The episode's own row is skipped and ties go to
    the largest auth_no. Adds prev_auth_no, prev_auth_start and prev_auth_expire.

    Instead of pairing episodes, every start day looks back along one ordered line of end
    days. Two episodes per end day and one row per start day are enough for an exact
    answer, because at most one of the two can be the current episode itself.
    """
    keys = list(keys)
    ended = episodes.where(F.col("expire_date").isNotNull())
    if min_end is not None:
        ended = ended.where(F.col("expire_date") >= as_date(min_end))
    per_day = F.row_number().over(
        Window.partitionBy(*keys, "expire_date").orderBy(F.desc("auth_no"))
    )
    ends = (
        ended.withColumn("_n", per_day)
        .where(F.col("_n") <= 2)
        .select(
            *keys,
            F.col("expire_date").alias("_day"),
            F.lit(0).alias("_asks"),
            F.col("auth_no").alias("_seq"),
            F.struct("auth_no", "start_date", "expire_date").alias("_end"),
        )
    )
    asked = (
        current.select(*keys, F.col("auth_start").alias("_day"))
        .distinct()
        .withColumns({"_asks": F.lit(1), "_seq": F.lit(None).cast("long")})
    )
    line = Window.partitionBy(*keys).orderBy("_day", "_asks", "_seq")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = F.last("_end", ignorenulls=True).over(before)
    found = F.when(F.col("_asks") == 0, F.struct(F.col("_end").alias("_best"), "_next"))
    answers = (
        ends.unionByName(asked, allowMissingColumns=True)
        .withColumn("_next", earlier)
        .withColumn("_found", F.last(found, ignorenulls=True).over(so_far))
        .where((F.col("_asks") == 1) & F.col("_found").isNotNull())
        .select(*keys, F.col("_day").alias("auth_start"), "_found")
    )
    best, following = F.col("_found._best"), F.col("_found._next")
    chosen = F.when(best["auth_no"] != F.col("auth_no"), best).otherwise(following)
    recent = F.datediff("auth_start", F.col("_prior.expire_date")) <= max_gap
    return (
        current.join(answers, [*keys, "auth_start"], "left")
        .withColumn("_prior", chosen)
        .withColumn("_prior", F.when(recent, F.col("_prior")))
        .select(
            *current.columns,
            F.col("_prior.auth_no").alias("prev_auth_no"),
            F.col("_prior.start_date").alias("prev_auth_start"),
            F.col("_prior.expire_date").alias("prev_auth_expire"),
        )
    )
