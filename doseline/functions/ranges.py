"""Date-range predicates, clipping and day counts."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from doseline.functions.dates import as_date, month_bounds

Day = date | str | Column


def overlaps(start: Column, end: Column, lo: Day, hi: Day) -> Column:
    """Whether [start, end] touches [lo, hi].

    An open end counts only when the range starts inside, and so does a range whose
    end precedes its start if either date lies inside. Null where a date is missing and
    the other decides nothing, which a filter takes for no; so bare, it reaches the scan.
    """
    lo, hi = as_date(lo), as_date(hi)
    inside = start.between(lo, hi) | end.between(lo, hi)
    return inside | ((start <= hi) & (end >= lo))


def clip_to_window(start: Column, end: Column, lo: Day, hi: Day) -> tuple[Column, Column]:
    """Force both dates into [lo, hi]; an open end becomes hi, a null start stays null."""
    lo, hi = as_date(lo), as_date(hi)

    def held(day: Column) -> Column:
        return F.when(day.isNotNull(), F.least(F.greatest(day, lo), hi))

    return held(start), F.coalesce(held(end), hi)


def clip_to_auth(
    start: Column, end: Column, auth_start: Column, auth_end: Column, lo: Day, hi: Day
) -> tuple[Column, Column]:
    """Narrow [start, end] to the authorization; null when that lies outside [lo, hi].

    Built from `when`, because `greatest` would revive a null start.
    """
    outside = (auth_start > as_date(hi)) | (auth_end < as_date(lo))
    narrowed_start = F.when(auth_start > start, auth_start).otherwise(start)
    narrowed_end = F.when(auth_end < end, auth_end).otherwise(end)
    keep = F.coalesce(~outside, F.lit(True))
    return F.when(keep, narrowed_start), F.when(keep, narrowed_end)


def inclusive_days(start: Column, end: Column) -> Column:
    """Days from start to end with both counted; null if the range runs backwards."""
    days = F.datediff(end, start) + 1
    return F.when(days >= 0, days)


def covers_calendar_month(start: Column, end: Column, first_month: Day) -> Column:
    """1 if any of the three months from `first_month` lies wholly within [start, end]."""
    bounds = month_bounds(first_month)
    whole = [
        (start <= bounds[f"mo{n}_start"]) & (end >= bounds[f"mo{n}_end"]) for n in (1, 2, 3)
    ]
    return F.when(reduce(Column.__or__, whole), 1).otherwise(0)
