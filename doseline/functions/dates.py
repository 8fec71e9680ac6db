"""Reporting periods and calendar arithmetic."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(value: date | str | Column) -> Column:
    """A DATE column from a python date, an ISO string or a column."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def months_after(day: date, months: int) -> date:
    """Driver-side `add_months`: same clamping to the end of a shorter month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class Periods:
    """The quarter being stratified and the look-back whose doses are measured.

    Plain dates rather than columns, so that they reach the scans as literals and
    prune files and partitions.
    """

    calc_date: date
    pop_start: date
    pop_end: date
    sda_start: date
    sda_end: date

    @classmethod
    def of(cls, calc_date: date) -> Periods:
        first = date(calc_date.year, calc_date.month - (calc_date.month - 1) % 3, 1)
        back = months_after(first, -4)
        day = timedelta(days=1)
        return cls(calc_date, first, months_after(first, 3) - day, back, months_after(back, 3) - day)


def with_periods(df: DataFrame, calc_col: str) -> DataFrame:
    """Add pop_start, pop_end, sda_start and sda_end derived from a calculation date."""
    first = F.trunc(F.col(calc_col).cast("date"), "quarter")
    back = F.add_months(first, -4)
    return df.withColumns(
        {
            "pop_start": first,
            "pop_end": F.date_sub(F.add_months(first, 3), 1),
            "sda_start": back,
            "sda_end": F.date_sub(F.add_months(back, 3), 1),
        }
    )


def month_bounds(start: date | str | Column) -> dict[str, Column]:
    """First and last day of the three calendar months that begin at `start`."""
    first = as_date(start)
    bounds: dict[str, Column] = {}
    for n in range(3):
        month = F.add_months(first, n)
        bounds[f"mo{n + 1}_start"] = month
        bounds[f"mo{n + 1}_end"] = F.last_day(month)
    return bounds


def _yyyymmdd(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def age_at(dob: Column, on: date | str | Column) -> Column:
    """Whole years from `dob` to `on`; a birthday on the day itself counts."""
    elapsed = _yyyymmdd(as_date(on)) - _yyyymmdd(dob)
    return (elapsed / 10000).cast("int")


def year_boundaries(start: Column, end: Column) -> Column:
    """Calendar-year boundaries crossed, so 31 December to 1 January is 1."""
    return F.year(end) - F.year(start)
