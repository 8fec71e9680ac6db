"""Exact decimal arithmetic with the rounding the results depend on.

Quotients are cut, not rounded, at a fixed number of digits; values are rounded half
up to three digits only where they are stored. Storage is DECIMAL(18,3), wide enough
that one extreme authorization cannot overflow and stop the job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS = "decimal(18,3)"


def truncated_quotient(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator of non-negative values, cut after `digits` decimals."""
    scaled = numerator.cast(HOURS) * F.lit(10**digits).cast("decimal(8,0)")
    units = F.floor(scaled / denominator.cast("decimal(10,0)")).cast("decimal(24,0)")
    # 22 digits hold any quotient, and leave room to multiply it without losing scale.
    return (units * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(22,{digits})")


def micro_hours(minutes: Column) -> Column:
    """Minutes as whole millionths of an hour, so that sums stay in LONG arithmetic."""
    return F.floor(minutes.cast("long") * 1_000_000 / F.lit(60)).cast("long")


def from_micro(units: Column) -> Column:
    """Millionths back to a decimal with six digits."""
    return (units.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast("decimal(26,6)")


def expected_hours(days: Column, hours_per_30: Column) -> Column:
    """Hours due for `days` enrolled at a monthly requirement; 0 if either is unknown."""
    daily = truncated_quotient(hours_per_30, F.lit(30), 7)
    return F.coalesce((days.cast("decimal(10,0)") * daily).cast(HOURS), F.lit(0).cast(HOURS))
