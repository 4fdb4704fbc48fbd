"""Exact ratios. Division by zero gives NULL, rounding is half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
_OPERAND = "decimal(28,6)"


def decimal_ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient with ten digits after the point, NULL for a zero denominator."""
    return F.try_divide(numerator.cast(_OPERAND), denominator.cast(_OPERAND))


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Quotient rounded once, half away from zero, by integer division of both operands' millionths.
    NULL for a zero denominator."""
    n, d = _millionths(numerator), _millionths(denominator)
    doubled = (F.abs(n) * F.lit(2 * 10**digits) + F.abs(d)).cast("decimal(38,0)")
    whole = F.call_function("div", doubled, F.nullif(F.abs(d) * F.lit(2), F.lit(0)).cast("decimal(38,0)"))
    sign = F.when((n < 0) == (d < 0), 1).otherwise(-1)
    return ((sign * whole).cast(f"decimal(28,0)") / F.lit(10**digits)).cast(f"decimal(28,{digits})")


def _millionths(value: Column) -> Column:
    return (value.cast(_OPERAND) * F.lit(1_000_000)).cast("decimal(28,0)")


def half_up(value: Column, digits: int = 2) -> Column:
    """Round a decimal or double half away from zero, as a decimal of that scale."""
    return F.round(value.cast("decimal(38,10)"), digits).cast(f"decimal(28,{digits})")
