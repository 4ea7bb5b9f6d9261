"""Exact rounding of quotients of whole numbers, half away from zero.

Rounding a double depends on how the tie is represented, and a decimal
division is already rounded once before ``round`` sees it.  Both are avoided
by rounding the fraction itself.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

_WHOLE = "decimal(38,0)"


def half_up_units(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded to ``digits`` places, in units of the last place; NULL where den is 0 or NULL."""
    double_den = F.nullif(den.cast(_WHOLE), F.lit(0).cast(_WHOLE)) * 2
    shifted = F.abs(num.cast(_WHOLE)) * (2 * 10**digits) + den.cast(_WHOLE)
    size = F.call_function("div", shifted, double_den)
    return F.when(num < 0, -size).otherwise(size)


def ratio(num: Column, den: Column, digits: int) -> Column:
    """Rounded quotient as a double."""
    return half_up_units(num, den, digits) / F.lit(float(10**digits))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part.cast(_WHOLE) * 100, whole, digits)


def decimal_ratio(num: Column, den: Column, digits: int, precision: int = 4) -> Column:
    """Rounded quotient as DECIMAL(precision, digits)."""
    units = half_up_units(num, den, digits).cast("decimal(18,0)")
    return (units * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal({precision},{digits})")


def mean_of(total: Column, count: Column, scale: int, digits: int) -> Column:
    """Mean of a decimal column with ``scale`` places from its sum and its non-null count."""
    return ratio(total * 10**scale, count * 10**scale, digits)
