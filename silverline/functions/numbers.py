"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.text import strip_money


def money(value: Column, precision: int = 15, scale: int = 2) -> Column:
    """Money text to an exact decimal, NULL when it does not parse or does not fit."""
    return strip_money(value).try_cast(f"decimal({precision},{scale})")


def whole_number(value: Column, kind: str = "smallint") -> Column:
    """Text to an integer type, rounding half away from zero; NULL when it does not fit."""
    return F.round(value.try_cast("decimal(38,10)"), 0).try_cast(kind)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def rounded_ratio(numerator: Column, denominator: Column, precision: int = 12, scale: int = 2) -> Column:
    """Quotient as a decimal: scaled up in double precision, rounded half away from zero."""
    scaled = F.round(guarded_ratio(numerator, denominator) * 10**scale, 0) / 10**scale
    return scaled.try_cast(f"decimal({precision},{scale})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(guarded_ratio(part, whole) * 100, digits)


def band(value: Column, bounds: list[tuple[float, str]], zero: str, otherwise: str) -> Column:
    """Ordered half-open bands: the first bound the value is below, `zero` for an exact zero."""
    out = F.when(value == 0, zero)
    for upper, name in bounds:
        out = out.when(value < upper, name)
    return out.otherwise(otherwise)
