"""Arithmetic Column expressions that never fail on bad input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import TRUE_FLAGS, col, truthy


def ratio(num, den, default: float | None = None) -> Column:
    """num / den; a zero or NULL denominator gives ``default`` (NULL if none)."""
    r = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def capped(c, ceiling: float) -> Column:
    return F.least(col(c), F.lit(float(ceiling)))


def clip(c, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col(c)))


def in_range(c, lo, hi) -> Column:
    """True inside the closed range; NULL and NaN are false."""
    v = col(c)
    return F.coalesce((v >= lo) & (v <= hi) & ~F.isnan(v.cast("double")), F.lit(False))


def null_unless(c, keep: Column) -> Column:
    return F.when(keep, col(c))


def non_negative(c) -> Column:
    return F.when(col(c) < 0, F.lit(None)).otherwise(col(c))


def kwh_to_kbtu(c) -> Column:
    return col(c) * 3.41214


def rating(c, high: float = 75, medium: float = 50) -> Column:
    v = col(c)
    return (
        F.when(v.isNull(), F.lit("Unknown"))
        .when(v >= high, F.lit("High"))
        .when(v >= medium, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def risk_tier(score, high: float = 66, medium: float = 33) -> Column:
    v = col(score)
    return (
        F.when(v >= high, F.lit("HIGH")).when(v >= medium, F.lit("MEDIUM")).otherwise(F.lit("LOW"))
    )


def count_truthy(cols, values=TRUE_FLAGS) -> Column:
    return reduce(lambda a, b: a + b, [truthy(c, values).cast("int") for c in cols])


def all_truthy(cols, values=TRUE_FLAGS) -> Column:
    return reduce(lambda a, b: a & b, [truthy(c, values) for c in cols])


def severity(value, warning: float, critical: float, none="none") -> Column:
    v = col(value)
    return (
        F.when(v >= critical, F.lit("critical")).when(v >= warning, F.lit("warning")).otherwise(F.lit(none))
    )
