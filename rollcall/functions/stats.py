"""Proportions with score intervals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollcall.constants import WILSON_Z
from rollcall.functions.text import round_half_up


def wilson_bounds(k: Column, n: Column, z: float = WILSON_Z) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson score interval as fractions; NULL when n = 0."""
    size = F.when(n > 0, n.cast("double"))
    share = k.cast("double") / size
    zz = F.lit(z) * F.lit(z)
    scale = F.lit(1.0) + zz / size
    centre = share + zz / (F.lit(2.0) * size)
    spread = F.lit(z) * F.sqrt(share * (F.lit(1.0) - share) / size
                               + zz / (F.lit(4.0) * size * size))
    low = F.when(size.isNotNull(), F.greatest(F.lit(0.0), (centre - spread) / scale))
    high = F.when(size.isNotNull(), F.least(F.lit(1.0), (centre + spread) / scale))
    return low, high


def percent(k: Column, n: Column, digits: int | None = 2) -> Column:
    """k of n in percent; NULL when there is nothing to divide by."""
    value = F.when(n > 0, F.lit(100.0) * (k.cast("double") / n.cast("double")))
    return value if digits is None else round_half_up(value, digits)


def share_of_previous(k: Column, previous: Column, digits: int = 2) -> Column:
    value = F.when(previous > 0, F.lit(100.0) * k.cast("double") / previous.cast("double"))
    return round_half_up(value, digits)


def wilson_columns(k: Column, n: Column, z: float = WILSON_Z, digits: int | None = 2,
                   empty: str = "null") -> list[Column]:
    """
    The columns n, k, pct, ci_low, ci_high, in percent.

    With empty="zero" an empty sample has the interval [0, 0], as in the one-off study;
    otherwise it has none.
    """
    low, high = (F.lit(100.0) * bound for bound in wilson_bounds(k, n, z))
    if empty == "zero":
        low, high = F.coalesce(low, F.lit(0.0)), F.coalesce(high, F.lit(0.0))
    if digits is not None:
        low, high = round_half_up(low, digits), round_half_up(high, digits)
    return [
        F.when(n > 0, n).otherwise(F.lit(0)).cast("bigint").alias("n"),
        F.when(n > 0, k).otherwise(F.lit(0)).cast("bigint").alias("k"),
        percent(k, n, digits).alias("pct"),
        low.alias("ci_low"),
        high.alias("ci_high"),
    ]


def wilson(k: Column, n: Column, z: float = WILSON_Z, digits: int | None = 2,
           empty: str = "null") -> Column:
    """The same five values as one struct."""
    return F.struct(*wilson_columns(k, n, z, digits, empty))
