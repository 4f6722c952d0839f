"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(amount: Column) -> Column:
    """Sum of a double column, exact to twelve decimals of every row, as ``decimal(38,6)``.

    Each amount is cut into billions, units, millionths and the rest in millionths of
    those; all four add up as integers, so the result does not depend on the order of the
    rows, does not overflow for amounts up to 1e27, and small amounts are not rounded away
    before they are added. Integer sums are several times faster than decimal buffers.
    """
    rest = amount % F.lit(1e9)  # exact, with the sign of the amount
    unit = F.floor(rest)
    micro = (rest - unit) * 1_000_000
    whole_micro = F.floor(micro)
    pico = F.floor((micro - whole_micro) * 1_000_000 + 0.5)
    billions = F.round((amount - rest) / 1e9).cast("bigint")
    small = F.sum(whole_micro).cast("decimal(24,0)") * F.lit(1_000_000) + F.sum(pico).cast("decimal(24,0)")
    return (
        F.sum(billions).cast("decimal(19,0)") * F.lit(1_000_000_000)
        + F.sum(unit).cast("decimal(19,0)")
        + (small / F.lit(10**12).cast("decimal(13,0)")).cast("decimal(30,12)")
    ).cast("decimal(38,6)")


def as_money(total: Column, digits: int = 2) -> Column:
    """A decimal total as a rounded double."""
    return F.round(total, digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` rounded; a zero or missing denominator gives NULL."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def half_even(value: Column, digits: int = 2) -> Column:
    """Round a double the way Python's ``round`` does.

    The decision uses the exact binary value: ``value * 10**digits`` is split into
    a rounded product and its exact rounding error (Dekker's product), so 0.025,
    stored slightly above the tie, becomes 0.03 and 0.125, a true tie, 0.12.
    """
    scale = float(10**digits)
    x = value.cast("double")
    spread = x * F.lit(134217729.0)  # 2**27 + 1 splits a double in two halves
    high = spread - (spread - x)
    low = x - high
    product = x * F.lit(scale)
    error = (high * F.lit(scale) - product) + low * F.lit(scale)
    floor = F.floor(product).cast("double")
    rest = product - floor
    even = F.pmod(floor, F.lit(2.0)) == 0
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & ~even)))
    return (floor + F.when(up, 1.0).otherwise(0.0)) / F.lit(scale)
