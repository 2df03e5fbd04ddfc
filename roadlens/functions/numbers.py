"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from roadlens.functions._col import as_col


def to_int(text: str | Column) -> Column:
    """Integer value of a text, null when it is not an integer."""
    return as_col(text).try_cast(T.IntegerType())


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of two non-negative integers (SQL ``div``)."""
    exact = (a - F.pmod(a, b)).cast(T.DecimalType(38, 0)) / b.cast(T.DecimalType(38, 0))
    return exact.cast(T.LongType())


def half_up_ratio(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``num / den`` rounded half-up to ``scale`` decimals, exactly.

    Computed in integers, ``(2 * 10^scale * num + den) div (2 * den)``, so a
    ratio lying exactly on a half (57/200 = 0.285) rounds up in every engine;
    rounding the binary double instead would give 0.28. Null when ``den`` is
    zero or null. Non-negative inputs.
    """
    n = as_col(num).cast(T.LongType())
    d = as_col(den).cast(T.LongType())
    unit = 10 ** scale
    scaled = F.when(d != 0, int_div(n * (2 * unit) + d, d * 2))
    return scaled.cast(T.DoubleType()) / F.lit(float(unit))


def format_double(value: str | Column, scale: int = 2) -> Column:
    """Round a double half-up to ``scale`` decimals.

    Ties are decided on the shortest decimal form of the double (0.285 ->
    0.29). :func:`format_double_binary` rounds the exact binary value, which
    gives 0.28 there; for ratios of counts use :func:`half_up_ratio`, which is
    exact.
    """
    return F.round(as_col(value).cast(T.DoubleType()), scale)


def format_double_binary(value: str | Column, scale: int = 2) -> Column:
    """Round a double half-up to ``scale`` (0 to 6) decimals by its exact binary value: 0.285 gives 0.28.

    The fraction r times 10^scale is held without error as two doubles: r is
    split into a high and a low part of 26 bits, whose products with the unit
    are exact. A tie is then decided by comparing them, not by their rounded
    sum. Ties go away from zero; null, NaN and infinities stay.
    """
    if not 0 <= scale <= 6:
        raise ValueError("scale is between 0 and 6")
    x, unit = as_col(value).cast(T.DoubleType()), F.lit(float(10 ** scale))
    size = F.abs(x)
    whole = F.when(size < F.lit(2.0 ** 52), F.floor(size)).otherwise(F.lit(0)).cast(T.LongType())
    rest = size - whole.cast(T.DoubleType())  # exact, below 1
    shifted = rest * F.lit(2.0 ** 27 + 1)
    high = shifted - (shifted - rest)
    low = rest - high
    down = F.floor(rest * unit).cast(T.DoubleType())
    up = (high * unit - down) - F.lit(0.5) >= -(low * unit)
    steps = (down + F.when(up, 1.0).otherwise(0.0)).cast(T.LongType())
    # a whole number of steps is exact below 2^53, and so is its quotient's rounding; beyond, as a decimal
    near = (whole * 10 ** scale + steps).cast(T.DoubleType()) / unit
    ten = F.lit(10 ** scale).cast(T.DecimalType(7, 0))
    far = ((whole.cast(T.DecimalType(16, 0)) * ten + steps.cast(T.DecimalType(7, 0))) / ten).cast(T.DoubleType())
    rounded = F.when(whole < F.lit(2 ** 53 // 10 ** scale - 1), near).otherwise(far)
    signed = F.when(x < 0, -rounded).otherwise(rounded)
    return F.when(size < F.lit(2.0 ** 52), signed).otherwise(x)
