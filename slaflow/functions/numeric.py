"""Numeric expressions: text-to-number parsing, rates, the rounding families.

Three rounding families exist and are kept apart on purpose:

* ``kpi_round`` / ``safe_rate`` - the exact binary value to the nearest
  decimal, half-even, as Python's ``round`` (the KPI row and the process
  tables);
* ``scaled_round`` - half-even on the scaled binary product (case spans);
* ``sql_round`` / ``sql_ratio`` - half away from zero on the scaled binary
  product (the SQL marts);
* minute clamps round to an integer half-even with Spark ``rint``.

Spark's ``round``/``bround`` with d > 0 round the shortest decimal text of
the double instead, which differs on values like 1.005 whose binary value
lies below the printed tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: What counts as a number: ASCII digits with a point and an exponent, or an
#: infinity.  (A cast alone also takes Java's ``240d`` and ``0x1p3``.)
NUMBER = r"\A[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\z"


def parse_number(trimmed_text: Column) -> Column:
    """Text to double, NULL when the text is blank or not a number."""
    return F.when(trimmed_text.rlike(NUMBER), trimmed_text.try_cast("double"))


def is_integral(number: Column) -> Column:
    """A parsed number that can be typed as an integer (finite, no fraction)."""
    return (
        number.isNotNull()
        & ~F.isnan(number)
        & (F.abs(number) != F.lit(float("inf")))
        & (number == F.floor(number))
    )


def kpi_round(value: Column, digits: int) -> Column:
    """The nearest decimal of the exact binary value, half-even.

    The product x * 10^d is rounded; where it lands on .5, the error of the
    product (exact: x is split into halves of 27 bits, 10^d has fewer bits
    than the rest) tells on which side of the tie the value is.
    """
    if 10**digits >= 1 << 26:
        raise ValueError("at most 7 decimals")
    x, scale = value.cast("double"), F.lit(float(10**digits))
    product = x * scale
    high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    error = (high * scale - product) + (x - high) * scale
    tie = product - F.floor(product) == F.lit(0.5)
    nearest = (
        F.when(tie & (error > 0), F.ceil(product).cast("double"))
        .when(tie & (error < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return nearest / scale


def scaled_round(value: Column, digits: int) -> Column:
    """Half-even on the scaled binary product."""
    scale = F.lit(float(10**digits))
    return F.rint(value.cast("double") * scale) / scale


def sql_round(value: Column, digits: int) -> Column:
    """Half away from zero at ``digits`` decimals."""
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def safe_rate(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """numerator / denominator rounded half-even; 0.0 when the denominator is 0."""
    ratio = F.try_divide(numerator.cast("double"), F.nullif(denominator.cast("double"), F.lit(0.0)))
    return F.coalesce(kpi_round(ratio, digits), F.lit(0.0))


def sql_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """ROUND(numerator / NULLIF(denominator, 0), digits): NULL on a zero denominator."""
    ratio = F.try_divide(numerator.cast("double"), F.nullif(denominator.cast("double"), F.lit(0.0)))
    return sql_round(ratio, digits)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def count_when(condition: Column) -> Column:
    """Count of rows where the condition is TRUE (NULL counts as no)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
