"""Column expressions; all of them stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# The power of two of the smallest normal double; smaller ones count in its steps.
LEAST_POWER = -1022


def log_plus_one(column: str | Column) -> Column:
    """``ln(x + 1)``; null where ``x + 1`` is not positive."""
    return F.log(_col(column) + 1)


def not_nan(column: str | Column) -> Column:
    """The value as double, with NaN turned into null."""
    value = _col(column).cast("double")
    return F.when(~F.isnan(value), value)


def impute(column: str | Column, value: float) -> Column:
    return F.coalesce(not_nan(column), F.lit(float(value)))


def min_max(column: str | Column, low: Column | float, high: Column | float) -> Column:
    """Position of the value between ``low`` and ``high``, not clipped; 0.5 if they are equal."""
    low, high = _value(low), _value(high)
    return F.when(high == low, F.lit(0.5)).otherwise((_col(column) - low) / (high - low))


def unit_interval(key: str | Column) -> Column:
    """A number in [0, 1) that depends on the key alone.

    The first 32 bits of its md5, so that any engine can recompute it.
    """
    head = F.substring(F.md5(_col(key).cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(float(2**32))


def logistic(columns: Sequence[str | Column], weights: Sequence[float], intercept: float) -> Column:
    """Probability of class 1 under a fitted logistic regression."""
    margin = F.lit(float(intercept))
    for column, weight in zip(columns, weights, strict=True):
        margin = margin + F.lit(float(weight)) * _col(column)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def ordered_bits(column: str | Column) -> Column:
    """A whole number that orders doubles as their values do: the bits of the absolute value, with the value's sign.

    Spark has no view of a double's bits, so they follow from its power of two and what is left of it, both exact. Zero of
    either sign is 0; null and NaN have no place in the order and must be left out before.
    """
    value = F.abs(_col(column).cast("double"))
    near = F.greatest(F.floor(F.log2(value)), F.lit(LEAST_POWER))
    power = F.pow(F.lit(2.0), near)
    # The logarithm may be rounded across a power of two.
    exact = F.when((power > value) & (near > LEAST_POWER), near - 1).when(value >= 2 * power, near + 1).otherwise(near)
    rest = (value / F.pow(F.lit(2.0), exact) * float(2**52)).cast("bigint")
    bits = (
        F.when(value == 0, F.lit(0).cast("bigint"))
        .when(value == float("inf"), F.lit(2047 * 2**52))
        .otherwise((exact - LEAST_POWER) * F.lit(2**52) + rest)
    )
    return F.when(_col(column) < 0, -bits).otherwise(bits)


def vector_element(column: str, position: int) -> Column:
    return vector_to_array(F.col(column))[position]


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _value(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
