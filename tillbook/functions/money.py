"""Order-independent money aggregates on double columns, without a cap.

Sums of doubles change with the order of the rows, so a retried task could move
a half-cent. Decimal sums are exact but cost over ten times as much, because
their buffers do not fit Spark's fast aggregation map. Here each value becomes a
whole number of 2**-40 units (about 1e-12), cut into two parts below 2**22 and
the rest above. The small parts are summed as bigints, which 2**41 rows fit; the
rest is a whole number in a double, whose sum is exact, and so independent of
the order, up to totals of 1.4e17. Beyond that it is as exact as a sum of
doubles. No value makes a sum fail; a total that has no DECIMAL(38,2), or that
holds an infinity or NaN, is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Totals are whole numbers of 1/1,000,000: rounding those to cents gives what rounding
# the exact sum would, as the errors of the units stay far below.
UNITS = 1_000_000
_FRACTION_BITS, _PART_BITS = 40, 22
_EXACT = float(1 << 53)  # whole doubles below are summed exactly
_LARGE = "1" + "0" * 30  # larger quotients are computed in doubles


def _whole(n: int) -> Column:
    """A constant as a decimal of its own length."""
    return F.lit(str(n)).cast(f"decimal({len(str(n))},0)")


def unit_parts(x: Column) -> tuple[Column, Column, Column]:
    """Aggregates: the three parts of a sum, which add up to those of a larger one."""
    base = F.lit(float(1 << _PART_BITS))
    units = F.rint(x * F.lit(float(1 << _FRACTION_BITS)))
    low = units % base
    above = (units - low) / base
    middle = above % base
    lows, middles = (F.sum(part.try_cast("bigint")).cast("decimal(20,0)") for part in (low, middle))
    return lows, middles, F.sum((above - middle) / base)


def units_of(lows: Column, middles: Column, rest: Column) -> Column:
    """The sum in 1/1,000,000 units as DECIMAL(38,0), halves away from zero, from its parts."""
    exact = (
        rest.try_cast("bigint").cast("decimal(16,0)") * _whole(1 << 2 * _PART_BITS)
        + F.coalesce(middles, _whole(0)) * _whole(1 << _PART_BITS)
        + F.coalesce(lows, _whole(0))
    )
    millionths = F.round(exact * _whole(15_625) / _whole(1 << 34), 0).cast("decimal(38,0)")  # 10**6 / 2**40
    rough = (rest * F.lit(float(1 << 2 * _PART_BITS - _FRACTION_BITS) * UNITS)).try_cast("decimal(38,0)")
    return F.when(F.abs(rest) < _EXACT, millionths).otherwise(rough)


def unit_sum(x: Column) -> Column:
    """Aggregate: the sum of ``x`` in 1/1,000,000 units as DECIMAL(38,0), halves away from zero."""
    return units_of(*unit_parts(x))


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    """Quotient of two whole numbers to 2 places, halves away from zero.

    Integer arithmetic, hence no double rounding, below 10**30. NULL when the
    denominator is 0 or either side is NULL.
    """
    b = F.nullif(F.abs(denominator), F.lit(0).cast("decimal(1,0)"))
    a = F.abs(numerator)
    dividend, divisor = a * 200 + b, b * 2
    quotient = F.floor(dividend / divisor)  # the quotient has few places, so it may be rounded up
    cents = quotient - F.when(quotient * divisor > dividend, 1).otherwise(0)
    exact = (cents.cast("decimal(36,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)")
    rough = F.round(a.cast("double") / b.cast("double"), 2).try_cast("decimal(38,2)")
    size = F.when((a < F.lit(_LARGE).cast("decimal(31,0)")) & (b < F.lit(_LARGE).cast("decimal(31,0)")), exact).otherwise(rough)
    return F.when((numerator < 0) != (denominator < 0), -size).otherwise(size)


def money_2dp(x: Column) -> Column:
    """One double as DECIMAL(38,2), for minima and maxima; NULL if it has no such value."""
    fine = F.round(x.try_cast("decimal(38,6)"), 2)
    return F.coalesce(fine, x.try_cast("decimal(38,2)")).cast("decimal(38,2)")


def units_2dp(units: Column) -> Column:
    """A unit total as currency with 2 places, halves away from zero."""
    return F.round(units * F.lit("0.000001").cast("decimal(6,6)"), 2).try_cast("decimal(38,2)")


def money_sum(x: Column) -> Column:
    """Aggregate: ``ROUND(SUM(x), 2)``."""
    return units_2dp(unit_sum(x))


def units_avg(units: Column, count: Column) -> Column:
    """The average in currency of a unit total over ``count`` values."""
    return ratio_2dp(units, count.cast("decimal(19,0)") * _whole(UNITS))


def money_avg(x: Column) -> Column:
    """Aggregate: ``ROUND(AVG(x), 2)``."""
    return units_avg(unit_sum(x), F.count(x))


def share_pct(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total``, 2 places; NULL if the total is 0."""
    small = F.when(F.abs(part) < F.lit(_LARGE).cast("decimal(31,0)"), part)
    exact = ratio_2dp(small * _whole(100), total)
    rough = F.round(part.cast("double") / F.nullif(total, F.lit(0).cast("decimal(1,0)")).cast("double") * 100, 2)
    return F.coalesce(exact, rough.try_cast("decimal(38,2)"))
