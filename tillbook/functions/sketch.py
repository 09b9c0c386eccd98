"""Approximate distinct counts from HyperLogLog sketches, which can be stored and merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A sketch has 2**12 registers: 4 KB at most, and a relative standard error of 1.04 / 2**6.
LOG_REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def sketch(column: str) -> Column:
    """Aggregate: the sketch of the values that are not NULL."""
    return F.hll_sketch_agg(F.col(column), F.lit(LOG_REGISTERS))


def merged_sketch(column: str) -> Column:
    """Aggregate: the sketch of all values that any of some sketches has seen."""
    return F.hll_union_agg(F.col(column), F.lit(False))


def estimate(column: str) -> Column:
    """The number of distinct values that a sketch has seen; 0 without one."""
    return F.coalesce(F.hll_sketch_estimate(F.col(column)), F.lit(0))
