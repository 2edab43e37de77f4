"""Conditional aggregates (``SUM/MAX/MIN(CASE WHEN ...)``) as built-ins.

They stay ordinary hash-aggregate functions: partial aggregation runs before
the shuffle, so a hot key costs one row per map task, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT (0 for no match)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_when(cond: Column, value, zero=None, dtype: str | None = None) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``; ``dtype`` casts the sum."""
    value = _c(value)
    zero = F.lit(0) if zero is None else zero
    out = F.sum(F.when(cond, value).otherwise(zero))
    return out.cast(dtype) if dtype else out


def max_when(cond: Column, value) -> Column:
    """``MAX(CASE WHEN cond THEN value END)`` (null when nothing matches)."""
    return F.max(F.when(cond, _c(value)))


def min_when(cond: Column, value) -> Column:
    return F.min(F.when(cond, _c(value)))


def any_when(cond: Column) -> Column:
    """``MAX(CASE WHEN cond THEN 1 ELSE 0 END)`` (boolean-or as 0/1)."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))
