"""Pivot by day offset and type-aligned unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_day_offsets(df: DataFrame, keys, date_col: str, value_col: str, today: Column, offsets, name_fmt: str) -> DataFrame:
    """One row per ``keys``; column ``name_fmt.format(k)`` = max value dated
    ``today - k`` (null when that day is missing). One pass, one aggregate."""
    aggs = [
        F.max(F.when(F.col(date_col) == F.date_sub(today, k), F.col(value_col))).alias(name_fmt.format(k))
        for k in offsets
    ]
    return df.groupBy(*keys).agg(*aggs)


def union_aligned(dfs, schema) -> DataFrame:
    """Bag union (``UNION ALL``) after projecting every input onto ``schema``
    = [(name, type)], missing columns as typed nulls. No de-duplication."""
    def align(df):
        have = set(df.columns)
        return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in schema])
    return reduce(lambda a, b: a.unionByName(b), [align(d) for d in dfs])
