"""Aggregates with a better shape than the literal SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import any_when


def count_distinct_when(df: DataFrame, keys, id_col: str, conds: dict[str, Column]) -> DataFrame:
    """Per ``keys``: ``COUNT(DISTINCT CASE WHEN cond THEN id END)`` for each
    named condition, without ``Expand``.

    Level 1 groups by (keys, id) and keeps a 0/1 flag "some row of this id
    passes cond"; level 2 sums the flags per key (null ids never count).
    Both levels are plain hash aggregates with map-side combine, so the
    number of conditions does not multiply the rows that are shuffled."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = list(conds)
    lvl1 = df.groupBy(*keys, id_col).agg(*[any_when(conds[n]).alias(f"_f{i}") for i, n in enumerate(names)])
    has_id = F.col(id_col).isNotNull()
    return lvl1.groupBy(*keys).agg(*[
        F.sum(F.when(has_id, F.col(f"_f{i}")).otherwise(F.lit(0))).cast("bigint").alias(n)
        for i, n in enumerate(names)])
