"""Top-1 per key, numbering inside a group, previous value in time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import with_sub_range


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _desc_key(cols) -> list[Column]:
    """Struct fields that order like ``ORDER BY c DESC`` with nulls first
    (the warehouse's default for DESC), under ``max``."""
    out = []
    for i, c in enumerate(cols):
        c = _c(c)
        out += [c.isNull().alias(f"_n{i}"), c.alias(f"_v{i}")]
    return out


def latest_per_key(df: DataFrame, keys, order, tiebreak=()) -> DataFrame:
    """One row per ``keys``: the row first under ``order`` DESC NULLS FIRST,
    ties broken by ``tiebreak`` (same direction), then by the remaining
    columns, so the pick is deterministic.

    Written as ``groupBy(keys).max(struct(order..., row))`` rather than
    ``row_number() = 1``: the partial aggregate leaves one row per key and
    task, so a hot key does not meet in one task. A struct cannot be a
    mutable hash-aggregate buffer, so Spark sorts by key on both sides of the
    exchange (SortAggregate).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    payload = F.struct(*[F.col(c) for c in cols if c not in keys]).alias("_row")
    best = F.max(F.struct(*_desc_key(list(order) + list(tiebreak)), payload)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*").select(*cols)


def number_in_group(df: DataFrame, keys, order, name: str, tiebreak=(), buckets: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order ASC NULLS LAST)``
    as BIGINT, always in two levels.

    The range of the first order column is cut at quantiles of all rows
    (``buckets``, else as many as shuffle partitions); rows are numbered per
    (key, sub-range) and offset by the row count of the key's earlier sub-ranges
    (a running sum over at most ``buckets`` + 1 rows per key). A key with a third
    of all rows is thus spread over its share of the sub-ranges. Equal values
    share a sub-range, nulls have one of their own, and a null key is a group.

    Key and sub-range are one struct, which is never null: the offsets join on
    it by plain equality, so the rows stay where the window put them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [_c(c) for c in list(order) + list(tiebreak)]
    cols = df.columns
    rows = with_sub_range(df.withColumn("_first", order_cols[0]), "_first", "_sub", buckets)
    rows = rows.select(*cols, _group_struct(keys, "_sub"))
    inside = Window.partitionBy("_g").orderBy(*[c.asc_nulls_last() for c in order_cols])
    rows = rows.withColumn("_local", F.row_number().over(inside))
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_cnt"))
    earlier = Window.partitionBy(*[f"_g.k{i}" for i in range(len(keys))]).orderBy("_g.sub").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_g", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_off"))
    return rows.join(offs, "_g").select(*cols, (F.col("_off") + F.col("_local")).cast("bigint").alias(name))


def _group_struct(keys: list[str], sub: str) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(sub).alias("sub")).alias("_g")


def previous_value(df: DataFrame, keys, time_col, value_col, name: str, dtype: str, default=0, tiebreak=(),
                   buckets: int | None = None) -> DataFrame:
    """Value of the next older row of the same key (``LEAD`` over time DESC,
    ties by ``tiebreak`` DESC, nulls first), cast to ``dtype``; ``default``
    for the oldest row.

    The window runs per (key, sub-range of the times), the sub-ranges cut at
    quantiles of all rows (``buckets``, else as many as shuffle partitions), so
    a hot key is spread even if all its rows are of one day. The oldest row of
    a sub-range takes its predecessor from a summary -- the newest value of
    each (key, sub-range), shifted by one with a window over at most
    ``buckets`` + 1 rows per key -- which joins on the struct of key and
    sub-range that the window is partitioned by, so the rows are not moved
    again."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [_c(c).desc_nulls_first() for c in [time_col, *tiebreak]]
    val = _c(value_col)
    cols = df.columns
    b = with_sub_range(df, time_col, "_bk", buckets).select(*cols, _group_struct(keys, "_bk"))
    w = Window.partitionBy("_g").orderBy(*order)
    # the next row (a struct, null only when there is none) and the row's position
    b = b.select("*", F.lead(F.struct(val.alias("v")), 1).over(w).alias("_nx"), F.row_number().over(w).alias("_rn"))
    newest = b.where(F.col("_rn") == 1).select("_g", F.struct(val.alias("v")).alias("_nv"))
    older = Window.partitionBy(*[f"_g.k{i}" for i in range(len(keys))]).orderBy(F.col("_g.sub").desc())
    edge = newest.select("_g", F.lead("_nv", 1).over(older).alias("_pb")).where(F.col("_pb").isNotNull())
    rows = b.join(edge, "_g", "left").withColumn("_p", F.coalesce("_nx", "_pb"))
    dflt = F.lit(default).cast(dtype)
    return rows.select(*cols, F.coalesce(F.col("_p.v").cast(dtype), dflt).alias(name))
