"""Exact global ``PERCENT_RANK() OVER (ORDER BY v)`` without one partition.

Plain ``percent_rank`` over an un-partitioned window moves every row into a
single task. Here:

1. ``dv`` = distinct values with their row counts (hash aggregate, map-side
   combine: a value held by a third of all rows is still one row);
2. quantiles of the distinct values give ``buckets - 1`` cut points (as many
   buckets as shuffle partitions, unless stated; see ``ranges.cut_points``);
3. each distinct value gets the bucket = number of cut points below it, by
   binary search; equal values share a bucket, so ties stay exact;
4. per-bucket totals (<= buckets + 1 rows, a proven bound -> broadcast)
   give the count of rows in all earlier buckets;
5. inside a bucket a running sum over distinct values gives the rows with a
   smaller value; rank = 1 + earlier + smaller, pr = (rank-1)/(n-1), 0 if n=1;
6. the rank is joined back on the value (null-safe). Nulls sort last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import range_count, with_sub_range


def percent_rank_global(df: DataFrame, value_col: str, name: str = "pct_rank", buckets: int | None = None) -> DataFrame:
    v = F.col(value_col)
    dv = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    dv = with_sub_range(dv, value_col, "_b", buckets or range_count(df))

    bt = dv.groupBy("_b").agg(F.sum("_cnt").alias("_bcnt"))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(
        "_b",
        F.coalesce(F.sum("_bcnt").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_bcnt").over(Window.partitionBy()).alias("_n"),
    )
    dv = dv.join(F.broadcast(bt), "_b")
    smaller = Window.partitionBy("_b").orderBy(v.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.lit(1) + F.col("_before") + F.coalesce(F.sum("_cnt").over(smaller), F.lit(0))
    pr = F.when(F.col("_n") > 1, (rank - 1).cast("double") / (F.col("_n") - 1).cast("double")).otherwise(F.lit(0.0))
    dv = dv.select(F.struct(v.alias("v")).alias("_v"), pr.alias(name))
    return df.select("*", F.struct(v.alias("v")).alias("_v")).join(dv, "_v", "left").select(*df.columns, name)
