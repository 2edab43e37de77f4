"""The set of 19 input DataFrames a feature run reads, and the standard
source filters (region partition, ingestion-date horizon)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..context import Ctx
from .schemas import SCHEMAS


@dataclass
class Sources:
    payment_scheduled: DataFrame
    order: DataFrame
    due_date_changed: DataFrame
    instalment_payment: DataFrame
    payment_processed: DataFrame
    became_overdue: DataFrame
    schedule_override: DataFrame
    decision_value_change: DataFrame
    limit_change_backfill: DataFrame
    decision_vars: DataFrame
    rules_engine_result: DataFrame
    pre_approval: DataFrame
    credit_limit_result: DataFrame
    late_fee_applied: DataFrame
    late_fee_payment: DataFrame
    late_fee_waived: DataFrame
    late_fee_refunded: DataFrame
    consumer: DataFrame
    limit_daily: DataFrame


def read_warehouse(spark: SparkSession, root: str, paths: dict[str, str] | None = None) -> Sources:
    """Read the 19 tables as Parquet with their declared schemas.

    ``root/<name>`` per table unless ``paths`` overrides it. Event tables are
    expected to be partitioned by ``par_region`` / ``par_process_date``
    directories, so the source filters below prune partitions.

    Every table's own schema is read first: a missing column or one of another
    type fails here, by name, instead of being read as nulls."""
    paths = paths or {}
    dfs = {}
    for name, schema in SCHEMAS.items():
        path = paths.get(name, f"{root.rstrip('/')}/{name}")
        _validate(name, schema, spark.read.option("basePath", path).parquet(path).schema)
        dfs[name] = spark.read.schema(schema).option("basePath", path).parquet(path)
    return Sources(**dfs)


def _validate(name: str, want: StructType | str, found: StructType) -> None:
    want = want if isinstance(want, StructType) else StructType.fromDDL(want)
    have = {f.name: f.dataType for f in found}
    wrong = [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}, wanted {f.dataType.simpleString()}"
             for f in want if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"source {name}: " + "; ".join(wrong))


def in_region(df: DataFrame, ctx: Ctx) -> Column:
    return df["par_region"] == F.lit(ctx.region)


def since(df: DataFrame, ctx: Ctx, days: int, col: str = "par_process_date") -> Column:
    """``par_process_date >= DATE(SYSDATE) - days`` as a literal bound."""
    return df[col] >= F.lit(ctx.horizon(days))


def scan(df: DataFrame, ctx: Ctx, days: int | None = None, region: bool = True) -> DataFrame:
    """Region partition filter + optional ingestion horizon (FL01, FL02)."""
    if region:
        df = df.where(in_region(df, ctx))
    if days is not None:
        df = df.where(since(df, ctx, days))
    return df
