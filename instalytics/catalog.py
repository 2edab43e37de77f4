"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Feature queries run over the whole test tables through the adapters; the
operator queries (``op_*``) exercise one reusable operator each on data the
adapters / features derive from the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .context import Ctx, default_ctx
from .oracle.sql import oracle_query
from .plans.features import FeatureSet
from .plans.materialize import checkpoint_root
from .plans.snapshot import SnapshotTable
from .plans.store import RunStore, run_key
from .session import ensure_checkpoint_dir
from .sources.testdata import TEST_TABLES, build_sources, staged_sources

FEATURES = {
    "fe01_instal_invoice": "fe01",
    "fe02_due_date_history": "fe02",
    "fe03_due_date_valid": "fe03",
    "fe04_instal_events": "fe04",
    "fe05_instal_events_agg": "fe05",
    "fe06_order_d360": "fe06",
    "fe07_line_change": "fe07",
    "fe08_line_change_window": "fe08",
    "fe09_de_limit": "fe09",
    "fe10_cust_approved_limit": "fe10",
    "fe11_order_attempt": "fe11",
    "fe12_limit_check": "fe12",
    "fe13_otb": "fe13",
    "fe14_latefee_invoice": "fe14",
    "fe15_latefee_events": "fe15",
    "fe16_latefee_events_agg": "fe16",
    "fe17_cust_latefee": "fe17",
    "fe18_cust_pymt_method": "fe18",
    "fe19_cust_order_d180": "fe19",
    "fe20_cust_account_limit": "fe20",
    "fe21_cust_approved_order_d180": "fe21",
    "fe22_cust_base": "fe22",
    "fe23_instal_ovd_d360": "fe23",
    "fe24_cust_ovd_d360": "fe24",
    "fe25_cust_instal_d360": "fe25",
    "fe26_instal_ontime_d180": "fe26",
    "fe27_cust_ontime_d180": "fe27",
    "fe28_cust_ovd_d180": "fe28",
    "fe29_cust_late_expt_d360": "fe29",
    "fe30_cust_ovd_limit_d360": "fe30",
    "fe31_util_d180": "fe31",
    "fe32_cust_util_d180": "fe32",
    "fe33_consumer_master": "fe33",
}


def feature_set(spark: SparkSession, sf_dir: str, ctx: Ctx | None = None) -> FeatureSet:
    """The features over the test tables. With ``ctx.materialize`` the adapted
    sources and the re-used intermediates are in the run's store, where later
    queries with the same tables and context find them."""
    ctx = ctx or default_ctx(materialize=True)
    if not ctx.materialize:
        return FeatureSet(build_sources(spark, sf_dir, ctx), ctx)
    store = run_store(spark, sf_dir, ctx)
    return FeatureSet(staged_sources(spark, sf_dir, ctx, store), ctx, store)


def run_store(spark: SparkSession, sf_dir: str, ctx: Ctx | None = None) -> RunStore:
    """The store of this application's registered queries over one set of
    tables; it goes when the process ends, so no other application shares it."""
    ensure_checkpoint_dir(spark)
    tables = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TEST_TABLES]
    return RunStore(spark, run_key(spark, tables, ctx or default_ctx(materialize=True), spark.sparkContext.applicationId))


def _feature_query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feature_set(spark, sf_dir).result(key)

    run.__name__ = key
    return run


def sk05_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's partition of a snapshot table under the shared folder, first
    published empty, then replaced by the master, and that snapshot read back."""
    fs = feature_set(spark, sf_dir)
    df = fs["fe33"]
    table = SnapshotTable(spark, f"{checkpoint_root(spark)}/instalytics/snapshot-{uuid.uuid4().hex}", df.schema)
    owned = [{"par_region": fs.ctx.region, "par_process_date": fs.ctx.today}]
    table.replace(df.where("false"), owned)
    table.replace(df, owned)
    return table.read()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .opqueries import OP_QUERIES

    out = {name: _feature_query(key) for name, key in FEATURES.items()}
    out.update(OP_QUERIES)
    out["sk05_snapshot"] = sk05_snapshot
    return out


def oracle_sql(ctx: Ctx | None = None) -> dict[str, str]:
    from .opqueries import op_oracle_sql

    ctx = ctx or default_ctx()
    out = {name: oracle_query(key, ctx) for name, key in FEATURES.items()}
    out.update(op_oracle_sql(ctx))
    out["sk05_snapshot"] = oracle_query("fe33", ctx)
    return out
