"""Plan shapes and result properties of the features (smoke tables)."""

import pytest
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [f"fe{i:02d}" for i in range(1, 34)])
def test_no_cartesian_products(fs, name):
    p = plan(fs[name])
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_ontime_uses_anti_join(spark, ctx):
    from instalytics import catalog, default_ctx
    from instalytics.plans import FeatureSet

    lazy = FeatureSet(catalog.feature_set(spark, "/root/testdata/sf0.001").src, default_ctx())
    assert "LeftAnti" in plan(lazy["fe26"])


def test_percentile_has_no_global_window(fs):
    p = plan(fs["fe21"])
    assert "percent_rank" not in p


def test_local_window_reaches_the_scan(spark):
    """Region / ingestion date prune partitions; the exact local-day window
    (per-country epoch-ms ranges) and its coarse bound reach Parquet."""
    import tempfile
    from datetime import date

    from instalytics import default_ctx
    from instalytics.plans.limits import fe06_order_d360
    from instalytics.sources.schemas import SCHEMAS

    path = tempfile.mkdtemp(prefix="instalytics-scan-") + "/order"
    row = (1, "c1", "GB", 996000000000, False, None, "APPROVED", "APPROVED", "t1", -1, "GB", date(2001, 7, 25))
    spark.createDataFrame([row], SCHEMAS["order"]).write.partitionBy("par_region", "par_process_date").parquet(path)
    order = spark.read.schema(SCHEMAS["order"]).parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        df = fe06_order_d360(order, default_ctx())
        p = plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p.split("PushedFilters: ")[1].split("], ")[0]
    parts = p.split("PartitionFilters: ")[1].split("], ")[0]
    assert "par_region" in parts and "par_process_date" in parts
    assert "LessThan(key_event_info_event_time" in pushed and "EqualTo(country_code,GB)" in pushed
    assert df.count() == 1


def test_master_one_row_per_consumer(fs):
    m = fs["fe33"]
    assert len(m.columns) == 45
    assert m.count() == m.select("consumer_uuid").distinct().count() == fs["fe22"].count()


def test_master_value_properties(fs):
    m = fs["fe33"]
    bad = m.where(
        (F.col("c_late_fee_paid_cnt_90d_v3") > F.col("c_late_fee_paid_cnt_360d_v3"))
        | (F.col("c_late_fee_paid_amount_90d_v3") > F.col("c_late_fee_paid_amount_360d_v3"))
        | (F.col("c_max_util_amt_after_limit_change_180d_v3") < 0)
        | ~F.col("c_order_amt_percentile_180d_v3").between(0, 100)).count()
    assert bad == 0


def test_ontime_and_overdue_disjoint(fs):
    ot = fs["fe26"].select("instalment_id")
    ovd = fs["fe23"].select(F.col("key_payment_schedule_id").alias("instalment_id"))
    assert ot.join(ovd, "instalment_id").count() == 0


def test_rerun_is_identical(spark):
    from instalytics import catalog

    a = catalog.queries()["fe17_cust_latefee"](spark, "/root/testdata/sf0.001")
    b = catalog.queries()["fe17_cust_latefee"](spark, "/root/testdata/sf0.001")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("plain,rolled", [("fe10", "fe10m"), ("fe19", "fe19m"), ("fe21", "fe21m")])
def test_order_rollup_forms_equal_standalone(fs, plain, rolled):
    a, b = fs[plain], fs[rolled].select(*fs[plain].columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_payments_are_filtered_by_the_instalments_before_their_exchange(spark):
    """With the cluster's settings (and no least scan size) Spark puts a Bloom
    filter of FE01's instalments on the payments' scan; fewer rows are shuffled
    and the result is the same."""
    from instalytics import catalog
    from instalytics.session import CLUSTER_CONF

    fs = catalog.feature_set(spark, "/root/testdata/sf0.001")
    fs["fe01"], fs["payments"]
    plain = fs._fe04()
    rows = sorted(map(str, plain.collect()))
    conf = {k: v for k, v in CLUSTER_CONF.items() if "bloomFilter" in k}
    conf["spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"] = "0"
    conf["spark.sql.adaptive.enabled"] = "false"
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = fs._fe04()
        lines = plan(df).splitlines()
        at = [i for i, line in enumerate(lines) if "might_contain" in line and "_iid" in line and "Filter" in line]
        assert at, "\n".join(lines)
        above = [line for line in lines[: at[0]] if "Exchange hashpartitioning(key_payment_schedule_id" in line]
        assert above, "\n".join(lines)
        assert sorted(map(str, df.collect())) == rows
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_order_history_is_not_sorted(spark, ctx):
    """FE10's latest order and the rollup reduce orders by hash aggregates; what
    is sorted is one row per consumer and country."""
    from instalytics.plans.consumer import order_rollup
    from instalytics.plans.limits import latest_approved_order
    from instalytics.sources.testdata import build_sources

    order = build_sources(spark, "/root/testdata/sf0.001", ctx).order
    for df in (latest_approved_order(order, ctx), order_rollup(order, ctx)):
        lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        aggs = [line for line in lines if "Aggregate(" in line]
        assert "SortAggregate" in aggs[0] and all("HashAggregate" in a for a in aggs[2:]) and len(aggs) == 4, "\n".join(aggs)


def test_shared_join_is_narrow_and_has_partitions_by_the_size_of_its_files(spark, ctx, monkeypatch):
    """The rows of lineitem and orders that every feature waits for carry no text, are joined
    in as many partitions as their files need, and neither orders nor events are copied."""
    import re

    from instalytics.sources import testdata

    def shared():
        staged = {}

        def stage(df, name):
            return staged.setdefault(name, df)

        testdata.build_sources(spark, "/root/testdata/sf0.001", ctx, stage)
        return staged

    def exchanges(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [int(n) for n in re.findall(r"Exchange hashpartitioning\([^,]+, (\d+)\)", plan)]

    staged = shared()
    assert not {"o", "events"} & set(staged)
    assert "string" not in dict(staged["line"].dtypes).values()
    assert exchanges(staged["line"]) == [int(spark.conf.get("spark.sql.shuffle.partitions"))] * 2
    monkeypatch.setattr(testdata, "PART_BYTES", 1000)
    want = testdata.join_partitions(spark, "/root/testdata/sf0.001")
    assert want > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert exchanges(shared()["line"]) == [want] * 2
