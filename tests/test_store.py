"""The snapshot table and the store of intermediates."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from instalytics import catalog, default_ctx
from instalytics.plans import files
from instalytics.plans.features import FeatureSet
from instalytics.plans.snapshot import SnapshotTable
from instalytics.plans.store import RunStore, run_key
from instalytics.sources.testdata import build_sources

SMOKE = "/root/testdata/sf0.001"
DAY, NEXT = date(2001, 8, 2), date(2001, 8, 3)


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "id int, v string, par_region string, par_process_date date")


def _own(day=DAY, region="GB"):
    return {"par_region": region, "par_process_date": day}


@pytest.fixture()
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "snap"), _rows(spark, (1, "a", "GB", DAY)).schema)


def _all(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_a_run_replaces_all_it_owns_and_nothing_else(spark, table):
    assert _all(table) == []
    table.replace(_rows(spark, (1, "a", "GB", DAY), (2, "b", "GB", DAY), (3, "c", "GB", NEXT)), [_own(), _own(NEXT)])
    table.replace(_rows(spark, (9, "x", "US", DAY)), [_own(region="US")])
    table.replace(_rows(spark, (1, "again", "GB", DAY)), [_own()])                      # a smaller re-run
    assert _all(table) == [(1, "again", "GB", DAY), (3, "c", "GB", NEXT), (9, "x", "US", DAY)]
    table.replace(_rows(spark, (1, "a", "GB", DAY)).where("false"), [_own(), _own(NEXT)])  # an empty one
    assert _all(table) == [(9, "x", "US", DAY)]
    table.replace(_rows(spark, (1, "a", "GB", DAY)).where("false"), [_own(region="US")])
    assert _all(table) == [] and table.read().schema == table.schema


def test_a_failed_write_leaves_the_old_snapshot(spark, table):
    table.replace(_rows(spark, (1, "a", "GB", DAY)), [_own()])
    bad = _rows(spark, (2, "b", "GB", DAY), (3, "c", "GB", DAY)).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        table.replace(bad, [_own()])
    assert _all(table) == [(1, "a", "GB", DAY)]
    with pytest.raises(Exception, match="does not own"):
        table.replace(_rows(spark, (2, "b", "GB", DAY), (3, "c", "FR", DAY)), [_own()])
    assert _all(table) == [(1, "a", "GB", DAY)]


def test_two_runs_at_once_keep_both_partitions(spark, table, monkeypatch):
    """Another run publishes between this run's reading of the version and its publishing."""
    other = SnapshotTable(spark, table.path, table.schema)
    publish, raced = files.publish_json, []

    def late(spark_, path, value):
        if not raced:
            raced.append(True)
            other.replace(_rows(spark, (9, "x", "US", DAY)), [_own(region="US")])
        return publish(spark_, path, value)

    monkeypatch.setattr(files, "publish_json", late)
    assert table.replace(_rows(spark, (1, "a", "GB", DAY)), [_own()]) == 2
    assert _all(table) == [(1, "a", "GB", DAY), (9, "x", "US", DAY)]


def test_vacuum_deletes_replaced_runs_only(spark, table):
    table.replace(_rows(spark, (1, "a", "GB", DAY)), [_own()])
    table.replace(_rows(spark, (2, "b", "GB", DAY)), [_own()])
    assert table.vacuum() == 1 and table.vacuum() == 0
    assert _all(table) == [(2, "b", "GB", DAY)]


def test_features_of_a_run_write_an_intermediate_once(spark, tmp_path):
    ctx = default_ctx(materialize=True)
    key = run_key(spark, [f"{SMOKE}/{t}.parquet" for t in ("orders", "lineitem")], ctx)
    with RunStore(spark, key, root=str(tmp_path)) as store:
        src = build_sources(spark, SMOKE, ctx)
        first, second = FeatureSet(src, ctx, store), FeatureSet(src, ctx, store)
        a = first.result("fe02").count()
        assert second.result("fe02").count() == a
        second["fe05"].count()
        assert sorted(store.written) == ["fe01", "fe05", "instalments", "payments"]
        # another session's store of the same run finds them
        again = RunStore(spark.newSession(), key, root=str(tmp_path))
        FeatureSet(src, ctx, again)["fe05"].count()
        assert again.written == []
        path = store.path
        assert files.exists(spark, path)
    assert not files.exists(spark, path)


def test_the_key_follows_files_and_context(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.range(3).write.parquet(at)
    ctx = default_ctx()
    key = run_key(spark, [at], ctx)
    assert key == run_key(spark, [at], default_ctx()) != run_key(spark, [at], default_ctx(region="US"))
    spark.range(4).write.mode("overwrite").parquet(at)
    assert run_key(spark, [at], ctx) != key


def test_a_cleared_table_is_built_again(spark, tmp_path):
    store = RunStore(spark, "k", root=str(tmp_path))
    store.table("t", lambda: spark.range(3)).count()
    files.delete(spark, f"{store.path}/{store.entries()['t']}")
    assert store.table("t", lambda: spark.range(5)).count() == 5
    store.forget()
    assert store.entries() == {}
    store.delete()


@pytest.mark.parametrize("name", ["fe23", "fe25", "fe26"])
def test_fe05_is_read_by_instalment_without_an_exchange(spark, name):
    fs = catalog.feature_set(spark, SMOKE)
    fs["fe05"], fs["fe23"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = getattr(fs, f"_{name}")()._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert any("s_fe05_" in line and "Bucketed: true" in line for line in plan), "\n".join(plan)
    # FE05's column of the join; the other sides have key_payment_schedule_id
    assert not any("Exchange hashpartitioning(instalment_id#" in line for line in plan), "\n".join(plan)


def test_daily_run_leaves_the_snapshot_and_nothing_else(spark, tmp_path):
    import dataclasses

    from instalytics.plans import daily
    from instalytics.plans.materialize import checkpoint_root

    ctx = default_ctx()
    src = build_sources(spark, SMOKE, ctx)
    for f in dataclasses.fields(src):
        df = getattr(src, f.name)
        parts = [c for c in ("par_region",) if c in df.columns]
        df.coalesce(1).write.partitionBy(*parts).parquet(str(tmp_path / "wh" / f.name))
    before = files.names(spark, f"{checkpoint_root(spark)}/instalytics/store")
    assert daily.run(spark, str(tmp_path / "wh"), ctx, str(tmp_path / "snap")) == 1
    assert files.names(spark, f"{checkpoint_root(spark)}/instalytics/store") == before
    want = catalog.feature_set(spark, SMOKE)["fe33"]
    got = SnapshotTable(spark, str(tmp_path / "snap"), want.schema).read()
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
