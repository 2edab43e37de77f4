"""The adapted sources written as a warehouse holds them, read by the reader,
turned into the master, written as a snapshot and read back."""

import dataclasses

import pytest

from instalytics import default_ctx
from instalytics.plans.features import FeatureSet
from instalytics.plans.snapshot import SnapshotTable
from instalytics.sources.bundle import read_warehouse
from instalytics.sources.testdata import build_sources

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark, ctx, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    src = build_sources(spark, SMOKE, ctx)
    for f in dataclasses.fields(src):
        df = getattr(src, f.name)
        parts = [c for c in ("par_region", "par_process_date", "par_created_date") if c in df.columns][:1]
        df.coalesce(1).write.partitionBy(*parts).parquet(f"{root}/{f.name}")
    return root


def test_master_from_the_warehouse_equals_the_master_from_the_adapters(spark, warehouse, fs, tmp_path):
    ctx = default_ctx()
    master = FeatureSet(read_warehouse(spark, warehouse), ctx)["fe33"]
    table = SnapshotTable(spark, str(tmp_path / "snap"), master.schema)
    table.replace(master, [{"par_region": ctx.region, "par_process_date": ctx.today}])
    got = table.read()
    want = fs["fe33"].select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_reader_names_a_wrong_column(spark, warehouse, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "order"))
    with pytest.raises(ValueError, match="source order: .*order_transaction_id: missing"):
        read_warehouse(spark, warehouse, {"order": str(tmp_path / "order")})
