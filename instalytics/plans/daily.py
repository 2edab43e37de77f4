"""One production run: warehouse tables in, the run's partition of the snapshot out."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..context import Ctx
from ..sources.bundle import read_warehouse
from ..sources.schemas import SCHEMAS
from .features import FeatureSet
from .snapshot import SnapshotTable
from .store import RunStore, run_key


def run(spark: SparkSession, warehouse: str, ctx: Ctx, snapshot: str) -> int:
    """Replace the partition of the run's region and date; returns the
    snapshot's new version. The intermediates are deleted at the end, also when
    the run fails."""
    inputs = [f"{warehouse.rstrip('/')}/{name}" for name in SCHEMAS]
    with RunStore(spark, run_key(spark, inputs, ctx)) as store:
        master = FeatureSet(read_warehouse(spark, warehouse), ctx, store)["fe33"]
        table = SnapshotTable(spark, snapshot, master.schema)
        return table.replace(master, [{"par_region": ctx.region, "par_process_date": ctx.today}])
