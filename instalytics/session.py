"""Session settings used by tests and the benchmark (local mode)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "instalytics") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only on measured sizes: no planning-time broadcast from file-size
        # estimates; AQE broadcasts a side once its shuffle output is known to be small
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        # no Python call-site capture on every DataFrame / Column call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Keep the cluster's ``spark.checkpoint.dir``. Only in local mode (tests,
    local runs) and only when it is unset, point it at a fresh scratch folder;
    on a cluster an unset folder is an error, never a machine-local path."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="instalytics-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


# Settings meant for the large-cluster run (a 1000-executor job over ~100 TB of
# events). Pass them to the cluster's session builder; nothing here changes
# results, only partition sizing and where Spark may broadcast.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    # many initial shuffle partitions, coalesced by AQE to ~256 MB each
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # hot keys: split skewed partitions of the streamed side of a join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    # Spark's own runtime Bloom filters: instalments of the run against the payments of all orders.
    # 2^30 bits (128 MB) hold about 100 million ids at 10 bits each; more ids filter less and nothing else
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "100000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "1073741824",
    # broadcast only on sizes measured at run time
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
