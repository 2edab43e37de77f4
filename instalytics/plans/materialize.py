"""Lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (never a
    machine-local temp folder: on a cluster every executor must see it)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    A re-used intermediate then has a file lineage: recomputing a lost
    partition downstream re-reads files instead of replaying the joins."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/instalytics/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
