"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialize import checkpoint_root, materialize
from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Lineage cut: written as Parquet under the shared checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return materialize(df, f"llm-{name}")


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder of that name below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{checkpoint_root(spark)}/instalytics/{name}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(divisor)


def one_blas_thread() -> None:
    """For tasks with many small products: Spark gives each Python worker as many
    BLAS threads as its executor has cores, and beside the other tasks these only
    wait for each other. Nothing changes where numpy has no OpenBLAS of its own."""
    folder = os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs")
    for name in os.listdir(folder) if os.path.isdir(folder) else []:
        if "openblas" in name:
            lib = ctypes.CDLL(os.path.join(folder, name))
            for call in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                if hasattr(lib, call):
                    getattr(lib, call)(1)


def spread_join(rows: DataFrame, sized: DataFrame, key: str, n: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``sized``, which has each key once and in
    ``n`` how many of the ``total`` rows have it. Keys with more than one part in
    ``share`` of the rows are fewer than ``share`` and are broadcast, so that no
    key that goes through the shuffle is hot."""
    hot = F.broadcast(sized.where(F.col(n) * share > total))
    cold = sized.where(F.col(n) * share <= total)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))
