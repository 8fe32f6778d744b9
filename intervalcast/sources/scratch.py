"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of this machine: on
    a cluster the executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name nobody else uses, under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """The rows as a columnar table in a new shared folder, with no lineage behind them.

    What is read from here on stays the same after a lost executor, and each reader fetches
    only the columns (and, with ``partition_by``, the folders) it needs.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative fits a place for their checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
