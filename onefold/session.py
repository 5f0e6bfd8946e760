"""Session helpers: shared storage for checkpoints and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names in `spark.checkpoint.dir`.

    A local session without that setting uses a folder below its warehouse; on a cluster the setting
    is required.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return named or current.rsplit("/", 1)[0]
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/onefold-scratch"
    sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, for a table written and read back."""
    return f"{checkpoint_dir(spark)}/onefold-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared checkpoint folder and go on from there.

    The table survives the loss of executors, is computed exactly once, keeps its columns apart for
    pruning and has a known size, which lets Spark choose the joins that follow.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
