"""Shared-folder handling for the few operators that must cut lineage or stage a table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back on a temporary folder: on a cluster a machine-local path
    would lose its data with the executor that wrote it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="cardloom-")


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later steps all see the same rows and row numbers."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one staged table."""
    return f"{shared_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one staged table that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
