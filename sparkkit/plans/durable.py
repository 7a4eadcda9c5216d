"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="sparkkit-checkpoint-")
    return shared


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables next to the checkpoints."""
    return f"{_shared_folder(spark)}/sparkkit-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder and return the stored rows."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(_shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of `df` as a table written to the shared folder.

    Unlike a checkpoint the table knows nothing of the plan that made it: in loops with many joins the constraints that a
    checkpoint hands on multiply until planning takes longer than the work.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
