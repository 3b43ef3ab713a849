"""Where intermediate data may be written: a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; only a local session may make its own."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tallyframe-")
    context.setCheckpointDir(folder)
    return folder


def ready_for_checkpoints(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read from there.

    For datasets that several checks read and that are dear to make again: the
    result of a shuffle, or rows in a format without columns. The copy outlives
    lost executors, and every check reads only the columns it needs.
    """
    path = fresh_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
