"""The folder all executors share, for tables and checkpoints that must outlive any one of them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in single-process local mode without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set; a cluster needs a shared folder for written tables")
    return tempfile.mkdtemp(prefix="larder-")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/larder-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` fixed in the shared folder, whatever is recomputed later."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
