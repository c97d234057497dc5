"""Lineage cuts for iterative jobs, through storage every executor can read."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder named by the session.

    A folder is made only for a local master that names none; on a cluster a
    missing setting is an error, because a machine-local folder is lost with its
    machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="corpusloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
