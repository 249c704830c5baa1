"""Lineage cuts and written tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a temporary one in local mode, and an error on a cluster."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir")
    if not found and not context.master.partition("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return found.rstrip("/") if found else tempfile.mkdtemp(prefix="tracelake-")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written in the shared folder.

    Unlike a checkpoint, it is estimated by the size of its files: in a loop of joins, estimates of checkpoints multiply
    round by round until the driver does nothing but multiply them.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
