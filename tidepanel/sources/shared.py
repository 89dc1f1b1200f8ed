"""Tables in the cluster's shared folder: they cut lineage, and fix rows that must not be made twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where all runs on one machine and it is unset, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tidepanel-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back; a lost executor costs only its own tasks."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that ``written`` made, once nothing reads it any more."""
    if path := getattr(df, "_written_to", None):
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
