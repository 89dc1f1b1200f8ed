"""Reading inputs, and cutting lineage with tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MIN_SPLITS = "spark.sql.files.minPartitionNum"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where the setting is missing and all runs on one machine, as in tests, a
    folder of this machine is made and put into the setting. On a cluster a
    missing setting is an error: each executor would write to its own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for a while; keys use ``__`` for dots."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def repeatable_scans(spark: SparkSession):
    """While it holds, a scan is split alike each time, however many executors there are just then.

    Operators that read a table twice and match rows by their place use it;
    they also carry checksums, so a table that changed meanwhile is an error.
    """
    with settings(spark, **{MIN_SPLITS.replace(".", "__"): "32"}):
        yield


#: Tables of this process in shared folders, for ``clean``.
_made: set[str] = set()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks that it ran.
    Shuffle files behind the table go as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    with settings(spark, **{SHUFFLE_CLEANUP.replace(".", "__"): "true"}):
        df.write.option("compression", "zstd").parquet(path)
    _made.add(path)
    out = spark.read.schema(schema).parquet(path)
    out._shared_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
    _made.discard(path)


def drop(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more."""
    if path := getattr(df, "_shared_path", None):
        _delete(df.sparkSession, path)


def clean(spark: SparkSession) -> None:
    """Delete all tables that this process wrote into shared folders.

    Results of operators read such tables, so write them out before.
    """
    for path in list(_made):
        _delete(spark, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened where a table has them already (Spark doesn't tell upper from lower case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
