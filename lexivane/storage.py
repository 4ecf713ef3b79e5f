"""Work tables of the engine, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a session of one process (as in tests) may leave it unset: it gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = getattr(shared_dir, "own", None) or "file://" + tempfile.mkdtemp(prefix="lexivane-")
        shared_dir.own = base
    return base.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/lexivane/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet and read again: its partitions and values are settled."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def remove(df: DataFrame) -> None:
    """Delete the files of a table that was `written` and isn't read any more."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df.work_path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_end_with_their_query(spark: SparkSession):
    """Within it, shuffle files go as soon as the action that made them has ended, so that disk use is that of the largest step, not of their sum."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)
