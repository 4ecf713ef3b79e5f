"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextvars
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexivane.storage import shared_dir, shuffles_end_with_their_query

#: A row group is held whole by the task that reads it, so those that are written stay small.
ROW_GROUP = 16 << 20
#: A reading task holds the texts of so many rows at a time, and as much again while its buffer grows.
READ_ROWS = 256


def bounded_files(spark: SparkSession) -> None:
    """Parquet files are read into one buffer, few rows of it decoded at a time, and written in row groups of a bounded size, unless the session already says so. Vectored reads hold column chunks a second time, in direct buffers that stay with each reading thread; where those run out the thread ends, and its task waits until it fails."""
    for key, value in (("parquet.hadoop.vectored.io.enabled", "false"), ("parquet.block.size", str(ROW_GROUP))):
        if spark.conf.get(key, None) is None and spark.sparkContext.getConf().get(f"spark.hadoop.{key}") is None:
            spark.conf.set(key, value)
    rows = "spark.sql.parquet.columnarReaderBatchSize"
    if spark.sparkContext.getConf().get(rows) is None:
        spark.conf.set(rows, str(READ_ROWS))


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lexivane/{uuid.uuid4().hex}/{name}"


_made: contextvars.ContextVar[list | None] = contextvars.ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Tables that are materialized within it are deleted when it ends, but for those handed to the function that it gives; nothing that is read later may depend on the others."""
    made: list[str] = []
    token = _made.set(made)
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.work_path)
        return df

    try:
        yield keep
    finally:
        _made.reset(token)
        outer = _made.get()
        for path in made:
            if path not in kept:
                remove_path(spark, path.rsplit("/", 1)[0])
            elif outer is not None:
                outer.append(path)


def materialize(df: DataFrame, name: str = "step", partition_by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    bounded_files(spark)
    path = work_path(spark, name)
    with shuffles_end_with_their_query(spark):
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    if (made := _made.get()) is not None:
        made.append(path)
    return out


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a work folder, by Hadoop's file system, wherever it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bounded_batches(spark: SparkSession) -> None:
    """Batches for Python of a bounded number of rows and bytes, unless the session already says so; and files so."""
    bounded_files(spark)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))):
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)


def tidy() -> None:
    """Give memory that a task has freed back to the system: Python workers live on for other tasks."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def tidied(run):
    """A function of an iterator of batches that tidies when it has ended."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_files(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text):
    """Column: the words [^\\x20\\x09-\\x0D]+ of a text, none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def row_hash(docs: DataFrame):
    """A 64-bit hash of all columns of a row that have one."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not any(x in kind for x in ("map<", "variant", "void"))])
