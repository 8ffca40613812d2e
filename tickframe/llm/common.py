"""Reading tables, shared storage and text helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: White space that separates words: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a row group of stored tables: readers hold one at a time.
ROW_GROUP = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where the session names none and runs on this machine alone."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local($|\[|\*)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


_SCRATCH: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch():
    """Lists the tables that written() stores meanwhile; the caller drops those that its result does not read."""
    _SCRATCH.append([])
    try:
        yield _SCRATCH[-1]
    finally:
        _SCRATCH.pop()


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    writer = df.write.option("parquet.block.size", str(ROW_GROUP))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    for made in _SCRATCH:
        made.append(out)
    return out


def drop_written(df: DataFrame) -> None:
    """Delete what written() stored, once nothing reads it any more."""
    path = getattr(df, "_written_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of steps that nothing refers to any more, and give the driver's free memory back."""
    gc.collect()
    trim()
    spark._jvm.System.gc()


def trim() -> None:
    """Give a Python worker's free memory back: workers are kept between tasks, and executors pay for what they hold."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    libc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if libc_trim:
        libc_trim(0)


#: What goes to Python at a time: texts may be long, and chunks are.
BATCH_BYTES = "4m"


def settle(spark: SparkSession) -> None:
    """Settings that the operators rely on: small batches to Python, column chunks read without direct buffers of their size, and
    file splits that stay the same if executors come or go."""
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
