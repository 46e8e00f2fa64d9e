"""Shared helpers: table access, the shared scratch folder and packed rows."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of text that Arrow hands a Python worker at once; a batch lies in the JVM, in the worker and as
#: Python strings at the same time.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session sets its own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    A private folder is made only when the setting is empty and the master is
    local, where one machine runs everything; a cluster without the setting is
    an error, because executors could not read each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed when the driver exits."""
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through Hadoop's file system; does nothing once the session has ended."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses see
    the same rows, and a lost executor re-reads files instead of recomputing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(column: Column | str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (null for a null id)."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(col.cast("string").cast("binary")) % divisor


def hex16(column: Column) -> Column:
    """A 64-bit value as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
