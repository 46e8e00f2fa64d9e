"""SparkSession construction and session-level settings."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Money and time logic is written to be
# independent of the session time zone, but UTC keeps printed values stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tillroll",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _one_machine(master: str) -> bool:
    """``local[...]`` runs everything in one JVM; ``local-cluster`` and all others don't."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is; a
    cluster without it is refused, because each executor would write to its
    own disk.  Only a one-machine session gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not _one_machine(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """Location for an intermediate table written to cut lineage.

    ``tillroll.stage.namespace`` separates runs that must not share stage
    outputs (the benchmark uses a fresh one so it pays for every stage)."""
    ns = spark.conf.get("tillroll.stage.namespace", "shared")
    return os.path.join(ensure_checkpoint_dir(spark), "tables", ns, name)


#: Temporary tables of this process that no DataFrame may read any more.
_TEMPORARY: list[str] = []


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` once as Parquet in the shared checkpoint
    folder and reading it back.

    Used where one intermediate feeds several branches that must agree on
    nondeterministic choices (e.g. sampled range boundaries), or that would
    otherwise re-run expensive joins.  The files survive executor loss and
    are removed by ``drop_temporary`` (at the latest when the driver exits).
    """
    path = temporary_path(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def temporary_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder that ``drop_temporary`` removes."""
    path = scratch_table_path(spark, f"tmp/{uuid.uuid4().hex}")
    if not _TEMPORARY:
        atexit.register(drop_temporary, spark)
    _TEMPORARY.append(path)
    return path


def drop_temporary(spark: SparkSession) -> None:
    """Remove the temporary tables written so far; call it when the results
    that read them have been taken."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    while _TEMPORARY:
        target = sc._jvm.org.apache.hadoop.fs.Path(_TEMPORARY.pop())
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
