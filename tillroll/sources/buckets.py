"""Bucketed layout (S6): customer-keyed tables that join and aggregate without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillroll.session import temporary_path

BUCKETS = 16


def write_bucketed(df: DataFrame, key: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Store ``df`` in the session's catalog as a table bucketed and sorted by
    ``key``, and read it back.  Tables of equal ``buckets`` join on the key, and
    each aggregates by it, without an Exchange.

    Rows are dealt by the key first, so that a bucket is one file, not one from
    every task.  Files lie at ``path`` in shared storage; without a path they
    are temporary.  A key in a third of all rows makes one large bucket: choose
    the plain month layout for such a fact table.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path or temporary_path(spark)).saveAsTable(name))
    return spark.table(name)
