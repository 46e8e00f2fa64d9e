"""Table, document and text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_within: list[str] | None = None) -> None:
    """Overwrite a Parquet table."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_transactions(df: DataFrame, path: str) -> None:
    """The cleaned fact table laid out for pruning instead of
    secondary indexes: one folder per month (partition pruning on date),
    rows sorted by time then customer inside each file (row-group min/max
    statistics prune customer and time filters).

    Rows are first dealt by month, so that a month has as many files as its
    size needs (AQE splits large months and joins small ones), not one from
    every task.  The sort starts with the month: the writer needs that order
    and would otherwise sort again by month alone.
    """
    dated = df.withColumn("TxMonth", F.coalesce(F.substring(F.col("TransactionDate").cast("string"), 1, 7),
                                                F.lit("none")))
    write_table(dated.hint("rebalance", "TxMonth"), path, partition_by=["TxMonth"],
                sort_within=["TxMonth", "TransactionDate", "CustomerID"])


def order_check(stored: DataFrame) -> DataFrame:
    """Rows and revenue per month of the stored fact table, and how many rows
    come before one that should precede them in their file.

    A row carries its file's number, not the path: sorted rows are as wide as
    what they carry, though the path shrinks to nothing when they are shuffled."""
    path = F.col("_metadata.file_path").alias("_path")
    files = stored.select(path).distinct().withColumn("_file", F.monotonically_increasing_id())  # one row a file
    placed = (stored.select("TxMonth", "TransactionDate", "CustomerID", "Revenue", path, F.col("_metadata.row_index").alias("_row"))
              .join(F.broadcast(files), "_path").drop("_path"))
    here = F.struct("TransactionDate", "CustomerID")
    before = F.lag(here).over(Window.partitionBy("_file").orderBy("_row"))
    checked = placed.withColumn("_bad", F.coalesce(before > here, F.lit(False)).cast("bigint"))
    return checked.groupBy("TxMonth").agg(F.count(F.lit(1)).alias("Rows"), F.sum("Revenue").alias("Revenue"),
                                          F.sum("_bad").alias("OutOfOrder"))


def write_json_document(df: DataFrame, path: str) -> None:
    """A one-row document frame as JSON text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Documents that are JSON text already (one column), one line each."""
    df.write.mode("overwrite").text(path)


def write_texts(df: DataFrame, path: str, key: str, text: str) -> None:
    """One text output per key value (e.g. one campaign per segment slug)."""
    df.select(key, text).write.mode("overwrite").partitionBy(key).text(path)


def export_marts(marts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write every mart under one export root (header CSV per mart)."""
    paths = {}
    for name, df in marts.items():
        p = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).csv(p)
        paths[name] = p
    return paths
