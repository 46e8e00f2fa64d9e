"""Cleaning, validation and audit.

The cleaning chain is the reference's, in its order: exact de-dup, drop rows
missing either key, keep strictly positive quantity and price, standardise
types, derive revenue.  The audit computes every per-step count in one pass
over the distinct rows (with their multiplicities) instead of four counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_COLUMNS = ["CustomerID", "TransactionID"]
DUP_KEY = ["TransactionID", "CustomerID", "TransactionDate"]


def dedup(df: DataFrame) -> DataFrame:
    """Drop identical rows (nulls compare equal)."""
    return df.dropDuplicates()


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Drop rows whose CustomerID or TransactionID is null."""
    return df.dropna(subset=KEY_COLUMNS)


def _valid_values() -> F.Column:
    # null compares false, as in the reference's boolean mask
    return F.coalesce((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0), F.lit(False))


def positive_filter(df: DataFrame) -> DataFrame:
    """Keep Quantity > 0 and UnitPrice > 0."""
    return df.filter(_valid_values())


def standardise(df: DataFrame) -> DataFrame:
    """Typed timestamp, string id, int quantity, 2-dp price, revenue.

    Text timestamps are parsed; decimals are already exact, so rounding the
    price is ``bround`` on raw doubles only.  Revenue is exact decimal.  What
    does not fit its decimal becomes null (ingest rejects such rows first).
    """
    ts = F.col("TransactionDate")
    if dict(df.dtypes)["TransactionDate"] == "string":
        ts = F.to_timestamp_ntz(ts)
    price = F.col("UnitPrice")
    if dict(df.dtypes)["UnitPrice"] in ("double", "float"):
        price = F.bround(price, 2)
    price = price.try_cast("decimal(10,2)")
    qty = F.col("Quantity").cast("int")
    return (df.withColumn("TransactionDate", ts)
              .withColumn("CustomerID", F.col("CustomerID").cast("string"))
              .withColumn("Quantity", qty)
              .withColumn("UnitPrice", price)
              .withColumn("Revenue", (qty * price).try_cast("decimal(12,2)")))


def clean(raw: DataFrame) -> DataFrame:
    """C1-C6 in the reference's order.  C7 (chronological order) is applied
    at the sink with ``sortWithinPartitions``, not as a global sort."""
    return standardise(positive_filter(drop_null_keys(dedup(raw))))


def audit(raw: DataFrame) -> DataFrame:
    """Rows removed per step, in sequence, from one aggregate pass."""
    distinct = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_n"))
    keys_ok = F.col("CustomerID").isNotNull() & F.col("TransactionID").isNotNull()
    return distinct.agg(
        F.sum("_n").alias("InitialRows"),
        F.sum(F.col("_n") - 1).alias("DuplicatesRemoved"),
        F.count(F.when(~keys_ok, 1)).alias("MissingKeyRemoved"),
        F.count(F.when(keys_ok & ~_valid_values(), 1)).alias("InvalidRemoved"),
        F.count(F.when(keys_ok & _valid_values(), 1)).alias("FinalRows"),
    ).select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in
               ["InitialRows", "DuplicatesRemoved", "MissingKeyRemoved", "InvalidRemoved",
                "FinalRows"]])


def duplicate_keys(df: DataFrame) -> DataFrame:
    """(TransactionID, CustomerID, TransactionDate) groups seen more than once."""
    return (df.groupBy(*DUP_KEY).agg(F.count(F.lit(1)).alias("DupCount"))
              .filter(F.col("DupCount") > 1))


def invalid_values(df: DataFrame) -> DataFrame:
    """Rows failing the positive-value rule (null values are not listed,
    as in SQL ``Quantity <= 0 OR UnitPrice <= 0``)."""
    return df.filter((F.col("Quantity") <= 0) | (F.col("UnitPrice") <= 0))


def missing_keys(df: DataFrame) -> DataFrame:
    """C11: rows whose CustomerID is null or empty."""
    return df.filter(F.col("CustomerID").isNull() | (F.col("CustomerID") == ""))


def reconciliation(df: DataFrame) -> DataFrame:
    """Distinct orders/customers and recomputed vs stored revenue."""
    return df.agg(
        F.countDistinct("TransactionID").alias("TotalCleanTransactions"),
        F.countDistinct("CustomerID").alias("TotalUniqueCustomers"),
        F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("TotalCalculatedRevenue"),
        F.sum("Revenue").alias("TotalStoredRevenue"))


def inactivity_window(df: DataFrame, low: int = 45, high: int = 60) -> DataFrame:
    """C17: customers inside the pre-churn inactivity window (inclusive)."""
    return df.filter(F.col("Recency").between(low, high))


def segment_slice(df: DataFrame, segments: list[str]) -> DataFrame:
    """Restrict a mart to chosen segments."""
    return df.filter(F.col("CustomerSegment").isin(segments))


# The text tokens pandas' CSV reader treats as missing by default.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
               "nan", "null"]


def normalise_null_tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    """Map pandas-style null tokens in text columns to null."""
    out = df
    for c in columns:
        out = out.withColumn(c, F.when(F.col(c).isin(NULL_TOKENS), F.lit(None))
                             .otherwise(F.col(c)))
    return out
