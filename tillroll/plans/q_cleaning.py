"""Cleaning and validation queries over the dirty fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import cleaning
from tillroll.plans import sqlfrag as S
from tillroll.plans.registry import present, register
from tillroll.session import temporary_path
from tillroll.plans.q_segments import SEGMENTS_CTES
from tillroll.sources import csv_io, sinks
from tillroll.sources.buckets import write_bucketed
from tillroll.sources.tables import (SOURCE_TABLES, dirty_text, dirty_transactions, input_status, segment_table,
                                     transactions)

DIRTY = S.with_ctes(S.TX_CTE, S.DIRTY_CTE)

CLEAN_CTE = """cleaned AS (
  SELECT TransactionID, CustomerID, ProductID, ProductCategory, Quantity, UnitPrice,
         CAST(Quantity * UnitPrice AS DECIMAL(12,2)) AS Revenue,
         TransactionDate, Country, PaymentMethod
  FROM (SELECT DISTINCT * FROM dirty)
  WHERE CustomerID IS NOT NULL AND TransactionID IS NOT NULL
    AND Quantity > 0 AND UnitPrice > 0)"""

RAW_SELECT = f"""TransactionID, CustomerID, ProductID, ProductCategory,
       CAST(Quantity AS BIGINT) AS Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
       {S.ts_text('TransactionDate')} AS TransactionDate, Country, PaymentMethod"""


@register("transactions_totals", S.with_ctes(S.TX_CTE) + """
SELECT count(*) AS Rows, count(DISTINCT TransactionID) AS Orders,
       count(DISTINCT CustomerID) AS Customers, CAST(sum(Quantity) AS BIGINT) AS Units,
       CAST(sum(Revenue) AS DOUBLE) AS Revenue
FROM transactions""")
def q_transactions_totals(spark, sf_dir):
    """The adapter's row count and sums."""
    tx = transactions(spark, sf_dir)
    return present(tx.agg(F.count(F.lit(1)).alias("Rows"),
                          F.countDistinct("TransactionID").alias("Orders"),
                          F.countDistinct("CustomerID").alias("Customers"),
                          F.sum("Quantity").cast("bigint").alias("Units"),
                          F.sum("Revenue").alias("Revenue")))


@register("clean_transactions", DIRTY.replace("WITH ", "WITH ", 1).rstrip() + ",\n" + CLEAN_CTE + f"""
SELECT TransactionID, CustomerID, ProductID, ProductCategory, CAST(Quantity AS BIGINT) AS Quantity,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Revenue AS DOUBLE) AS Revenue,
       {S.ts_text('TransactionDate')} AS TransactionDate, Country, PaymentMethod
FROM cleaned""")
def q_clean_transactions(spark, sf_dir):
    """The full cleaning chain on the dirty fixture."""
    return present(cleaning.clean(dirty_transactions(spark, sf_dir)))


@register("cleaning_audit", DIRTY + """
, grouped AS (SELECT *, count(*) AS n FROM dirty GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS InitialRows,
       CAST(sum(n - 1) AS BIGINT) AS DuplicatesRemoved,
       count(*) FILTER (WHERE CustomerID IS NULL OR TransactionID IS NULL) AS MissingKeyRemoved,
       count(*) FILTER (WHERE CustomerID IS NOT NULL AND TransactionID IS NOT NULL
                        AND NOT coalesce(Quantity > 0 AND UnitPrice > 0, false)) AS InvalidRemoved,
       count(*) FILTER (WHERE CustomerID IS NOT NULL AND TransactionID IS NOT NULL
                        AND coalesce(Quantity > 0 AND UnitPrice > 0, false)) AS FinalRows
FROM grouped""")
def q_cleaning_audit(spark, sf_dir):
    """Rows removed by each cleaning step, in sequence."""
    return cleaning.audit(dirty_transactions(spark, sf_dir))


@register("duplicate_keys", DIRTY + f"""
SELECT TransactionID, CustomerID, {S.ts_text('TransactionDate')} AS TransactionDate,
       count(*) AS DupCount
FROM dirty GROUP BY TransactionID, CustomerID, TransactionDate HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    """Duplicate-key listing."""
    return present(cleaning.duplicate_keys(dirty_transactions(spark, sf_dir)))


@register("invalid_values", DIRTY + f"""
SELECT {RAW_SELECT} FROM dirty WHERE Quantity <= 0 OR UnitPrice <= 0""")
def q_invalid_values(spark, sf_dir):
    """Rows with a non-positive quantity or price."""
    return present(cleaning.invalid_values(dirty_transactions(spark, sf_dir)))


@register("missing_keys", DIRTY + f"""
SELECT {RAW_SELECT} FROM dirty WHERE CustomerID IS NULL OR CustomerID = ''""")
def q_missing_keys(spark, sf_dir):
    """C11: rows missing CustomerID (null or empty)."""
    return present(cleaning.missing_keys(dirty_transactions(spark, sf_dir)))


@register("reconciliation", DIRTY.rstrip() + ",\n" + CLEAN_CTE + """
SELECT count(DISTINCT TransactionID) AS TotalCleanTransactions,
       count(DISTINCT CustomerID) AS TotalUniqueCustomers,
       CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS TotalCalculatedRevenue,
       CAST(sum(Revenue) AS DOUBLE) AS TotalStoredRevenue
FROM cleaned""")
def q_reconciliation(spark, sf_dir):
    """Totals after cleaning, recomputed vs stored revenue."""
    return present(cleaning.reconciliation(cleaning.clean(dirty_transactions(spark, sf_dir))))


# ------------------------------------------------------------- raw text ingest
FAULTS = ("CASE WHEN CAST(ProductID AS BIGINT) % 89 = 7 THEN 'Quantity is not a int' "
          "WHEN CAST(ProductID AS BIGINT) % 101 = 3 THEN 'UnitPrice is not a double' "
          "WHEN CAST(TransactionID AS BIGINT) % 97 = 5 THEN 'TransactionDate is not a timestamp_ntz' END")
INGEST = DIRTY.rstrip() + f""",
arrived AS (SELECT *, {FAULTS} AS RejectReason FROM dirty),
accepted AS (SELECT * EXCLUDE (RejectReason) FROM arrived WHERE RejectReason IS NULL)"""


def _raw_csv(spark, sf_dir):
    """The text fixture after a trip through a CSV file."""
    path = temporary_path(spark)
    csv_io.write_csv(dirty_text(spark, sf_dir), path)
    return csv_io.read_raw_text(spark, path)


@register("csv_round_trip", INGEST + ",\n" + CLEAN_CTE.replace("FROM dirty)", "FROM accepted)") + f"""
SELECT TransactionID, CustomerID, ProductID, ProductCategory, CAST(Quantity AS BIGINT) AS Quantity,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Revenue AS DOUBLE) AS Revenue,
       {S.ts_text('TransactionDate')} AS TransactionDate, Country, PaymentMethod
FROM cleaned""")
def q_csv_round_trip(spark, sf_dir):
    """Raw text written as CSV, read, typed and cleaned."""
    return present(cleaning.clean(csv_io.accepted(_raw_csv(spark, sf_dir))))


@register("rejected_rows", INGEST + f"""
SELECT TransactionID, CustomerID, ProductID, ProductCategory, Country, PaymentMethod, RejectReason,
       CASE WHEN CAST(ProductID AS BIGINT) % 89 = 7 THEN 'ten' ELSE CAST(Quantity AS VARCHAR) END AS Quantity,
       CASE WHEN CAST(ProductID AS BIGINT) % 101 = 3 THEN 'free'
            ELSE CAST(CAST(UnitPrice AS DECIMAL(12,3)) + CAST(0.001 AS DECIMAL(4,3)) AS VARCHAR) END AS UnitPrice,
       CASE WHEN CAST(TransactionID AS BIGINT) % 97 = 5 THEN 'soon' ELSE {S.ts_text('TransactionDate')} END AS TransactionDate
FROM arrived WHERE RejectReason IS NOT NULL""")
def q_rejected_rows(spark, sf_dir):
    """C4: rows that can't be read, as they arrived, with the reason."""
    return csv_io.rejected(_raw_csv(spark, sf_dir)).drop(csv_io.RECORD)


_TXN = "CAST(TransactionID AS BIGINT)"
#: Faults of structure and range, by transaction: doubled quotes and a comma, a line break, a
#: surplus field, a field too few, a price and a revenue beyond their decimals.
QUOTED, BROKEN, SURPLUS, SHORT = f"{_TXN} % 71 = 3", f"{_TXN} % 73 = 5", f"{_TXN} % 79 = 7", f"{_TXN} % 83 = 11"
DEAR, VAST = f"{_TXN} % 103 = 13", f"{_TXN} % 107 = 17"


def _raw_lines(spark, sf_dir):
    """The text fixture as CSV text of another tool, with those faults: one file a partition, no header."""
    when = lambda test, value, other: F.when(F.expr(test), value).otherwise(other)
    price = when("UnitPrice = 'free'", F.col("UnitPrice"), when(DEAR, F.lit("1e12"), when(VAST, F.lit("99999999.99"), F.col("UnitPrice"))))
    quantity = when("Quantity = 'ten'", F.col("Quantity"), when(VAST, F.lit("2000000000"), F.col("Quantity")))
    fields = dirty_text(spark, sf_dir).withColumns({
        "UnitPrice": price, "Quantity": quantity,
        "Country": when(BROKEN, F.concat(F.lit('"'), "Country", F.lit('\n2nd line"')), F.col("Country")),
        "PaymentMethod": when(SHORT, F.lit(None), F.concat(
            when(QUOTED, F.lit('"say ""hi"", now"'), F.col("PaymentMethod")), when(SURPLUS, F.lit(",more"), F.lit(""))))})
    names = [n.split()[0] for n in csv_io.RAW_SCHEMA.split(", ")]
    empty = [F.coalesce(n, F.lit("")) if n != "PaymentMethod" else F.col(n) for n in names]
    path = temporary_path(spark)
    fields.select(F.concat_ws(",", *empty).alias("value")).write.text(path)  # a null last field writes no comma
    return csv_io.read_raw_text(spark, path, header=False)


@register("ingest_structure", DIRTY.rstrip() + f""",
arrived AS (
  SELECT *, CASE WHEN {SURPLUS} AND NOT {SHORT} OR {SHORT} THEN 'wrong number of fields'
                 WHEN CAST(ProductID AS BIGINT) % 89 = 7 THEN 'Quantity is not a int'
                 WHEN CAST(ProductID AS BIGINT) % 101 = 3 THEN 'UnitPrice is not a double'
                 WHEN {_TXN} % 97 = 5 THEN 'TransactionDate is not a timestamp_ntz'
                 WHEN {DEAR} THEN 'UnitPrice out of range' WHEN {VAST} THEN 'Revenue out of range' END AS RejectReason
  FROM dirty)
SELECT TransactionID, CustomerID, ProductID, RejectReason,
       Country || CASE WHEN {BROKEN} THEN chr(10) || '2nd line' ELSE '' END AS Country,
       CASE WHEN {SHORT} THEN NULL WHEN {QUOTED} THEN 'say "hi", now' ELSE PaymentMethod END AS PaymentMethod
FROM arrived""")
def q_ingest_structure(spark, sf_dir):
    """CSV as other tools write it; every row as read, the rejected ones with their reason."""
    raw = _raw_lines(spark, sf_dir)
    columns = ["TransactionID", "CustomerID", "ProductID", "Country", "PaymentMethod"]
    good = csv_io.accepted(raw).select(*columns, F.lit(None).cast("string").alias("RejectReason"))
    return good.unionByName(csv_io.rejected(raw).select(*columns, "RejectReason"))


@register("ingest_audit", INGEST + """
, grouped AS (SELECT *, count(*) AS n FROM accepted GROUP BY ALL)
SELECT (SELECT count(*) FROM arrived) AS RawRows,
       (SELECT count(*) FROM arrived WHERE RejectReason IS NOT NULL) AS RejectedRows,
       CAST(sum(n - 1) AS BIGINT) AS DuplicatesRemoved,
       count(*) FILTER (WHERE CustomerID IS NULL OR TransactionID IS NULL) AS MissingKeyRemoved,
       count(*) FILTER (WHERE CustomerID IS NOT NULL AND TransactionID IS NOT NULL
                        AND NOT coalesce(Quantity > 0 AND UnitPrice > 0, false)) AS InvalidRemoved,
       count(*) FILTER (WHERE CustomerID IS NOT NULL AND TransactionID IS NOT NULL
                        AND coalesce(Quantity > 0 AND UnitPrice > 0, false)) AS FinalRows
FROM grouped""")
def q_ingest_audit(spark, sf_dir):
    """C8 from the raw text on: rejected rows, then the rows each step removes."""
    raw = _raw_csv(spark, sf_dir)
    steps = cleaning.audit(csv_io.accepted(raw))
    rejects = csv_io.rejected(raw).agg(F.count(F.lit(1))).scalar()
    return steps.select((F.col("InitialRows") + rejects).alias("RawRows"), rejects.alias("RejectedRows"),
                        "DuplicatesRemoved", "MissingKeyRemoved", "InvalidRemoved", "FinalRows")


@register("adapter_audit", """
SELECT count(*) AS LineRows, count(*) FILTER (WHERE o.o_orderkey IS NULL) AS WithoutOrder,
       count(*) FILTER (WHERE o.o_orderkey IS NOT NULL AND (c.c_custkey IS NULL OR n.n_nationkey IS NULL)) AS WithoutCustomer,
       count(*) FILTER (WHERE p.p_partkey IS NULL) AS WithoutPart
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def q_adapter_audit(spark, sf_dir):
    """Order lines that the adapter's joins can't complete, by what is missing."""
    from tillroll.sources.tables import adapter_audit
    return adapter_audit(spark, sf_dir)


@register("table_round_trip", S.with_ctes(S.TX_CTE) + """
SELECT strftime(TransactionDate, '%Y-%m') AS TxMonth, count(*) AS Rows, CAST(sum(Revenue) AS DOUBLE) AS Revenue,
       CAST(0 AS BIGINT) AS OutOfOrder
FROM transactions GROUP BY 1""")
def q_table_round_trip(spark, sf_dir):
    """The month-partitioned fact table read back, with the rows that break a file's order."""
    path = temporary_path(spark)
    sinks.write_transactions(transactions(spark, sf_dir), path)
    return present(sinks.order_check(spark.read.parquet(path)))


@register("mart_round_trip", S.with_ctes(S.TX_CTE) + """
SELECT Country, count(*) AS Rows, CAST(sum(Revenue) AS DOUBLE) AS Revenue FROM transactions GROUP BY 1""")
def q_mart_round_trip(spark, sf_dir):
    """A mart exported for BI and read back from its CSV."""
    mart = transactions(spark, sf_dir).groupBy("Country").agg(F.count(F.lit(1)).alias("Rows"), F.sum("Revenue").alias("Revenue"))
    paths = sinks.export_marts({"by_country": mart}, temporary_path(spark))
    back = spark.read.schema("Country string, Rows bigint, Revenue decimal(22,2)").option("header", True).csv(paths["by_country"])
    return present(back)


@register("bucket_round_trip", S.with_ctes(*SEGMENTS_CTES) + """
SELECT t.CustomerID, s.CustomerSegment, count(*) AS Rows, CAST(sum(t.Revenue) AS DOUBLE) AS Revenue
FROM transactions t JOIN segments s ON t.CustomerID = s.CustomerID GROUP BY 1, 2""")
def q_bucket_round_trip(spark, sf_dir):
    """Facts and segments bucketed by customer, aggregated and joined without a shuffle."""
    facts = write_bucketed(transactions(spark, sf_dir).select("CustomerID", "Revenue"), "CustomerID")
    segments = write_bucketed(segment_table(spark, sf_dir).select("CustomerID", "CustomerSegment"), "CustomerID")
    spend = facts.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("Rows"), F.sum("Revenue").alias("Revenue"))
    return present(spend.join(segments.hint("merge"), "CustomerID"))


@register("input_guard", " UNION ALL ".join(
    f"SELECT '{t}' AS Input, true AS Present, count(*) AS Rows FROM {t}" for t in SOURCE_TABLES)
    + " UNION ALL SELECT 'returns', false, 0")
def q_input_guard(spark, sf_dir):
    """The expected inputs and one that isn't there: missing ones are named before any job starts."""
    return input_status(spark, sf_dir, [*SOURCE_TABLES, "returns"])
