"""Table scans and the canonical ``transactions`` frame.

The inputs are a TPC-H-like star.  Every analytic runs on one canonical
transactions frame with the reference's column names:

    TransactionID, CustomerID, ProductID, ProductCategory, Quantity,
    UnitPrice, Revenue, TransactionDate, Country, PaymentMethod

Join order is chosen for scale: the order-side dimension (orders, customer,
nation) is assembled first at order grain, part is attached to lineitem by
part key, and the two meet on the order key.  No side is force-broadcast;
adaptive execution converts a join to a broadcast only when the runtime size
of a side is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import idiv

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

TX_COLUMNS = ["TransactionID", "CustomerID", "ProductID", "ProductCategory", "Quantity",
              "UnitPrice", "Revenue", "TransactionDate", "Country", "PaymentMethod"]

RAW_COLUMNS = [c for c in TX_COLUMNS if c != "Revenue"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one input table; a missing path raises AnalysisException."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_status(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """For each input whether it is there, and its rows (0 for a missing one).

    The guard looks the paths up; only those present are scanned.
    """
    from functools import reduce

    from pyspark.errors import AnalysisException
    parts = []
    for name in names:
        label = F.lit(name).alias("Input")
        try:
            parts.append(read_table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("Rows")).select(
                label, F.lit(True).alias("Present"), "Rows"))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            parts.append(spark.range(1).select(label, F.lit(False).alias("Present"), F.lit(0).cast("long").alias("Rows")))
    return reduce(DataFrame.unionByName, parts)


def _joined_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")

    order_dim = (orders
                 .join(cust, F.col("o_custkey") == F.col("c_custkey"))
                 .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "n_name"))
    lines = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(order_dim, F.col("l_orderkey") == F.col("o_orderkey"))


def adapter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: lines, and those that the adapter's inner joins drop, by the table that lacks them."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey")
    known = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .select("o_orderkey", F.col("n_nationkey").isNotNull().alias("complete")))
    part = read_table(spark, sf_dir, "part").select("p_partkey")
    lines = (li.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
             .join(known, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    return lines.agg(
        F.count(F.lit(1)).alias("LineRows"), F.count(F.when(F.col("o_orderkey").isNull(), 1)).alias("WithoutOrder"),
        F.count(F.when(F.col("o_orderkey").isNotNull() & ~F.col("complete"), 1)).alias("WithoutCustomer"),
        F.count(F.when(F.col("p_partkey").isNull(), 1)).alias("WithoutPart"))


def _mapped(joined: DataFrame) -> DataFrame:
    qty = F.col("l_quantity").cast("bigint")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    unit = F.when(qty != 0, idiv(cents, qty))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("TransactionID"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.col("l_partkey").cast("string").alias("ProductID"),
        F.col("p_type").alias("ProductCategory"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        (unit * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,2)").alias("UnitPrice"),
        # the line's own price to the cent, whatever the rounded unit price makes of it
        (cents * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(12,2)").alias("Revenue"),
        F.col("o_orderdate").alias("TransactionDate"),
        F.col("n_name").alias("Country"),
        F.col("o_orderpriority").alias("PaymentMethod"),
        # source keys, kept only for the corruption fixture predicates
        F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
    )


SOURCE_TABLES = ("lineitem", "orders", "customer", "nation", "part")


def build_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter join itself, sorted by time within each output file
    so that Parquet row-group statistics prune date filters.  The sort holds the
    joined rows, narrower than those with keys as texts."""
    return _mapped(_joined_sources(spark, sf_dir).sortWithinPartitions("o_orderdate"))


def transactions_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows plus the source keys, from the stage table."""
    from tillroll.sources.stages import stage_table
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES]
    return stage_table(spark, "transactions", inputs, lambda: build_transactions(spark, sf_dir))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical cleaned transactions (one row per order line).

    Reads the stage table written once per input version; a projection, so
    the source-key columns are pruned from the Parquet scan."""
    return transactions_with_keys(spark, sf_dir).select(*TX_COLUMNS)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second adapter: ``events`` purchases with microsecond timestamps."""
    ev = read_table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "purchase")
            .select(F.col("event_id").cast("string").alias("TransactionID"),
                    F.col("user_id").cast("string").alias("CustomerID"),
                    F.col("ts").alias("TransactionDate"),
                    F.col("value").cast("decimal(12,2)").alias("Revenue")))


# Corruption fixture (G1-G4).  Rows are picked by integer predicates on the
# source keys (never rand()), so any engine selects the same rows.  The four
# predicates are independent of each other.
DUP_PRED = "l_orderkey % 200 = 0"
NULL_CUSTOMER_PRED = "l_partkey % 333 = 0"
BAD_QUANTITY_PRED = "l_suppkey % 50 = 7"
BAD_PRICE_PRED = "l_partkey % 500 = 3"


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped transactions (no Revenue) with injected defects.

    G2 nulls CustomerID, G3 negates Quantity, G4 negates UnitPrice and G1
    appends a copy of a deterministic 0.5%-ish slice (union all).
    """
    base = transactions_with_keys(spark, sf_dir)
    corrupted = base.select(
        "TransactionID",
        F.when(F.expr(NULL_CUSTOMER_PRED), F.lit(None).cast("string"))
         .otherwise(F.col("CustomerID")).alias("CustomerID"),
        "ProductID", "ProductCategory",
        F.when(F.expr(BAD_QUANTITY_PRED), -F.col("Quantity"))
         .otherwise(F.col("Quantity")).alias("Quantity"),
        F.when(F.expr(BAD_PRICE_PRED), -F.col("UnitPrice"))
         .otherwise(F.col("UnitPrice")).alias("UnitPrice"),
        "TransactionDate", "Country", "PaymentMethod",
        # G1 as a generator instead of a self-union: one scan of the joined
        # sources emits each selected row twice (same rows as UNION ALL).
        F.explode(F.when(F.expr(DUP_PRED), F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return corrupted.select(*RAW_COLUMNS)


# Faults of the text fixture, again by predicates on keys: a number, a price
# and a date that can't be read.
BAD_NUMBER_PRED = "CAST(ProductID AS BIGINT) % 89 = 7"
BAD_PRICE_TEXT_PRED = "CAST(ProductID AS BIGINT) % 101 = 3"
BAD_DATE_PRED = "CAST(TransactionID AS BIGINT) % 97 = 5"


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty fixture as a raw export prints it: dates as text, prices
    with a third decimal, and some fields that can't be read."""
    text = lambda pred, bad, good: F.when(F.expr(pred), F.lit(bad)).otherwise(good)
    return dirty_transactions(spark, sf_dir).withColumns({
        "Quantity": text(BAD_NUMBER_PRED, "ten", F.col("Quantity").cast("string")),
        "UnitPrice": text(BAD_PRICE_TEXT_PRED, "free", (F.col("UnitPrice") + F.lit(0.001).cast("decimal(4,3)")).cast("string")),
        "TransactionDate": text(BAD_DATE_PRED, "soon", F.substring(F.col("TransactionDate").cast("string"), 1, 19))})


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage output of the feature step (typed timestamps, exact money):
    the input of segmentation, churn, campaigns and KPIs."""
    from tillroll.operators.features import customer_features
    from tillroll.sources.stages import stage_table
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES]
    return stage_table(spark, "customer_features", inputs,
                       lambda: customer_features(transactions(spark, sf_dir), as_text=False))


def segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage output of the segmentation step: every customer with the label
    of the fixed-centroid segments.  Readers scan this table instead of
    repeating the scaling, assignment and labelling plan."""
    from tillroll.operators.segments import fixed_segments
    from tillroll.sources.stages import stage_table
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES]
    return stage_table(spark, "segments", inputs, lambda: fixed_segments(customer_table(spark, sf_dir)))


def churn_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage output of the split step: labelled customers with their test flag."""
    from tillroll.operators.churn import label, with_split
    from tillroll.sources.stages import stage_table
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES]
    return stage_table(spark, "churn_split", inputs, lambda: with_split(label(customer_table(spark, sf_dir))))


def forecast_table_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage output of the forecast step (grid-fitted Holt-Winters history +
    30-day forecast of total daily revenue), read by the KPI step."""
    from tillroll.operators.forecast import holt_winters_forecast
    from tillroll.sources.stages import stage_table
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES]
    return stage_table(spark, "forecast_table", inputs,
                       lambda: holt_winters_forecast(transactions(spark, sf_dir))["table"])
