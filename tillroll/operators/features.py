"""Per-customer feature vector.

Two aggregates of fixed-width state precede the one by customer: orders
(distinct orders, extremes and money) and counts of each customer's values,
from which the modes (lowest value on ties) and distinct categories follow.
Neither repeats the facts for a distinct count nor holds a map a customer, so
nothing falls back to sorting them, and a customer with a huge share of rows is
spread over its orders and arrives as a few rows a task.
The global snapshot date is a scalar subquery over the same aggregate, so
no join is needed to attach it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates
from tillroll.functions.money import div_round, to_cents

FEATURE_COLUMNS = ["CustomerID", "LastPurchaseDate", "FirstPurchaseDate", "Frequency",
                   "Monetary", "TotalProducts", "UniqueCategories", "PrimaryCategory",
                   "PreferredPaymentMethod", "Country", "Recency", "AvgOrderValue",
                   "CustomerTenureDays", "AvgDaysBetweenOrders"]


#: Columns whose most frequent value describes a customer, and the feature that holds it.
MODES = {"ProductCategory": "PrimaryCategory", "PaymentMethod": "PreferredPaymentMethod", "Country": "Country"}


def customer_aggregates(tx: DataFrame) -> DataFrame:
    """Raw per-customer aggregates (timestamps kept as timestamps)."""
    orders = tx.groupBy("CustomerID", "TransactionID").agg(
        F.max("TransactionDate").alias("last"), F.min("TransactionDate").alias("first"),
        F.sum("Revenue").alias("revenue"), F.sum("Quantity").cast("bigint").alias("units"))
    values = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("value")) for i, c in enumerate(MODES)])
    counts = (tx.select("CustomerID", F.inline(values)).where("value IS NOT NULL")
              .groupBy("CustomerID", "kind", "value").agg(F.count(F.lit(1)).alias("n")))

    def mode(i):
        return F.min(F.when(F.col("kind") == i, F.struct((-F.col("n")).alias("n"), "value")))["value"]

    return orders.unionByName(counts, allowMissingColumns=True).groupBy("CustomerID").agg(
        F.max("last").alias("LastPurchaseDate"),
        F.min("first").alias("FirstPurchaseDate"),
        F.count("TransactionID").alias("Frequency"),
        F.sum("revenue").cast(orders.schema["revenue"].dataType).alias("Monetary"),
        F.sum("units").alias("TotalProducts"),
        F.count(F.when(F.col("kind") == list(MODES).index("ProductCategory"), 1)).alias("UniqueCategories"),
        *[mode(i).alias(name) for i, name in enumerate(MODES.values())],
    )


def customer_features(tx: DataFrame, as_text: bool = True) -> DataFrame:
    """The pipeline's customer feature table.

    Recency/tenure use the pipeline snapshot ``max(ts) + 1 day`` (time of day
    kept) and count whole elapsed days.  AvgOrderValue is Monetary/Frequency
    rounded half-even before Monetary itself is rounded (a no-op on exact
    decimal money).  AvgDaysBetweenOrders is rounded half-even to 1 place.
    """
    agg = customer_aggregates(tx)
    snapshot = dates.plus_one_day(tx.select(F.max("TransactionDate")).scalar())  # one column, no shuffle by customer
    recency = dates.elapsed_days("LastPurchaseDate", snapshot)
    tenure = dates.elapsed_days("FirstPurchaseDate", snapshot)
    out = (agg
           .withColumn("Recency", recency)
           .withColumn("CustomerTenureDays", tenure)
           .withColumn("AvgOrderValue",
                       (div_round(to_cents("Monetary"), "Frequency", "half_even")
                        .cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)"))
                       .cast("decimal(20,2)"))
           .withColumn("AvgDaysBetweenOrders",
                       F.when(F.col("Frequency") > 1,
                              div_round((F.col("CustomerTenureDays") - F.col("Recency")) * 10,
                                        F.col("Frequency") - 1, "half_even").cast("double") / 10.0)
                       .otherwise(F.col("CustomerTenureDays").cast("double"))))
    if as_text:
        out = (out.withColumn("LastPurchaseDate", dates.ts_text("LastPurchaseDate"))
                  .withColumn("FirstPurchaseDate", dates.ts_text("FirstPurchaseDate")))
    return out.select(*FEATURE_COLUMNS)


def rfm_sql(tx: DataFrame) -> DataFrame:
    """The SQL form of RFM.

    RecencyDays counts whole days from the midnight after the last purchase
    day (so a same-day evening buyer gets 0); AvgOrderValue is
    SUM/COUNT(DISTINCT) rounded half-up.
    """
    agg = tx.groupBy("CustomerID").agg(
        F.max("TransactionDate").alias("_last"),
        F.countDistinct("TransactionID").alias("FrequencyOrders"),
        F.sum("Revenue").alias("MonetarySpend"))
    snap = agg.select(F.max(dates.next_midnight("_last"))).scalar()
    return agg.select(
        "CustomerID",
        dates.elapsed_days("_last", snap).alias("RecencyDays"),
        "FrequencyOrders",
        "MonetarySpend",
        div_round(to_cents("MonetarySpend"), "FrequencyOrders", "half_up").alias("_aov_cents"),
    ).withColumn("AvgOrderValue", F.col("_aov_cents").cast("double") / 100.0).drop("_aov_cents")
