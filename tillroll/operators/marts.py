"""Dashboard marts (B1-B10, J5): the BI measures as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_year(tx: DataFrame) -> DataFrame:
    """B2: revenue and order volume by year and month."""
    return (tx.groupBy(F.year("TransactionDate").alias("Year"), F.month("TransactionDate").alias("Month"))
              .agg(F.sum("Revenue").alias("GrossRevenue"),
                   F.countDistinct("TransactionID").alias("OrderVolume")))


def fact_enriched(tx: DataFrame, segments: DataFrame, scored: DataFrame) -> DataFrame:
    """Fact rows with their customer's segment and risk band (the
    model relationships as left joins on CustomerID).

    The customer side is pre-joined once at customer grain, so the fact
    table takes part in a single join; adaptive execution broadcasts the
    customer side only when its runtime size is under the threshold.
    """
    cust = segments.select("CustomerID", "CustomerSegment").join(
        scored.select("CustomerID", "RiskCategory", "ChurnProbability"), "CustomerID", "full")
    return tx.join(cust, "CustomerID", "left")
