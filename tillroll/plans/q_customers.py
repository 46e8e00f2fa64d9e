"""Customer-level queries: feature vector and RFM."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import features
from tillroll.plans import sqlfrag as S
from tillroll.plans.registry import present, register
from tillroll.sources.tables import purchases, transactions

FEATURES_SQL = S.with_ctes(*S.features_ctes()) + f"""
SELECT CustomerID, {S.ts_text('last_ts')} AS LastPurchaseDate,
       {S.ts_text('first_ts')} AS FirstPurchaseDate, Frequency,
       CAST(Monetary AS DOUBLE) AS Monetary, TotalProducts, UniqueCategories, PrimaryCategory,
       PreferredPaymentMethod, Country, Recency, CAST(AvgOrderValue AS DOUBLE) AS AvgOrderValue,
       CustomerTenureDays,
       CASE WHEN Frequency > 1
            THEN CAST({S.div_half_even('(CustomerTenureDays - Recency) * 10', 'Frequency - 1')} AS DOUBLE) / 10.0
            ELSE CAST(CustomerTenureDays AS DOUBLE) END AS AvgDaysBetweenOrders
FROM features
"""


@register("customer_features", FEATURES_SQL)
def q_customer_features(spark, sf_dir):
    return present(features.customer_features(transactions(spark, sf_dir)))


def _rfm_sql_text(cte: str, table: str) -> str:
    return S.with_ctes(
        cte,
        f"snap AS (SELECT CAST(max(CAST(TransactionDate AS DATE)) + 1 AS TIMESTAMP) AS s FROM {table})",
    ) + f"""
SELECT t.CustomerID,
       {S.elapsed_days('max(t.TransactionDate)', '(SELECT s FROM snap)')} AS RecencyDays,
       count(DISTINCT t.TransactionID) AS FrequencyOrders,
       CAST(sum(t.Revenue) AS DOUBLE) AS MonetarySpend,
       {S.money(S.div_half_up(S.cents('sum(t.Revenue)'), 'count(DISTINCT t.TransactionID)'))} AS AvgOrderValue
FROM {table} t
GROUP BY t.CustomerID
"""


@register("rfm_sql", _rfm_sql_text(S.TX_CTE, "transactions"))
def q_rfm_sql(spark, sf_dir):
    return present(features.rfm_sql(transactions(spark, sf_dir)).orderBy(F.col("MonetarySpend").desc(), "CustomerID"))


@register("rfm_events", _rfm_sql_text(S.PURCHASES_CTE, "purchases"))
def q_rfm_events(spark, sf_dir):
    """A7 on the events adapter: microsecond timestamps exercise sub-day recency."""
    return present(features.rfm_sql(purchases(spark, sf_dir)))
