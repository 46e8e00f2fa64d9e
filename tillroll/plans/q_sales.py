"""Sales queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import sales
from tillroll.operators.ranking import exact_quantiles
from tillroll.plans import sqlfrag as S
from tillroll.plans.registry import present, register
from tillroll.session import materialize
from tillroll.sources.tables import transactions

TX = S.with_ctes(S.TX_CTE)


def _avg_money(sum_expr: str, cnt_expr: str) -> str:
    return S.money(S.div_half_up(S.cents(sum_expr), cnt_expr))


@register("monthly_trend", TX + f"""
SELECT strftime(TransactionDate, '%Y-%m') AS YearMonth,
       count(DISTINCT TransactionID) AS TotalOrders,
       count(DISTINCT CustomerID) AS ActiveCustomers,
       CAST(sum(Quantity) AS BIGINT) AS TotalUnitsSold,
       CAST(sum(Revenue) AS DOUBLE) AS GrossRevenue,
       {_avg_money('sum(Revenue)', 'count(Revenue)')} AS AverageOrderValue
FROM transactions GROUP BY YearMonth""")
def q_monthly_trend(spark, sf_dir):
    return present(sales.monthly_trend(transactions(spark, sf_dir)).orderBy("YearMonth"))


@register("category_performance", TX + f"""
, agg AS (SELECT ProductCategory, count(DISTINCT TransactionID) AS TotalOrders,
                 CAST(sum(Quantity) AS BIGINT) AS TotalUnitsSold, sum(Revenue) AS GrossRevenue
          FROM transactions GROUP BY ProductCategory)
SELECT ProductCategory, TotalOrders, TotalUnitsSold, CAST(GrossRevenue AS DOUBLE) AS GrossRevenue,
       CAST({S.div_half_up(S.cents('GrossRevenue') + ' * 100 * 100', S.cents('(SELECT sum(Revenue) FROM transactions)'))} AS DOUBLE) / 100.0
         AS RevenueSharePct
FROM agg""")
def q_category_performance(spark, sf_dir):
    return present(sales.category_performance(transactions(spark, sf_dir)).orderBy(F.col("GrossRevenue").desc(), "ProductCategory"))


@register("country_payment", TX + """
SELECT Country, PaymentMethod, count(DISTINCT CustomerID) AS UniqueCustomers,
       count(DISTINCT TransactionID) AS TotalTransactions, CAST(sum(Revenue) AS DOUBLE) AS TotalRevenue
FROM transactions GROUP BY Country, PaymentMethod""")
def q_country_payment(spark, sf_dir):
    return present(sales.country_payment(transactions(spark, sf_dir)).orderBy(F.col("TotalRevenue").desc(), "Country", "PaymentMethod"))


@register("daily_sales_ma7", TX + f"""
, daily AS (SELECT CAST(TransactionDate AS DATE) AS SalesDate, sum(Revenue) AS DailyRevenue
            FROM transactions GROUP BY SalesDate),
ma AS (SELECT SalesDate, DailyRevenue,
              sum(DailyRevenue) OVER w AS s, count(DailyRevenue) OVER w AS n
       FROM daily WINDOW w AS (ORDER BY SalesDate ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT {S.date_text('SalesDate')} AS SalesDate, CAST(DailyRevenue AS DOUBLE) AS DailyRevenue,
       {_avg_money('s', 'n')} AS MovingAvg7DayRevenue
FROM ma ORDER BY ma.SalesDate DESC LIMIT 30""")
def q_daily_sales_ma7(spark, sf_dir):
    return present(sales.daily_sales_ma7(transactions(spark, sf_dir)))


DENSE_SQL = TX + """
, daily AS (SELECT CAST(TransactionDate AS DATE) AS Date, sum(Revenue) AS ActualRevenue,
                   count(DISTINCT TransactionID) AS OrderVolume, CAST(sum(Quantity) AS BIGINT) AS UnitsSold
            FROM transactions GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date FROM daily)
SELECT strftime(c.Date, '%Y-%m-%d') AS Date, CAST(coalesce(d.ActualRevenue, 0) AS DOUBLE) AS ActualRevenue,
       coalesce(d.OrderVolume, 0) AS OrderVolume, coalesce(d.UnitsSold, 0) AS UnitsSold
FROM cal c LEFT JOIN daily d ON c.Date = d.Date"""


@register("daily_dense", DENSE_SQL)
def q_daily_dense(spark, sf_dir):
    """A5/FC1: zero-filled daily series (the forecast input)."""
    return present(sales.dense_daily(transactions(spark, sf_dir)))


@register("top_customers", TX + f"""
SELECT CustomerID, Country, count(DISTINCT TransactionID) AS TotalOrders,
       CAST(sum(Revenue) AS DOUBLE) AS TotalMonetarySpend,
       {_avg_money('sum(Revenue)', 'count(Revenue)')} AS AvgOrderValue,
       {S.ts_text('max(TransactionDate)')} AS LastPurchaseDate
FROM transactions GROUP BY CustomerID, Country
ORDER BY sum(Revenue) DESC, CustomerID, Country LIMIT 10""")
def q_top_customers(spark, sf_dir):
    return present(sales.top_customers(transactions(spark, sf_dir)))


@register("overview_kpi", TX + f"""
SELECT CAST(sum(Revenue) AS DOUBLE) AS TotalRevenue, count(DISTINCT TransactionID) AS TotalOrders,
       count(DISTINCT CustomerID) AS TotalCustomers,
       {S.money(S.div_half_even(S.cents('sum(Revenue)'), 'count(Revenue)'))} AS AverageOrderValue
FROM transactions""")
def q_overview_kpi(spark, sf_dir):
    """KPI cards."""
    return present(sales.overview(transactions(spark, sf_dir)))


@register("revenue_by_country", TX + """
SELECT Country, CAST(sum(Revenue) AS DOUBLE) AS Revenue FROM transactions GROUP BY Country""")
def q_revenue_by_country(spark, sf_dir):
    """Geographic revenue."""
    return present(sales.revenue_by(transactions(spark, sf_dir), "Country"))


@register("revenue_by_category", TX + """
SELECT ProductCategory, CAST(sum(Revenue) AS DOUBLE) AS Revenue FROM transactions GROUP BY ProductCategory""")
def q_revenue_by_category(spark, sf_dir):
    """Category bar."""
    return present(sales.revenue_by(transactions(spark, sf_dir), "ProductCategory"))


@register("top_category", TX + f"""
, cat AS (SELECT ProductCategory, sum(Revenue) AS r FROM transactions GROUP BY 1),
best AS (SELECT ProductCategory AS name, r FROM cat ORDER BY r DESC, ProductCategory LIMIT 1),
tot AS (SELECT sum(r) AS t FROM cat)
SELECT coalesce((SELECT name FROM best), 'N/A') AS name,
       coalesce(CAST((SELECT r FROM best) AS DOUBLE), 0.0) AS revenue,
       CASE WHEN coalesce(tot.t, 0) > 0
            THEN CAST({S.div_half_even(S.cents('(SELECT r FROM best)') + ' * 100 * 10', S.cents('tot.t'))} AS DOUBLE) / 10.0
            ELSE 0.0 END AS share_of_total_pct
FROM tot""")
def q_top_category(spark, sf_dir):
    """Category leader with share of total."""
    return sales.top_category(transactions(spark, sf_dir))


@register("describe_transactions", TX + """
, s AS (SELECT 'Quantity' AS "column", CAST(Quantity AS DOUBLE) AS v, CAST(Quantity AS DECIMAL(30,2)) AS d FROM transactions
        UNION ALL SELECT 'UnitPrice', CAST(UnitPrice AS DOUBLE), CAST(UnitPrice AS DECIMAL(30,2)) FROM transactions
        UNION ALL SELECT 'Revenue', CAST(Revenue AS DOUBLE), CAST(Revenue AS DECIMAL(30,2)) FROM transactions)
SELECT "column", count(v) AS count, round(CAST(sum(d) AS DOUBLE) / count(v), 6) AS mean,
       round(stddev_samp(v), 6) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25,
       round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM s GROUP BY "column" """)
def q_describe_transactions(spark, sf_dir):
    """Summary statistics of the numeric columns."""
    return sales.describe(transactions(spark, sf_dir))


@register("transactions_head", TX + f"""
SELECT TransactionID, CustomerID, ProductID, ProductCategory, CAST(Quantity AS BIGINT) AS Quantity,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Revenue AS DOUBLE) AS Revenue,
       {S.ts_text('TransactionDate')} AS TransactionDate, Country, PaymentMethod
FROM transactions
ORDER BY transactions.TransactionDate, TransactionID, ProductID, Quantity, UnitPrice LIMIT 5""")
def q_transactions_head(spark, sf_dir):
    """Preview of the first rows in chronological order."""
    tx = transactions(spark, sf_dir)
    return present(tx.orderBy("TransactionDate", "TransactionID", "ProductID", "Quantity",
                              "UnitPrice").limit(5))


@register("sketched_counts", S.with_ctes(S.TX_CTE) + """
SELECT strftime(TransactionDate, '%Y-%m') AS Period, CAST(sum(Revenue) AS DOUBLE) AS Revenue,
       count(DISTINCT CustomerID) AS Customers, count(DISTINCT TransactionID) AS Orders, true AS WithinBound
FROM transactions GROUP BY 1
UNION ALL
SELECT strftime(TransactionDate, '%Y'), CAST(sum(Revenue) AS DOUBLE), count(DISTINCT CustomerID),
       count(DISTINCT TransactionID), true FROM transactions GROUP BY 1""")
def q_sketched_counts(spark, sf_dir):
    """Exact distinct counts per month and year, and whether the counts merged
    from the stored daily sketches lie within three standard errors of them."""
    tx = transactions(spark, sf_dir)
    mart = materialize(sales.daily_mart(tx))
    parts = []
    for n in (7, 4):
        estimate = sales.merged_counts(mart, F.substring(F.col("Date").cast("string"), 1, n))
        exact = tx.groupBy(F.substring(F.col("TransactionDate").cast("string"), 1, n).alias("Period")).agg(
            F.countDistinct("CustomerID").alias("ExactCustomers"), F.countDistinct("TransactionID").alias("ExactOrders"))
        near = [F.abs(F.col(c) - F.col(f"Exact{c}")) <= F.greatest(F.lit(1.0), sales.SKETCH_BOUND * F.col(f"Exact{c}"))
                for c in ("Customers", "Orders")]
        parts.append(estimate.join(exact, "Period").select(
            "Period", "Revenue", F.col("ExactCustomers").alias("Customers"), F.col("ExactOrders").alias("Orders"),
            (near[0] & near[1]).alias("WithinBound")))
    return present(parts[0].unionByName(parts[1]))


@register("sketched_quantiles", S.with_ctes(S.TX_CTE) + """
, v AS (SELECT TransactionDate, 'Quantity' AS "Column", CAST(Quantity AS DOUBLE) AS v FROM transactions
        UNION ALL SELECT TransactionDate, 'UnitPrice', CAST(UnitPrice AS DOUBLE) FROM transactions
        UNION ALL SELECT TransactionDate, 'Revenue', CAST(Revenue AS DOUBLE) FROM transactions),
p AS (SELECT strftime(TransactionDate, '%Y-%m') AS Period, "Column", v FROM v
      UNION ALL SELECT strftime(TransactionDate, '%Y'), "Column", v FROM v)
SELECT Period, "Column", count(v) AS n, round(quantile_cont(v, 0.25), 6) AS p25,
       round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, true AS WithinBound
FROM p GROUP BY Period, "Column" """)
def q_sketched_quantiles(spark, sf_dir):
    """Exact quartiles per month and year, and whether the quartiles merged
    from the stored daily sketches lie within the stated rank error of them."""
    tx = transactions(spark, sf_dir)
    mart = materialize(sales.daily_quantile_mart(tx))
    periods = [F.substring(F.col("Date").cast("string"), 1, n) for n in (7, 4)]
    estimates = sales.merged_quantiles(mart, periods[0]).unionByName(sales.merged_quantiles(mart, periods[1]))
    # facts are counted once, by month; years add their months' counts
    months = materialize(sales.value_counts(sales.numeric_values(tx).select(periods[0].alias("Period"), "Column", "v")))
    years = months.groupBy(F.substring("Period", 1, 4).alias("Period"), "Column", "v").agg(F.sum("c").alias("c"))
    counts = materialize(months.unionByName(years))
    checked = sales.quantiles_within_bound(counts, estimates)
    exact = exact_quantiles(counts.select(F.concat_ws("|", "Period", "Column").alias("column"), "v", "c"), count="c")
    exact = exact.select(F.split_part("column", F.lit("|"), F.lit(1)).alias("Period"),
                         F.split_part("column", F.lit("|"), F.lit(2)).alias("Column"),
                         *[F.round(f"q{i}", 6).alias(name) for i, name in enumerate(("p25", "p50", "p75"))])
    out = estimates.select("Period", "Column", "n").join(exact, ["Period", "Column"]).join(checked, ["Period", "Column"])
    return present(out)
