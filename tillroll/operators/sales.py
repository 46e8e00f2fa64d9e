"""Sales analytics.

Money is summed in decimal and rounded with exact integer arithmetic.
Windows only ever run over an already-reduced frame (one row per day or per
group), never over fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import dates
from tillroll.functions.money import cents_to_double, div_round, round_ratio, to_cents


def _avg_money(sum_col: str, cnt_col: str, mode: str = "half_up") -> F.Column:
    return cents_to_double(div_round(to_cents(sum_col), cnt_col, mode))


def distinct_count(col: str, approx: bool = False, rsd: float = 0.01) -> F.Column:
    """Exact COUNT(DISTINCT); ``approx`` switches to a HyperLogLog++
    sketch (fixed-size partial state, no distinct-value shuffle) for very
    large marts."""
    return F.approx_count_distinct(col, rsd) if approx else F.countDistinct(col)


def monthly_trend(tx: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """A1: orders, active customers, units, revenue and AVG(Revenue) by month."""
    return (tx.groupBy(dates.month_key("TransactionDate").alias("YearMonth"))
              .agg(distinct_count("TransactionID", approx_distinct).alias("TotalOrders"),
                   distinct_count("CustomerID", approx_distinct).alias("ActiveCustomers"),
                   F.sum("Quantity").cast("bigint").alias("TotalUnitsSold"),
                   F.sum("Revenue").alias("_rev"),
                   F.count("Revenue").alias("_n"))
              .select("YearMonth", "TotalOrders", "ActiveCustomers", "TotalUnitsSold",
                      F.col("_rev").alias("GrossRevenue"),
                      _avg_money("_rev", "_n").alias("AverageOrderValue")))


def category_performance(tx: DataFrame) -> DataFrame:
    """A2: per category orders, units, revenue and share of total revenue (%).

    The grand total is a window over the aggregate, one row per category.
    """
    agg = (tx.groupBy("ProductCategory")
             .agg(F.countDistinct("TransactionID").alias("TotalOrders"),
                  F.sum("Quantity").cast("bigint").alias("TotalUnitsSold"),
                  F.sum("Revenue").alias("GrossRevenue")))
    total = F.sum("GrossRevenue").over(Window.partitionBy(F.lit(0)))
    share = F.when(to_cents(total) > 0,
                   round_ratio(to_cents("GrossRevenue") * 100, to_cents(total), 2))
    return agg.withColumn("RevenueSharePct", share)


def country_payment(tx: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """A3: unique customers, transactions and revenue by (Country, PaymentMethod)."""
    return (tx.groupBy("Country", "PaymentMethod")
              .agg(distinct_count("CustomerID", approx_distinct).alias("UniqueCustomers"),
                   distinct_count("TransactionID", approx_distinct).alias("TotalTransactions"),
                   F.sum("Revenue").alias("TotalRevenue")))


def daily_sales(tx: DataFrame) -> DataFrame:
    """A4: revenue by calendar day; days without sales are absent."""
    return (tx.groupBy(dates.day("TransactionDate").alias("SalesDate"))
              .agg(F.sum("Revenue").alias("DailyRevenue")))


def daily_sales_ma7(tx: DataFrame, last_n: int = 30) -> DataFrame:
    """A4 + W1 + L4: trailing 7-row moving average over all existing days,
    then the latest ``last_n`` days, newest first.

    The window has no partition key, so it runs in one task; its input is the
    daily aggregate (one row per calendar day), which is bounded by the date
    range rather than by data volume.
    """
    w = Window.orderBy("SalesDate").rowsBetween(-6, 0)
    d = daily_sales(tx)
    ma = (d.withColumn("_s", F.sum("DailyRevenue").over(w))
           .withColumn("_n", F.count("DailyRevenue").over(w))
           .withColumn("MovingAvg7DayRevenue", _avg_money("_s", "_n"))
           .drop("_s", "_n"))
    return ma.orderBy(F.col("SalesDate").desc()).limit(last_n)


def dense_daily(tx: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per series, every day from its first to its last sale, gaps = 0.

    Revenue, distinct orders and units by (keys, day); the calendar is
    generated per series with ``sequence`` + ``explode`` and left-joined.
    """
    keys = list(keys or [])
    day = dates.day("TransactionDate").alias("Date")
    daily = (tx.groupBy(*keys, day)
               .agg(F.sum("Revenue").alias("ActualRevenue"),
                    F.countDistinct("TransactionID").alias("OrderVolume"),
                    F.sum("Quantity").cast("bigint").alias("UnitsSold")))
    span = daily.groupBy(*keys).agg(F.min("Date").alias("_lo"), F.max("Date").alias("_hi"))
    calendar = span.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("Date"))
    return (calendar.join(daily, on=keys + ["Date"], how="left")
                    .select(*keys, "Date",
                            F.coalesce("ActualRevenue", F.lit(0).cast("decimal(22,2)"))
                             .alias("ActualRevenue"),
                            F.coalesce("OrderVolume", F.lit(0).cast("bigint")).alias("OrderVolume"),
                            F.coalesce("UnitsSold", F.lit(0).cast("bigint")).alias("UnitsSold")))


def customer_spend(tx: DataFrame) -> DataFrame:
    """Per (CustomerID, Country) orders, spend, AVG(Revenue), last purchase."""
    return (tx.groupBy("CustomerID", "Country")
              .agg(F.countDistinct("TransactionID").alias("TotalOrders"),
                   F.sum("Revenue").alias("TotalMonetarySpend"),
                   F.count("Revenue").alias("_n"),
                   F.max("TransactionDate").alias("LastPurchaseDate"))
              .withColumn("AvgOrderValue", _avg_money("TotalMonetarySpend", "_n"))
              .drop("_n"))


def top_customers(tx: DataFrame, k: int = 10) -> DataFrame:
    """L1: top-k customers by spend; CustomerID breaks ties."""
    return (customer_spend(tx)
            .orderBy(F.col("TotalMonetarySpend").desc(), F.col("CustomerID"), F.col("Country"))
            .limit(k))


def overview(tx: DataFrame, aov_mode: str = "half_even") -> DataFrame:
    """Revenue, distinct orders, distinct customers, mean row revenue.

    Each distinct count reads the distinct values of its own column: counted
    together they would repeat every fact row once a count before the shuffle."""
    agg = tx.agg(F.sum("Revenue").alias("TotalRevenue"), F.count("Revenue").alias("_n"))
    counts = {name: tx.select(c).distinct().agg(F.count(c)).scalar()
              for name, c in (("TotalOrders", "TransactionID"), ("TotalCustomers", "CustomerID"))}
    return agg.select("TotalRevenue", *[c.alias(name) for name, c in counts.items()],
                      F.when(F.col("_n") > 0, _avg_money("TotalRevenue", "_n", aov_mode)).alias("AverageOrderValue"))


def category_revenue(tx: DataFrame) -> DataFrame:
    """Revenue and units by category (KPI input)."""
    return (tx.groupBy("ProductCategory")
              .agg(F.sum("Revenue").alias("CategoryRevenue"),
                   F.sum("Quantity").cast("bigint").alias("UnitsSold")))


def top_category(tx: DataFrame) -> DataFrame:
    """The leading category with its revenue and share of total (1 dp);
    "N/A" and 0 when there are no rows.  A global aggregate always returns
    exactly one row, so no default-row join is needed."""
    cat = category_revenue(tx)
    best = cat.agg(
        F.min_by("ProductCategory", F.struct((-F.col("CategoryRevenue")).alias("r"),
                                             F.col("ProductCategory").alias("c"))).alias("name"),
        F.max("CategoryRevenue").alias("revenue"),
        F.sum("CategoryRevenue").alias("_total"))
    share = F.when(F.coalesce(to_cents("_total"), F.lit(0)) > 0,
                   round_ratio(to_cents("revenue") * 100, to_cents("_total"), 1, "half_even")) \
        .otherwise(F.lit(0.0))
    return best.select(F.coalesce("name", F.lit("N/A")).alias("name"),
                       F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
                       share.alias("share_of_total_pct"))


def revenue_by(tx: DataFrame, key: str) -> DataFrame:
    """Revenue by one dimension."""
    return tx.groupBy(key).agg(F.sum("Revenue").alias("Revenue"))


def describe(tx: DataFrame, columns=("Quantity", "UnitPrice", "Revenue"),
             exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max per column.

    One aggregate pass computes the moments and extremes of every column;
    the quartiles come from ``ranking.exact_quantiles`` (distributed: value
    counts, running counts, rank lookup), attached as scalar subqueries, and
    ``inline`` turns the result into one row per column.  ``exact=False``
    uses ``percentile_approx`` instead.  Mean, std and quartiles are rounded
    to 6 places (the precision ``describe`` prints), which also absorbs the
    order dependence of floating-point accumulation.
    """
    from tillroll.operators.ranking import exact_quantiles

    def r6(x):
        return F.round(x, 6)

    moments = []
    for c in columns:
        v = F.col(c).cast("double")
        total = F.sum(F.col(c).cast("decimal(30,2)"))
        fields = [F.lit(c).alias("column"), F.count(c).alias("count"),
                  r6(total.cast("double") / F.count(c)).alias("mean"),
                  r6(F.stddev_samp(v)).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")]
        if not exact:
            q = F.percentile_approx(v, F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)]), 100000)
            fields += [q[j].cast("double").alias(f"q{j}") for j in range(3)]
        moments.append(F.struct(*fields))
    stats = tx.agg(F.array(*moments).alias("_m")).select(F.inline("_m"))
    if exact:
        long = tx.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                                     F.col(c).cast("double").alias("v"))
                                           for c in columns])))
        # one row per column: a bounded broadcast
        stats = stats.join(F.broadcast(exact_quantiles(long)), "column")
    return stats.select("column", "count", "mean", "std", "min",
                        *[r6(F.col(f"q{j}")).alias(f"p{25 * (j + 1)}") for j in range(3)], "max")


#: Size of the distinct-count sketches (2^12 registers) and three standard errors of their estimate.
SKETCH_LG_K = 12
SKETCH_BOUND = 3 * 1.04 / 2 ** (SKETCH_LG_K / 2)


def daily_mart(tx: DataFrame) -> DataFrame:
    """Revenue per day with sketches of its customers and orders, which add up
    to any range of days where distinct counts don't."""
    return tx.groupBy(dates.day("TransactionDate").alias("Date")).agg(
        F.sum("Revenue").alias("Revenue"), F.hll_sketch_agg("CustomerID", SKETCH_LG_K).alias("Customers"),
        F.hll_sketch_agg("TransactionID", SKETCH_LG_K).alias("Orders"))


def merged_counts(mart: DataFrame, period: F.Column) -> DataFrame:
    """Revenue and estimated distinct customers and orders per period, from the
    stored days alone: the facts are not read again."""
    merged = mart.groupBy(period.alias("Period")).agg(
        F.sum("Revenue").alias("Revenue"), F.hll_union_agg("Customers").alias("_c"), F.hll_union_agg("Orders").alias("_o"))
    return merged.select("Period", "Revenue", F.hll_sketch_estimate("_c").alias("Customers"),
                         F.hll_sketch_estimate("_o").alias("Orders"))


#: Size of the quantile sketches, and twice the rank error that holds for 99 % of their answers (2.296 / k^0.9021).
QUANTILE_K = 400
QUANTILE_BOUND = 2 * 2.296 / QUANTILE_K ** 0.9021


def numeric_values(tx: DataFrame, columns=("Quantity", "UnitPrice", "Revenue")) -> DataFrame:
    """(Date, Column, v): one row per transaction and numeric column, nulls left out."""
    values = F.array(*[F.struct(F.lit(c).alias("Column"), F.col(c).cast("double").alias("v")) for c in columns])
    return tx.select(dates.day("TransactionDate").alias("Date"), F.inline(values)).where("v IS NOT NULL")


def daily_quantile_mart(tx: DataFrame, columns=("Quantity", "UnitPrice", "Revenue")) -> DataFrame:
    """A quantile sketch per day and numeric column.  Quantiles of days
    don't add up, sketches do; partial sketches are built before the shuffle,
    so a day with a third of all rows arrives as one sketch a task."""
    return numeric_values(tx, columns).groupBy("Date", "Column").agg(
        F.kll_sketch_agg_double("v", QUANTILE_K).alias("Sketch"))


def merged_quantiles(mart: DataFrame, period: F.Column, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(Period, Column, n, e0, e1, ...) from the stored days alone: count
    and estimated quantiles, each a value that occurs, whose rank is off by at
    most QUANTILE_BOUND of the rows.  Filter the mart for any range of days."""
    merged = mart.groupBy(period.alias("Period"), "Column").agg(F.kll_merge_agg_double("Sketch", QUANTILE_K).alias("_s"))
    return merged.select("Period", "Column", F.kll_sketch_get_n_double("_s").alias("n"),
                         *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(f"e{i}") for i, p in enumerate(probs)])


def value_counts(values: DataFrame) -> DataFrame:
    """(Period, Column, v, c): how often each value of ``values`` (Period, Column, v) occurs."""
    return values.groupBy("Period", "Column", "v").agg(F.count(F.lit(1)).alias("c"))


def quantiles_within_bound(counts: DataFrame, estimates: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(Period, Column, WithinBound): whether every estimate's true rank among
    the ``value_counts`` lies within QUANTILE_BOUND of the rank asked for.
    Values without counts (no column ``c``) are counted before they meet the estimates."""
    if "c" not in counts.columns:
        counts = value_counts(counts)
    met = counts.join(estimates.drop("n"), ["Period", "Column"])
    below = [F.sum(F.when(F.col("v") < F.col(f"e{i}"), F.col("c")).otherwise(0)).alias(f"b{i}") for i in range(len(probs))]
    upto = [F.sum(F.when(F.col("v") <= F.col(f"e{i}"), F.col("c")).otherwise(0)).alias(f"u{i}") for i in range(len(probs))]
    ranks = met.groupBy("Period", "Column").agg(F.sum("c").alias("n"), *below, *upto)
    near = F.lit(True)
    for i, p in enumerate(probs):
        near &= ((F.col(f"b{i}") <= (p + QUANTILE_BOUND) * F.col("n")) & (F.col(f"u{i}") >= (p - QUANTILE_BOUND) * F.col("n")))
    return ranks.select("Period", "Column", near.alias("WithinBound"))
