"""KPI document, flat KPI table and executive report text (K1-K4).

The payload is one row: a global aggregate over the transactions with the
other sections attached as scalar subqueries (each a one-row aggregate, the
lists bounded by the number of segments / risk bands).  The report is built
from it with ``format_string`` / ``format_number`` and higher-order
functions over the two short lists; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import text
from tillroll.operators import churn as ch
from tillroll.operators import sales


def payload(tx: DataFrame, segments: DataFrame, scored: DataFrame, summary: DataFrame) -> DataFrame:
    """K1: nested KPI document (one row)."""
    ov = sales.overview(tx, aov_mode="half_even")
    top = sales.top_category(tx)
    seg = segments.groupBy("CustomerSegment").agg(
        F.count("CustomerID").alias("CustomerCount"),
        F.sum("Monetary").cast("double").alias("SegmentRevenue"),
        (F.sum("Recency").cast("double") / F.count("Recency")).alias("AvgRecency"))
    seg_list = seg.select(F.array_sort(F.collect_list(F.struct(*seg.columns))).alias("v"))
    risk = ch.risk_breakdown(scored).select(
        "RiskCategory", "CustomerCount", F.col("RevenueAtRisk").cast("double").alias("RevenueAtRisk"))
    risk_list = risk.select(F.array_sort(F.collect_list(F.struct(*risk.columns))).alias("v"))
    hi = ch.high_risk_rollup(scored)
    fin = F.struct(F.col("TotalRevenue").cast("double").alias("total_revenue"),
                   F.col("TotalOrders").alias("total_orders"),
                   F.col("TotalCustomers").alias("total_customers"),
                   F.col("AverageOrderValue").alias("average_order_value"))
    top_s = top.select(F.struct("name", "revenue", "share_of_total_pct")).scalar()
    hi_s = hi.select(F.struct(F.col("HighRiskCustomers").alias("c"),
                              F.col("HighRiskRevenue").cast("double").alias("r"))).scalar()
    fc_s = summary.select(F.struct(
        F.col("Last30DayActualRevenue").alias("last_30_day_actual_revenue"),
        F.col("Next30DayPredictedRevenue").alias("next_30_day_predicted_revenue"),
        F.col("ProjectedChangePct").alias("projected_revenue_change_pct"))).scalar()
    return ov.select(
        fin.alias("financial_overview"),
        top_s.alias("top_category"),
        seg_list.select("v").scalar().alias("customer_segmentation"),
        F.struct(hi_s["c"].alias("high_risk_customer_count"),
                 hi_s["r"].alias("high_risk_revenue_at_risk"),
                 risk_list.select("v").scalar().alias("breakdown")).alias("churn_risk_analysis"),
        fc_s.alias("sales_forecasting"))


def payload_json(p: DataFrame) -> DataFrame:
    """The payload as a JSON document column.  Money is written as
    2-place decimals (plain notation, as the document is read by people and
    BI tools), the share with 1 place; counts and mean recency unchanged."""
    def m(c):
        return c.cast("decimal(22,2)")

    fin, cat = F.col("financial_overview"), F.col("top_category")
    churn, fc = F.col("churn_risk_analysis"), F.col("sales_forecasting")
    doc = F.struct(
        F.struct(m(fin["total_revenue"]).alias("total_revenue"), fin["total_orders"].alias("total_orders"),
                 fin["total_customers"].alias("total_customers"),
                 m(fin["average_order_value"]).alias("average_order_value")).alias("financial_overview"),
        F.struct(cat["name"].alias("name"), m(cat["revenue"]).alias("revenue"),
                 cat["share_of_total_pct"].cast("decimal(6,1)").alias("share_of_total_pct")).alias("top_category"),
        F.transform("customer_segmentation", lambda x: F.struct(
            x["CustomerSegment"].alias("CustomerSegment"), x["CustomerCount"].alias("CustomerCount"),
            m(x["SegmentRevenue"]).alias("SegmentRevenue"), x["AvgRecency"].alias("AvgRecency")))
        .alias("customer_segmentation"),
        F.struct(churn["high_risk_customer_count"].alias("high_risk_customer_count"),
                 m(churn["high_risk_revenue_at_risk"]).alias("high_risk_revenue_at_risk"),
                 F.transform(churn["breakdown"], lambda r: F.struct(
                     r["RiskCategory"].alias("RiskCategory"), r["CustomerCount"].alias("CustomerCount"),
                     m(r["RevenueAtRisk"]).alias("RevenueAtRisk"))).alias("breakdown"))
        .alias("churn_risk_analysis"),
        F.struct(m(fc["last_30_day_actual_revenue"]).alias("last_30_day_actual_revenue"),
                 m(fc["next_30_day_predicted_revenue"]).alias("next_30_day_predicted_revenue"),
                 m(fc["projected_revenue_change_pct"]).alias("projected_revenue_change_pct"))
        .alias("sales_forecasting"))
    return p.select(F.to_json(doc).alias("json"))


def flat(p: DataFrame) -> DataFrame:
    """K2: one row per metric (Metric, Value, Text)."""
    def num(name, col):
        return F.struct(F.lit(name).alias("Metric"), col.cast("double").alias("Value"),
                        F.lit(None).cast("string").alias("Text"))

    scalars = F.array(
        num("financial_overview.total_revenue", F.col("financial_overview.total_revenue")),
        num("financial_overview.total_orders", F.col("financial_overview.total_orders")),
        num("financial_overview.total_customers", F.col("financial_overview.total_customers")),
        num("financial_overview.average_order_value", F.col("financial_overview.average_order_value")),
        F.struct(F.lit("top_category.name").alias("Metric"), F.lit(None).cast("double").alias("Value"),
                 F.col("top_category.name").alias("Text")),
        num("top_category.revenue", F.col("top_category.revenue")),
        num("top_category.share_of_total_pct", F.col("top_category.share_of_total_pct")),
        num("churn_risk_analysis.high_risk_customer_count",
            F.col("churn_risk_analysis.high_risk_customer_count")),
        num("churn_risk_analysis.high_risk_revenue_at_risk",
            F.col("churn_risk_analysis.high_risk_revenue_at_risk")),
        num("sales_forecasting.last_30_day_actual_revenue",
            F.col("sales_forecasting.last_30_day_actual_revenue")),
        num("sales_forecasting.next_30_day_predicted_revenue",
            F.col("sales_forecasting.next_30_day_predicted_revenue")),
        num("sales_forecasting.projected_revenue_change_pct",
            F.col("sales_forecasting.projected_revenue_change_pct")))
    seg_rows = F.flatten(F.transform("customer_segmentation", lambda s: F.array(
        *[num(None, s[c]).withField("Metric", F.concat(F.lit("customer_segmentation."),
                                                       s["CustomerSegment"], F.lit("." + c)))
          for c in ("CustomerCount", "SegmentRevenue", "AvgRecency")])))
    risk_rows = F.flatten(F.transform("churn_risk_analysis.breakdown", lambda r: F.array(
        *[num(None, r[c]).withField("Metric", F.concat(F.lit("churn_risk_analysis.breakdown."),
                                                       r["RiskCategory"], F.lit("." + c)))
          for c in ("CustomerCount", "RevenueAtRisk")])))
    return p.select(F.inline(F.concat(scalars, seg_rows, risk_rows)))


# The executive report template (text as published, with
# printf-style slots in place of the Python format fields).
REPORT_HEAD = """# Executive Summary & Commercial Strategy Report

> **Automated AI Business Intelligence System**  
> *Generated based on SQL KPIs, K-Means Clustering, RandomForest Churn ML, and Time-Series Sales Forecasts.*

---

## 1. Executive Performance Overview

* **Total Revenue:** $%s generated across %s completed transactions.
* **Customer Base:** %s unique active customers with an **Average Order Value (AOV)** of $%s.
* **Category Leader:** **%s** is the highest revenue-generating category, accounting for **$%s** (%s%% of total gross revenue).

---

## 2. Customer Segmentation & Value Analysis (K-Means RFM)

The customer base has been categorized into distinct behavioral clusters using standardized Recency, Frequency, and Monetary metrics:

"""
REPORT_SEGMENT_LINE = "* **%s:** %s customers | Total Revenue: $%s | Avg Recency: %s days\n"
REPORT_CHURN = """
---

## 3. Churn Risk & Revenue Exposure (RandomForest Classifier)

Our supervised machine learning model identified significant churn risk exposure requiring immediate intervention:

* **High-Risk Customers:** **%s customers** exhibit a >70%% probability of stopping future purchases.
* **Revenue at Risk:** **$%s** in gross lifetime value is at imminent risk of churn.
* **Risk Breakdown:**
"""
REPORT_RISK_LINE = "  - **%s:** %s customers ($%s total spend)\n"
REPORT_TAIL = """
---

## 4. 30-Day Revenue & Demand Forecast (Time-Series Analytics)

* **Previous 30-Day Actual Revenue:** $%s
* **Next 30-Day Projected Revenue:** $%s
* **Forecasted Growth Trajectory:** Projected **%s of %s%%** over the next 30 days. This indicates %s momentum for inventory and cash flow planning.

---

## 5. Strategic Action Plan & Executive Recommendations

1. **Immediate High-Risk VIP Retention Campaign:** Launch targeted win-back promotions for the %s high-risk customers, protecting up to $%s in revenue.
2. **Category Inventory Optimization:** Increase stock allocations for **%s** to prevent stockouts during projected demand surges.
3. **VIP Loyalty Tier Expansion:** Implement exclusive perks for High-Value VIP segments to increase order frequency and boost baseline AOV beyond $%s.
4. **Automated Triggered Marketing:** Deploy automated email triggers for customers entering the 45-60 day inactivity window before they transition to high-risk churn status.
"""


def _money(c):
    """``{:,.2f}``."""
    return text.grouped(c, 2)


def _count(c):
    """``{:,}`` for integers."""
    return text.grouped_int(c)


def _fixed(c, places):
    """``{:.Nf}``."""
    return text.fixed(c.cast("double"), places)


def _pyfloat(c):
    """``str(float)`` of a short decimal (e.g. 56.9 -> '56.9', 0 -> '0')."""
    return F.when(c == F.floor(c), F.format_string("%.1f", c.cast("double"))) \
        .otherwise(c.cast("string"))


def trend_words(pct):
    """K4: wording of the projected change."""
    up = pct >= 0
    return (F.when(up, "an increase").otherwise("a decline"),
            F.when(up, "positive").otherwise("concerning"))


def report(p: DataFrame) -> DataFrame:
    """K3: the executive report as one text value."""
    fin, cat = F.col("financial_overview"), F.col("top_category")
    churn, fc = F.col("churn_risk_analysis"), F.col("sales_forecasting")
    pct = fc["projected_revenue_change_pct"]
    direction, adjective = trend_words(pct)
    share = F.when(F.col("top_category.share_of_total_pct") == 0, F.lit("0")) \
        .otherwise(_pyfloat(cat["share_of_total_pct"]))
    head = F.format_string(REPORT_HEAD, _money(fin["total_revenue"]), _count(fin["total_orders"]),
                           _count(fin["total_customers"]), _fixed(fin["average_order_value"], 2),
                           cat["name"], _money(cat["revenue"]), share)
    segs = F.array_join(F.transform("customer_segmentation", lambda s: F.format_string(
        REPORT_SEGMENT_LINE, s["CustomerSegment"], _count(s["CustomerCount"]),
        _money(s["SegmentRevenue"]), _fixed(s["AvgRecency"], 1))), "")
    mid = F.format_string(REPORT_CHURN, _count(churn["high_risk_customer_count"]),
                          _money(churn["high_risk_revenue_at_risk"]))
    risks = F.array_join(F.transform(churn["breakdown"], lambda r: F.format_string(
        REPORT_RISK_LINE, r["RiskCategory"], _count(r["CustomerCount"]), _money(r["RevenueAtRisk"]))), "")
    tail = F.format_string(REPORT_TAIL, _money(fc["last_30_day_actual_revenue"]),
                           _money(fc["next_30_day_predicted_revenue"]), direction,
                           _fixed(F.abs(pct), 1), adjective,
                           churn["high_risk_customer_count"].cast("string"),
                           _money(churn["high_risk_revenue_at_risk"]), cat["name"],
                           _fixed(fin["average_order_value"], 2))
    return p.select(F.concat(head, segs, mid, risks, tail).alias("report"))
