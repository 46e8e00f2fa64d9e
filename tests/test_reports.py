"""Campaign and report text on hand-written inputs."""

from pyspark.sql import Row

from tillroll.operators import campaigns, kpi

# Expected output texts and sample KPI values that must match.
VIP_TEXT = """### Campaign Strategy: High-Value VIPs

* **Target Audience:** Customers categorized as 'High-Value VIPs' with Low Risk churn risk.
* **Email Subject Line:** Exclusive VIP Perk: Preview our latest Electronics collection

* **Email Body:**  
  Dear Customer,

  As one of our premier VIP customers (with average orders around $850.00), we want to personally thank you for your loyalty. We've reserved early access for our newest arrivals in Electronics.

  Don't miss out on exploring our curated selections designed to bring you the best value.

  Warm regards,  
  The E-Commerce Customer Care Team

* **Incentive / Promo Code:** 20% Exclusive Rewards Voucher + Priority Customer Support
* **Call to Action (CTA):** [Access VIP Perks Now]
"""


def test_campaign_text(spark):
    inp = spark.createDataFrame([("High-Value VIPs", "Electronics", 850.0, "Low Risk"),
                                 ("At-Risk / Inactive", "Electronics", 320.0, "High Risk"),
                                 ("Occasional Buyers", "Toys", 10.0, "Low Risk")],
                                "CustomerSegment string, FavoriteCategory string, AvgSpend double, ChurnRisk string")
    out = {r.Slug: r for r in campaigns.copy(inp).collect()}
    assert out["high_value_vips"].Text == VIP_TEXT
    assert out["at_risk__inactive"].Subject == "We miss you! Here is $25 off your next Electronics purchase"
    assert "enjoy 15% off your next purchase" in out["occasional_buyers"].Body


def _payload(spark):
    seg = [Row(CustomerSegment="At-Risk / Inactive", CustomerCount=570, SegmentRevenue=8578627.320000008,
               AvgRecency=18.659649122807018),
           Row(CustomerSegment="Occasional Buyers", CustomerCount=215, SegmentRevenue=3875589.989999998,
               AvgRecency=371.9674418604651)]
    risk = [Row(RiskCategory="High Risk", CustomerCount=216, RevenueAtRisk=3917393.0399999977),
            Row(RiskCategory="Medium Risk", CustomerCount=16, RevenueAtRisk=325974.52)]
    row = Row(financial_overview=Row(total_revenue=29180012.41, total_orders=49754, total_customers=1500,
                                     average_order_value=586.49),
              top_category=Row(name="Electronics", revenue=16593350.91, share_of_total_pct=56.9),
              customer_segmentation=seg,
              churn_risk_analysis=Row(high_risk_customer_count=216, high_risk_revenue_at_risk=3917393.04,
                                      breakdown=risk),
              sales_forecasting=Row(last_30_day_actual_revenue=1382608.26,
                                    next_30_day_predicted_revenue=1154364.05,
                                    projected_revenue_change_pct=-16.51))
    return spark.createDataFrame([row])


def test_report_key_lines(spark):
    text = kpi.report(_payload(spark)).first().report
    lines = text.split("\n")
    assert lines[0] == "# Executive Summary & Commercial Strategy Report"
    assert "* **Total Revenue:** $29,180,012.41 generated across 49,754 completed transactions." in lines
    assert ("* **Customer Base:** 1,500 unique active customers with an **Average Order Value (AOV)** "
            "of $586.49.") in lines
    assert ("* **Category Leader:** **Electronics** is the highest revenue-generating category, accounting "
            "for **$16,593,350.91** (56.9% of total gross revenue).") in lines
    assert ("* **At-Risk / Inactive:** 570 customers | Total Revenue: $8,578,627.32 | "
            "Avg Recency: 18.7 days") in lines
    assert "* **Occasional Buyers:** 215 customers | Total Revenue: $3,875,589.99 | Avg Recency: 372.0 days" in lines
    assert "  - **High Risk:** 216 customers ($3,917,393.04 total spend)" in lines
    assert ("* **Forecasted Growth Trajectory:** Projected **a decline of 16.5%** over the next 30 days. "
            "This indicates concerning momentum for inventory and cash flow planning.") in lines
    assert text.endswith("before they transition to high-risk churn status.\n")


def test_flat_kpis(spark):
    rows = {r.Metric: (r.Value, r.Text) for r in kpi.flat(_payload(spark)).collect()}
    assert rows["top_category.name"] == (None, "Electronics")
    assert rows["customer_segmentation.Occasional Buyers.CustomerCount"][0] == 215.0
    assert rows["churn_risk_analysis.breakdown.High Risk.RevenueAtRisk"][0] == 3917393.0399999977


def test_number_formats_match_python(spark):
    import random
    from tillroll.functions.text import fixed, grouped
    rnd = random.Random(1)
    vals = [0.15, 0.25, 16.15, 16.25, 16.35, 2.675, 1.005, -0.15, 1e6 + 0.125, 18.659649122807018]
    vals += [rnd.randint(0, 10 ** 6) / 20 for _ in range(500)] + [rnd.random() * 1000 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", fixed("x", 1).alias("a"), grouped("x", 2).alias("c")).collect():
        assert (r.a, r.c) == (format(r.x, ".1f"), format(r.x, ",.2f")), r.x


def test_payload_json_document(spark):
    import json
    doc = json.loads(kpi.payload_json(_payload(spark)).first().json)
    assert doc["financial_overview"]["total_revenue"] == 29180012.41
    assert doc["top_category"] == {"name": "Electronics", "revenue": 16593350.91, "share_of_total_pct": 56.9}
    assert doc["customer_segmentation"][0]["SegmentRevenue"] == 8578627.32
    assert doc["churn_risk_analysis"]["breakdown"][0]["RevenueAtRisk"] == 3917393.04
    assert doc["sales_forecasting"]["projected_revenue_change_pct"] == -16.51
    raw = kpi.payload_json(_payload(spark)).first().json
    assert "E7" not in raw and "29180012.41" in raw
