"""KPI, report, campaign and mart queries.

The SQL-checked forms use the checkable inputs: fixed-centroid segments,
the closed-form churn score and the grid-fitted global Holt-Winters
forecast.  ``kpi_payload`` uses the fitted k-means and forest models.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import campaigns, churn, kpi, marts
from tillroll.operators import forecast as fc
from tillroll.operators import segments as seg
from tillroll.plans import sqlfrag as S
from tillroll.plans.q_churn import SCORED_CTES
from tillroll.plans.q_forecast import global_forecast_ctes
from tillroll.plans.q_segments import ASSIGN_CTE, LABEL_CTES, SCALED_CTES
from tillroll.plans.registry import present, register
from tillroll.session import temporary_path
from tillroll.sources import sinks
from tillroll.sources.tables import churn_split, customer_table, forecast_table_stage, segment_table, transactions

ALL_CTES = (SCORED_CTES + SCALED_CTES[len(S.features_ctes()):] + [ASSIGN_CTE] + LABEL_CTES
            + global_forecast_ctes())


def _inputs(spark, sf_dir, fitted: bool = False):
    """Transactions, segments, churn scores and forecast summary, from the
    stage tables that every KPI section reads (the forecast summary comes
    from the stored forecast table, as in the reference's KPI step)."""
    tx = transactions(spark, sf_dir)
    f = customer_table(spark, sf_dir)
    if fitted:
        from tillroll.plans.q_churn import forest_model
        from tillroll.plans.q_segments import kmeans_model
        segments = seg.kmeans_segments(f, model=kmeans_model(spark, sf_dir))
        split = churn_split(spark, sf_dir)
        scored = churn.forest_scores(split, forest_model(spark, sf_dir, split))
    else:
        segments = segment_table(spark, sf_dir)
        scored = churn.gap_score(churn.label(f))
    table, keys = fc.keyed(forecast_table_stage(spark, sf_dir), [])
    summary = fc.forecast_summary(table, keys).drop(fc.GLOBAL_KEY)
    return tx, segments, scored, summary


def _payload(spark, sf_dir, fitted=False):
    return kpi.payload(*_inputs(spark, sf_dir, fitted))


def _num(metric: str, expr: str, src: str) -> str:
    return f"SELECT '{metric}' AS Metric, CAST({expr} AS DOUBLE) AS Value, CAST(NULL AS VARCHAR) AS Text FROM {src}"


KPI_FLAT_SQL = "WITH RECURSIVE " + ",\n".join(ALL_CTES + [
    "ov AS (SELECT sum(Revenue) AS rev, count(DISTINCT TransactionID) AS orders, "
    "count(DISTINCT CustomerID) AS cust, count(Revenue) AS n FROM transactions)",
    "cat AS (SELECT ProductCategory, sum(Revenue) AS r FROM transactions GROUP BY 1)",
    "topc AS (SELECT ProductCategory AS name, r FROM cat ORDER BY r DESC, ProductCategory LIMIT 1)",
    "tot AS (SELECT sum(r) AS t FROM cat)",
    "segk AS (SELECT CustomerSegment, count(CustomerID) AS c, CAST(sum(Monetary) AS DOUBLE) AS sr, "
    "CAST(sum(Recency) AS DOUBLE) / count(Recency) AS ar FROM segments GROUP BY 1)",
    "riskk AS (SELECT RiskCategory, count(CustomerID) AS c, CAST(sum(Monetary) AS DOUBLE) AS r FROM banded GROUP BY 1)",
]) + "\n" + "\nUNION ALL\n".join([
    _num("financial_overview.total_revenue", "rev", "ov"),
    _num("financial_overview.total_orders", "orders", "ov"),
    _num("financial_overview.total_customers", "cust", "ov"),
    _num("financial_overview.average_order_value",
         S.money(S.div_half_even(S.cents("rev"), "n")), "ov"),
    "SELECT 'top_category.name', CAST(NULL AS DOUBLE), coalesce((SELECT name FROM topc), 'N/A')",
    _num("top_category.revenue", "coalesce((SELECT r FROM topc), 0)", "ov"),
    _num("top_category.share_of_total_pct",
         f"CASE WHEN coalesce(tot.t, 0) > 0 THEN CAST({S.div_half_even(S.cents('(SELECT r FROM topc)') + ' * 1000', S.cents('tot.t'))} AS DOUBLE) / 10.0 ELSE 0.0 END",
         "tot"),
    _num("churn_risk_analysis.high_risk_customer_count",
         "count(*) FILTER (WHERE RiskCategory = 'High Risk')", "banded"),
    _num("churn_risk_analysis.high_risk_revenue_at_risk",
         "coalesce(sum(Monetary) FILTER (WHERE RiskCategory = 'High Risk'), 0)", "banded"),
    _num("sales_forecasting.last_30_day_actual_revenue", "Last30DayActualRevenue", "fsum"),
    _num("sales_forecasting.next_30_day_predicted_revenue", "Next30DayPredictedRevenue", "fsum"),
    _num("sales_forecasting.projected_revenue_change_pct", "ProjectedChangePct", "fsum"),
    *[f"SELECT 'customer_segmentation.' || CustomerSegment || '.{m}', CAST({c} AS DOUBLE), CAST(NULL AS VARCHAR) FROM segk"
      for m, c in (("CustomerCount", "c"), ("SegmentRevenue", "sr"), ("AvgRecency", "ar"))],
    *[f"SELECT 'churn_risk_analysis.breakdown.' || RiskCategory || '.{m}', CAST({c} AS DOUBLE), CAST(NULL AS VARCHAR) FROM riskk"
      for m, c in (("CustomerCount", "c"), ("RevenueAtRisk", "r"))],
])


@register("kpi_flat", KPI_FLAT_SQL)
def q_kpi_flat(spark, sf_dir):
    """K1/K2: the KPI document flattened to one row per metric."""
    return kpi.flat(_payload(spark, sf_dir))


@register("kpi_payload")
def q_kpi_payload(spark, sf_dir):
    """The nested KPI document as JSON (fitted models)."""
    return kpi.payload_json(_payload(spark, sf_dir, fitted=True))


def _q(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


_KPI_CTES = ALL_CTES + [
    "ov AS (SELECT sum(Revenue) AS rev, count(DISTINCT TransactionID) AS orders, "
    "count(DISTINCT CustomerID) AS cust, count(Revenue) AS n FROM transactions)",
    "cat AS (SELECT ProductCategory, sum(Revenue) AS r FROM transactions GROUP BY 1)",
    "topc AS (SELECT ProductCategory AS name, r FROM cat ORDER BY r DESC, ProductCategory LIMIT 1)",
    "tot AS (SELECT sum(r) AS t FROM cat)",
    "segk AS (SELECT CustomerSegment, count(CustomerID) AS c, CAST(sum(Monetary) AS DOUBLE) AS sr, "
    "CAST(sum(Recency) AS DOUBLE) / count(Recency) AS ar FROM segments GROUP BY 1)",
    "riskk AS (SELECT RiskCategory, count(CustomerID) AS c, CAST(sum(Monetary) AS DOUBLE) AS r FROM banded GROUP BY 1)",
    f"""kv AS (SELECT CAST(rev AS DOUBLE) AS total_revenue, orders, cust,
       {S.money(S.div_half_even(S.cents('rev'), 'n'))} AS aov,
       coalesce((SELECT name FROM topc), 'N/A') AS cat_name,
       coalesce(CAST((SELECT r FROM topc) AS DOUBLE), 0.0) AS cat_rev,
       CASE WHEN coalesce((SELECT t FROM tot), 0) > 0
            THEN CAST({S.div_half_even(S.cents('(SELECT r FROM topc)') + ' * 1000', S.cents('(SELECT t FROM tot)'))} AS DOUBLE) / 10.0
            ELSE 0.0 END AS share,
       (SELECT count(*) FILTER (WHERE RiskCategory = 'High Risk') FROM banded) AS hi_c,
       (SELECT CAST(coalesce(sum(Monetary) FILTER (WHERE RiskCategory = 'High Risk'), 0) AS DOUBLE) FROM banded) AS hi_r,
       (SELECT Last30DayActualRevenue FROM fsum) AS l30, (SELECT Next30DayPredictedRevenue FROM fsum) AS n30,
       (SELECT ProjectedChangePct FROM fsum) AS pct
FROM ov)""",
]

REPORT_SQL = "WITH RECURSIVE " + ",\n".join(_KPI_CTES) + f"""
SELECT printf({_q(kpi.REPORT_HEAD)}, format('{{:,.2f}}', total_revenue), format('{{:,}}', orders),
              format('{{:,}}', cust), format('{{:.2f}}', aov), cat_name, format('{{:,.2f}}', cat_rev),
              CASE WHEN share = 0 THEN '0' WHEN share = floor(share) THEN format('{{:.1f}}', share)
                   ELSE format('{{}}', share) END)
    || coalesce((SELECT string_agg(printf({_q(kpi.REPORT_SEGMENT_LINE)}, CustomerSegment, format('{{:,}}', c),
                                          format('{{:,.2f}}', sr), format('{{:.1f}}', ar)), '' ORDER BY CustomerSegment)
                 FROM segk), '')
    || printf({_q(kpi.REPORT_CHURN)}, format('{{:,}}', hi_c), format('{{:,.2f}}', hi_r))
    || coalesce((SELECT string_agg(printf({_q(kpi.REPORT_RISK_LINE)}, RiskCategory, format('{{:,}}', c),
                                          format('{{:,.2f}}', r)), '' ORDER BY RiskCategory) FROM riskk), '')
    || printf({_q(kpi.REPORT_TAIL)}, format('{{:,.2f}}', l30), format('{{:,.2f}}', n30),
              CASE WHEN pct >= 0 THEN 'an increase' ELSE 'a decline' END, format('{{:.1f}}', abs(pct)),
              CASE WHEN pct >= 0 THEN 'positive' ELSE 'concerning' END, CAST(hi_c AS VARCHAR),
              format('{{:,.2f}}', hi_r), cat_name, format('{{:.2f}}', aov)) AS report
FROM kv"""


@register("executive_report", REPORT_SQL)
def q_executive_report(spark, sf_dir):
    """Executive report text (checkable inputs)."""
    return kpi.report(_payload(spark, sf_dir))


CAMPAIGN_INPUTS_SQL = "WITH " + ",\n".join(
    SCORED_CTES + SCALED_CTES[len(S.features_ctes()):] + [ASSIGN_CTE] + LABEL_CTES + [
        "j AS (SELECT s.CustomerSegment, s.PrimaryCategory, s.AvgOrderValue, b.RiskCategory "
        "FROM segments s JOIN banded b ON s.CustomerID = b.CustomerID)",
        S.mode_cte("mc", "j", "CustomerSegment", "PrimaryCategory"),
        S.mode_cte("mr", "j", "CustomerSegment", "RiskCategory"),
        f"""ci AS (SELECT j.CustomerSegment, any_value(mc.PrimaryCategory) AS FavoriteCategory,
              {S.money(S.div_half_even(S.cents('sum(j.AvgOrderValue)'), 'count(j.AvgOrderValue)'))} AS AvgSpend,
              any_value(mr.RiskCategory) AS ChurnRisk
       FROM j LEFT JOIN mc ON mc.CustomerSegment = j.CustomerSegment
              LEFT JOIN mr ON mr.CustomerSegment = j.CustomerSegment GROUP BY j.CustomerSegment)"""]) + "\n"


def _campaign_inputs(spark, sf_dir):
    f = customer_table(spark, sf_dir)
    return campaigns.inputs(segment_table(spark, sf_dir), churn.gap_score(churn.label(f)))


@register("campaign_inputs", CAMPAIGN_INPUTS_SQL + "SELECT * FROM ci")
def q_campaign_inputs(spark, sf_dir):
    """K6: favourite category, average order value and risk per segment."""
    return _campaign_inputs(spark, sf_dir)


def _sql_fmt(t: str) -> str:
    return t.replace("'", "''")


def _campaign_sql() -> str:
    c = campaigns
    vip = "CustomerSegment LIKE '%VIP%'"
    risk = "(CustomerSegment LIKE '%At-Risk%' OR CustomerSegment LIKE '%Inactive%')"
    spend = "printf('%.2f', AvgSpend)"

    def pick(a, b, d):
        return f"CASE WHEN {vip} THEN {a} WHEN {risk} THEN {b} ELSE {d} END"

    def fmt(t, *args):
        return f"printf('{_sql_fmt(c._fmt(t))}', {', '.join(args)})"

    subject = pick(fmt(c.VIP_SUBJECT, "FavoriteCategory"), fmt(c.RISK_SUBJECT, "FavoriteCategory"),
                   fmt(c.OTHER_SUBJECT, "FavoriteCategory"))
    offer = pick(f"'{_sql_fmt(c.VIP_OFFER)}'", f"'{_sql_fmt(c.RISK_OFFER)}'", f"'{_sql_fmt(c.OTHER_OFFER)}'")
    body = pick(fmt(c.VIP_BODY, spend, "FavoriteCategory"), fmt(c.RISK_BODY, "FavoriteCategory"),
                fmt(c.OTHER_BODY, "FavoriteCategory"))
    cta = pick(f"'{_sql_fmt(c.VIP_CTA)}'", f"'{_sql_fmt(c.RISK_CTA)}'", f"'{_sql_fmt(c.OTHER_CTA)}'")
    return CAMPAIGN_INPUTS_SQL + f""", cp AS (SELECT *, {subject} AS Subject, {offer} AS Offer, {body} AS Body,
        {cta} AS CallToAction FROM ci)
SELECT *, replace(replace(replace(lower(CustomerSegment), ' ', '_'), '/', ''), '-', '_') AS Slug,
       printf('{_sql_fmt(c._fmt(c.TEMPLATE))}', CustomerSegment, CustomerSegment, ChurnRisk, Subject, Body,
              Offer, CallToAction) AS Text
FROM cp"""


@register("campaigns", _campaign_sql())
def q_campaigns(spark, sf_dir):
    """Campaign copy per segment."""
    return campaigns.copy(_campaign_inputs(spark, sf_dir))


@register("text_round_trip", f"""
SELECT Slug, count(*) AS Lines, CAST(sum(length(Line)) AS BIGINT) AS Chars, CAST(sum(CASE WHEN Line <> '' THEN 1 ELSE 0 END) AS BIGINT) AS Filled
FROM (SELECT Slug, unnest(string_split(Text, chr(10))) AS Line FROM ({_campaign_sql()})) GROUP BY Slug""")
def q_text_round_trip(spark, sf_dir):
    """Campaign copy written as one text per segment and read back by slug."""
    path = temporary_path(spark)
    sinks.write_texts(campaigns.copy(_campaign_inputs(spark, sf_dir)), path, "Slug", "Text")
    lines = spark.read.schema("value string, Slug string").text(path)
    return lines.groupBy("Slug").agg(
        F.count(F.lit(1)).alias("Lines"), F.sum(F.length("value")).cast("bigint").alias("Chars"),
        F.sum((F.col("value") != "").cast("bigint")).alias("Filled"))


@register("monthly_year_mart", S.with_ctes(S.TX_CTE) + """
SELECT CAST(year(TransactionDate) AS BIGINT) AS Year, CAST(month(TransactionDate) AS BIGINT) AS Month,
       CAST(sum(Revenue) AS DOUBLE) AS GrossRevenue, count(DISTINCT TransactionID) AS OrderVolume
FROM transactions GROUP BY ALL""")
def q_monthly_year_mart(spark, sf_dir):
    """B2: revenue and order volume by year/month."""
    return present(marts.monthly_year(transactions(spark, sf_dir)))


@register("fact_enriched", "WITH " + ",\n".join(
    SCORED_CTES + SCALED_CTES[len(S.features_ctes()):] + [ASSIGN_CTE] + LABEL_CTES) + f"""
SELECT t.TransactionID, t.CustomerID, t.ProductID, t.ProductCategory, CAST(t.Quantity AS BIGINT) AS Quantity,
       CAST(t.UnitPrice AS DOUBLE) AS UnitPrice, CAST(t.Revenue AS DOUBLE) AS Revenue,
       {S.ts_text('t.TransactionDate')} AS TransactionDate, t.Country, t.PaymentMethod,
       s.CustomerSegment, b.RiskCategory, CAST(b.ChurnProbability AS DOUBLE) AS ChurnProbability
FROM transactions t LEFT JOIN segments s ON s.CustomerID = t.CustomerID
LEFT JOIN banded b ON b.CustomerID = t.CustomerID""")
def q_fact_enriched(spark, sf_dir):
    """Fact rows with customer segment and churn risk."""
    tx = transactions(spark, sf_dir)
    f = customer_table(spark, sf_dir)
    scored = churn.gap_score(churn.label(f))
    return present(marts.fact_enriched(tx, segment_table(spark, sf_dir), scored))


def _d(expr: str, scale: int = 2) -> str:
    return f"CAST({expr} AS DECIMAL({22 if scale == 2 else 6},{scale}))"


KPI_DOC_SQL = "WITH RECURSIVE " + ",\n".join(_KPI_CTES) + f"""
SELECT to_json(struct_pack(
  financial_overview := struct_pack(total_revenue := {_d('total_revenue')}, total_orders := orders,
                                    total_customers := cust, average_order_value := {_d('aov')}),
  top_category := struct_pack(name := cat_name, revenue := {_d('cat_rev')},
                              share_of_total_pct := {_d('share', 1)}),
  customer_segmentation := (SELECT list(struct_pack(CustomerSegment := CustomerSegment, CustomerCount := c,
                                                    SegmentRevenue := {_d('sr')}, AvgRecency := ar)
                                        ORDER BY CustomerSegment) FROM segk),
  churn_risk_analysis := struct_pack(
      high_risk_customer_count := hi_c, high_risk_revenue_at_risk := {_d('hi_r')},
      breakdown := (SELECT list(struct_pack(RiskCategory := RiskCategory, CustomerCount := c,
                                            RevenueAtRisk := {_d('r')}) ORDER BY RiskCategory) FROM riskk)),
  sales_forecasting := struct_pack(last_30_day_actual_revenue := {_d('l30')},
                                   next_30_day_predicted_revenue := {_d('n30')},
                                   projected_revenue_change_pct := {_d('pct')})
)) AS json FROM kv"""


@register("kpi_document", KPI_DOC_SQL)
def q_kpi_document(spark, sf_dir):
    """The KPI JSON document from the checkable inputs."""
    return kpi.payload_json(_payload(spark, sf_dir))


@register("json_round_trip", KPI_DOC_SQL)
def q_json_round_trip(spark, sf_dir):
    """The KPI document as the file on disk holds it."""
    path = temporary_path(spark)
    sinks.write_json_lines(kpi.payload_json(_payload(spark, sf_dir)), path)
    return spark.read.text(path).withColumnRenamed("value", "json")
