"""Invariants from the test strategy on full sf0.01 outputs."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF01


def test_forecast_bands_ordered(spark):
    t = entry.queries()["forecast_table"](spark, SF01).filter("DataType = 'Forecast'")
    bad = t.filter((F.col("PredictedRevenue") >= 0) &
                   ~((F.col("LowerBound") <= F.col("PredictedRevenue")) &
                     (F.col("PredictedRevenue") <= F.col("UpperBound"))))
    assert t.count() == 30 and bad.count() == 0
    assert t.filter(F.col("LowerBound") < 0).count() == 0


def test_revenue_is_conserved_across_segments_and_bands(spark):
    q = entry.queries()
    total = q["overview_kpi"](spark, SF01).first().TotalRevenue
    seg = q["segment_breakdown"](spark, SF01).agg(F.sum("TotalSegmentRevenue")).first()[0]
    risk = q["risk_breakdown"](spark, SF01).agg(F.sum("RevenueAtRisk")).first()[0]
    assert round(seg, 2) == round(total, 2) == round(risk, 2)
    counts = q["segment_share"](spark, SF01).agg(F.sum("CustomerCount"), F.sum("SharePct")).first()
    assert counts[0] == 1500 and abs(counts[1] - 100.0) < 0.05


def test_cleaning_audit_adds_up(spark):
    a = entry.queries()["cleaning_audit"](spark, SF01).first()
    clean = entry.queries()["clean_transactions"](spark, SF01).count()
    assert a.FinalRows == clean
    assert a.InitialRows == a.DuplicatesRemoved + a.MissingKeyRemoved + a.InvalidRemoved + a.FinalRows
