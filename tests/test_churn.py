"""Churn label, bands, metrics on hand-written frames; forest invariants."""

import itertools

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tillroll.operators import churn


def test_label_boundary(spark):
    df = spark.createDataFrame([("a", 60), ("b", 61)], "CustomerID string, Recency long")
    assert {r.CustomerID: r.Churn for r in churn.label(df).collect()} == {"a": 0, "b": 1}


def test_band_boundaries(spark):
    df = spark.createDataFrame([(0.69996,), (0.6999,), (0.4,), (0.3999,)], "ProbRaw double")
    got = [r.RiskCategory for r in churn.band(df).collect()]
    assert got == ["High Risk", "Medium Risk", "Medium Risk", "Low Risk"]


def test_empty_high_risk_class(spark):
    df = spark.createDataFrame([("a", "Low Risk", 10.5)], "CustomerID string, RiskCategory string, Monetary double")
    df = df.withColumn("Monetary", F.col("Monetary").cast("decimal(12,2)"))
    r = churn.high_risk_rollup(df).first()
    assert r.HighRiskCustomers == 0 and float(r.HighRiskRevenue) == 0.0
    ordered = {x.RiskCategory: x.RevenueAtRisk for x in churn.risk_ordered(df).collect()}
    assert ordered["High Risk"] is None and float(ordered["Low Risk"]) == 10.5


def test_auc_and_roc_against_brute_force(spark):
    rows = [(f"c{i}", y, s, True) for i, (y, s) in enumerate(
        [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.3), (1, 0.3), (0, 0.1), (1, 0.95), (0, 0.5), (0, 0.5), (1, 0.5)])]
    df = spark.createDataFrame(rows, "CustomerID string, Churn int, ProbRaw double, IsTest boolean")
    pos = [s for _, y, s, _ in rows if y == 1]
    neg = [s for _, y, s, _ in rows if y == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    brute /= len(pos) * len(neg)
    assert churn.roc_auc(df).first().AUC == pytest.approx(brute, abs=1e-15)
    roc = {r.Threshold: (r.TPR, r.FPR) for r in churn.roc_curve(df).collect()}
    assert roc[0.5] == (sum(p >= 0.5 for p in pos) / len(pos), sum(n >= 0.5 for n in neg) / len(neg))


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([("a", 0, 0.1, True)], "CustomerID string, Churn int, ProbRaw double, IsTest boolean")
    m = churn.classification_metrics(df).first()
    assert (m.Accuracy, m.Precision, m.Recall, m.F1) == (1.0, 0.0, 0.0, 0.0)


def test_split_is_deterministic(spark):
    from tillroll.sources.tables import customer_table
    f = churn.with_split(churn.label(customer_table(spark, SF01)))
    share = f.agg(F.avg(F.col("IsTest").cast("double"))).first()[0]
    assert 0.15 < share < 0.25
    assert f.filter("IsTest").count() == churn.with_split(churn.label(customer_table(spark, SF01))).filter("IsTest").count()


def test_forest_invariants(spark):
    from tillroll.plans.q_churn import _forest
    split, model = _forest(spark, SF01)
    scored = churn.forest_scores(split, model)
    stats = scored.agg(F.min("ChurnProbability"), F.max("ChurnProbability"), F.count("*")).first()
    assert 0 <= float(stats[0]) <= float(stats[1]) <= 1 and stats[2] == 1500
    assert sum(model.featureImportances.toArray()) == pytest.approx(1.0)
    auc = churn.roc_auc(scored).first().AUC
    assert auc > 0.5
    # reloading the saved model gives the same predictions
    _, again = _forest(spark, SF01)
    a = {r.CustomerID: r.ChurnProbability for r in churn.forest_scores(split, again).collect()}
    b = {r.CustomerID: r.ChurnProbability for r in scored.collect()}
    assert a == b


def test_auc_many_partitions_against_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows = [(f"c{i}", rnd.randint(0, 1), round(rnd.random(), 3), True) for i in range(4000)]
    df = spark.createDataFrame(rows, "CustomerID string, Churn int, ProbRaw double, IsTest boolean")
    pos = sorted(s for _, y, s, _ in rows if y == 1)
    neg = sorted(s for _, y, s, _ in rows if y == 0)
    import bisect
    num2 = sum(2 * bisect.bisect_left(neg, p) + (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p))
               for p in pos)
    assert churn.roc_auc(df).first().AUC == num2 / (2.0 * len(pos) * len(neg))
    roc = {r.Threshold: r for r in churn.roc_curve(df).collect()}
    for t in (0.1, 0.5, 0.9):
        assert roc[t].TPR == sum(p >= t for p in pos) / len(pos)
        assert roc[t].FPR == sum(n >= t for n in neg) / len(neg)
