"""Churn queries.

Score-driven operators are checked with the closed-form gap score (see
``churn.gap_score``); the forest queries run the MLlib model and are checked
by invariants in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import churn, forest
from tillroll.operators import features as feat
from tillroll.operators import segments as seg
from tillroll.plans import sqlfrag as S
from tillroll.plans.q_segments import LABEL_CTES, SCALED_CTES, ASSIGN_CTE
from tillroll.plans.registry import present, register
from tillroll.session import temporary_path
from tillroll.sources.stages import source_inputs, stage_model
from tillroll.sources.tables import churn_split, customer_table, segment_table, transactions


def _features(spark, sf_dir):
    """The customer stage table (written once, read by every branch)."""
    return customer_table(spark, sf_dir)


def _scored(spark, sf_dir, features=None):
    f = features if features is not None else _features(spark, sf_dir)
    return churn.gap_score(churn.label(f))


def _split(spark, sf_dir):
    """Scored customers with their test flag, from the split's stage table."""
    return churn.gap_score(churn_split(spark, sf_dir))


G10 = (f"CASE WHEN Frequency > 1 THEN {S.div_half_even('(CustomerTenureDays - Recency) * 10', 'Frequency - 1')} "
       f"ELSE CustomerTenureDays * 10 END")
SCORED_CTES = S.features_ctes() + [
    f"""g AS (SELECT *, CASE WHEN Recency > 60 THEN 1 ELSE 0 END AS Churn, {G10} AS g10 FROM features)""",
    f"""scored AS (
  SELECT *, CAST(g10 AS DOUBLE) / CAST(g10 + 1800 AS DOUBLE) AS ProbRaw,
         CAST({S.div_half_even('g10 * 10000', 'g10 + 1800')} AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4))
           AS ChurnProbability,
         row_number() OVER (PARTITION BY Churn ORDER BY ('0x' || substr(md5(CustomerID), 1, 8))::BIGINT, CustomerID)
           <= (2 * count(*) OVER (PARTITION BY Churn) * 20 + 100) // 200 AS IsTest
  FROM g)""",
    """banded AS (SELECT *, CASE WHEN ChurnProbability >= 0.70 THEN 'High Risk'
                                  WHEN ChurnProbability >= 0.40 THEN 'Medium Risk' ELSE 'Low Risk' END AS RiskCategory
                  FROM scored)""",
]
SCORED = S.with_ctes(*SCORED_CTES)

PRED_SELECT = """CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary,
       CAST(AvgOrderValue AS DOUBLE) AS AvgOrderValue, PrimaryCategory, Country, CAST(Churn AS BIGINT) AS Churn,
       CAST(ChurnProbability AS DOUBLE) AS ChurnProbability, RiskCategory"""


@register("churn_labels", SCORED + "SELECT CustomerID, Recency, CAST(Churn AS BIGINT) AS Churn FROM g")
def q_churn_labels(spark, sf_dir):
    """Churn label."""
    return present(churn.label(_features(spark, sf_dir)).select("CustomerID", "Recency", "Churn"))


@register("churn_base_rate", SCORED + """
SELECT count(*) AS Customers, CAST(sum(Churn) AS BIGINT) AS Churned, CAST(sum(1 - Churn) AS BIGINT) AS Active,
       CAST(sum(Churn) AS DOUBLE) / count(*) AS ChurnRate FROM g""")
def q_churn_base_rate(spark, sf_dir):
    """Churn base rate."""
    return churn.base_rate(churn.label(_features(spark, sf_dir)))


@register("stratified_split", SCORED + "SELECT CustomerID, CAST(Churn AS BIGINT) AS Churn, IsTest FROM scored")
def q_stratified_split(spark, sf_dir):
    """Stratified 80/20 split: a fifth of each class in hash order."""
    return present(_split(spark, sf_dir).select("CustomerID", "Churn", "IsTest"))


@register("class_weights", SCORED + """
, tr AS (SELECT * FROM scored WHERE NOT IsTest)
SELECT CAST(Churn AS BIGINT) AS Churn, count(*) AS Count,
       CAST((SELECT count(*) FROM tr) AS DOUBLE) / CAST(count(*) * 2 AS DOUBLE) AS Weight
FROM tr GROUP BY Churn""")
def q_class_weights(spark, sf_dir):
    """Balanced class weights from the training split."""
    return present(churn.class_weights(_split(spark, sf_dir)))


@register("risk_bands", SCORED + f"SELECT {PRED_SELECT} FROM banded")
def q_risk_bands(spark, sf_dir):
    """Predictions table with 4-dp probability and risk band."""
    return present(churn.predictions_table(_scored(spark, sf_dir)))


@register("risk_breakdown", SCORED + """
SELECT RiskCategory, count(CustomerID) AS CustomerCount, CAST(sum(Monetary) AS DOUBLE) AS RevenueAtRisk
FROM banded GROUP BY RiskCategory""")
def q_risk_breakdown(spark, sf_dir):
    """Risk distribution."""
    return present(churn.risk_breakdown(_scored(spark, sf_dir)))


@register("risk_share", SCORED + f"""
, c AS (SELECT RiskCategory, count(*) AS CustomerCount FROM banded GROUP BY 1)
SELECT RiskCategory, CustomerCount,
       CAST({S.div_half_up('CustomerCount * 10000', '(SELECT sum(CustomerCount) FROM c)')} AS DOUBLE) / 100.0 AS SharePct
FROM c""")
def q_risk_share(spark, sf_dir):
    """Customers per risk band and percent of all customers."""
    return present(seg.share_of(_scored(spark, sf_dir), "RiskCategory"))


@register("high_risk_rollup", SCORED + """
SELECT count(*) FILTER (WHERE RiskCategory = 'High Risk') AS HighRiskCustomers,
       CAST(coalesce(sum(Monetary) FILTER (WHERE RiskCategory = 'High Risk'), 0) AS DOUBLE) AS HighRiskRevenue
FROM banded""")
def q_high_risk_rollup(spark, sf_dir):
    """High-risk KPI cards."""
    return present(churn.high_risk_rollup(_scored(spark, sf_dir)))


@register("risk_ordered", SCORED + """
, o AS (SELECT * FROM (VALUES (0, 'High Risk'), (1, 'Medium Risk'), (2, 'Low Risk')) t(SortOrder, RiskCategory))
SELECT o.SortOrder, o.RiskCategory, CAST(sum(b.Monetary) AS DOUBLE) AS RevenueAtRisk
FROM o LEFT JOIN banded b ON b.RiskCategory = o.RiskCategory GROUP BY o.SortOrder, o.RiskCategory""")
def q_risk_ordered(spark, sf_dir):
    """Revenue at risk in fixed band order."""
    return present(churn.risk_ordered(_scored(spark, sf_dir)))


@register("probability_histogram", SCORED + """
SELECT RiskCategory, CAST(least(floor(ChurnProbability * 20), 19) AS BIGINT) AS Bin, count(*) AS Customers,
       CAST(least(floor(ChurnProbability * 20), 19) AS BIGINT) / 20.0 AS BinStart
FROM banded GROUP BY ALL""")
def q_probability_histogram(spark, sf_dir):
    """Probability histogram by band."""
    return present(churn.probability_histogram(_scored(spark, sf_dir)))


@register("confusion_matrix", SCORED + """
SELECT CAST(Churn AS BIGINT) AS Actual, CAST(ProbRaw > 0.5 AS BIGINT) AS Predicted, count(*) AS Count
FROM scored WHERE IsTest GROUP BY ALL""")
def q_confusion_matrix(spark, sf_dir):
    """Confusion matrix on the test split."""
    return present(churn.confusion(_split(spark, sf_dir)))


@register("classification_metrics", SCORED + """
, c AS (SELECT count(*) FILTER (WHERE ProbRaw > 0.5 AND Churn = 1) AS tp,
               count(*) FILTER (WHERE ProbRaw > 0.5 AND Churn = 0) AS fp,
               count(*) FILTER (WHERE NOT ProbRaw > 0.5 AND Churn = 1) AS fn,
               count(*) FILTER (WHERE NOT ProbRaw > 0.5 AND Churn = 0) AS tn FROM scored WHERE IsTest),
d AS (SELECT *, CAST(tp AS DOUBLE) AS dtp, CAST(fp AS DOUBLE) AS dfp, CAST(fn AS DOUBLE) AS dfn,
             CAST(tn AS DOUBLE) AS dtn FROM c)
SELECT CASE WHEN dtp + dfp + dfn + dtn > 0 THEN (dtp + dtn) / (dtp + dfp + dfn + dtn) ELSE 0.0 END AS Accuracy,
       CASE WHEN dtp + dfp > 0 THEN dtp / (dtp + dfp) ELSE 0.0 END AS Precision,
       CASE WHEN dtp + dfn > 0 THEN dtp / (dtp + dfn) ELSE 0.0 END AS Recall,
       CASE WHEN 2 * dtp + dfp + dfn > 0 THEN 2 * dtp / (2 * dtp + dfp + dfn) ELSE 0.0 END AS F1,
       tp, fp, fn, tn FROM d""")
def q_classification_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1."""
    return churn.classification_metrics(_split(spark, sf_dir))


ROC_CTES = """
, sc AS (SELECT ProbRaw AS Score, count(*) FILTER (WHERE Churn = 1) AS Pos,
                count(*) FILTER (WHERE Churn = 0) AS Neg FROM scored WHERE IsTest GROUP BY ProbRaw),
run AS (SELECT *, sum(Pos) OVER (ORDER BY Score DESC ROWS UNBOUNDED PRECEDING) AS CumPos,
               sum(Neg) OVER (ORDER BY Score DESC ROWS UNBOUNDED PRECEDING) AS CumNeg FROM sc),
tot AS (SELECT sum(Pos) AS p, sum(Neg) AS n FROM sc)"""


@register("roc_curve", SCORED + ROC_CTES + """
SELECT Score AS Threshold,
       CASE WHEN (SELECT p FROM tot) > 0 THEN CAST(CumPos AS DOUBLE) / CAST((SELECT p FROM tot) AS DOUBLE)
            ELSE 0.0 END AS TPR,
       CASE WHEN (SELECT n FROM tot) > 0 THEN CAST(CumNeg AS DOUBLE) / CAST((SELECT n FROM tot) AS DOUBLE)
            ELSE 0.0 END AS FPR
FROM run""")
def q_roc_curve(spark, sf_dir):
    """ROC curve points."""
    return churn.roc_curve(_split(spark, sf_dir))


@register("roc_auc", SCORED + ROC_CTES + """
SELECT CASE WHEN (SELECT p * n FROM tot) > 0
            THEN CAST(sum(Pos * (((SELECT n FROM tot) - CumNeg) * 2 + Neg)) AS DOUBLE)
                 / CAST((SELECT p * n * 2 FROM tot) AS DOUBLE)
       END AS AUC,
       CAST((SELECT p FROM tot) AS BIGINT) AS Positives, CAST((SELECT n FROM tot) AS BIGINT) AS Negatives
FROM run""")
def q_roc_auc(spark, sf_dir):
    """ROC-AUC with half credit for ties."""
    return present(churn.roc_auc(_split(spark, sf_dir)))


@register("high_risk_list", SCORED + f"SELECT {PRED_SELECT} FROM banded WHERE RiskCategory = 'High Risk'")
def q_high_risk_list(spark, sf_dir):
    """L3: full high-risk action list."""
    return present(churn.high_risk_list(_scored(spark, sf_dir)))


@register("action_list", S.with_ctes(*SCORED_CTES, *SCALED_CTES[len(S.features_ctes()):], ASSIGN_CTE,
                                     *LABEL_CTES) + """
SELECT cp.CustomerID, cs.CustomerSegment, cp.RiskCategory, CAST(cp.ChurnProbability AS DOUBLE) AS ChurnProbability,
       CAST(cp.Monetary AS DOUBLE) AS LifetimeValue, cp.PrimaryCategory, cp.Country
FROM banded cp JOIN segments cs ON cp.CustomerID = cs.CustomerID
WHERE cp.RiskCategory = 'High Risk'
ORDER BY cp.Monetary DESC, cp.CustomerID LIMIT 20""")
def q_action_list(spark, sf_dir):
    """Top-20 high-risk customers with their segment."""
    f = _features(spark, sf_dir)
    cp = _scored(spark, sf_dir, f)
    cs = segment_table(spark, sf_dir).select("CustomerID", "CustomerSegment")
    out = (cp.filter(F.col("RiskCategory") == "High Risk").join(cs, "CustomerID")
             .orderBy(F.col("Monetary").desc(), F.col("CustomerID")).limit(20)
             .select("CustomerID", "CustomerSegment", "RiskCategory", "ChurnProbability",
                     F.col("Monetary").alias("LifetimeValue"), "PrimaryCategory", "Country"))
    return present(out)


@register("inactivity_triggers", S.with_ctes(*S.features_ctes()) + """
SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, PrimaryCategory, Country
FROM features WHERE Recency BETWEEN 45 AND 60""")
def q_inactivity_triggers(spark, sf_dir):
    """C17: customers inside the 45-60 day inactivity window."""
    from tillroll.operators.cleaning import inactivity_window
    return present(inactivity_window(_features(spark, sf_dir))
                   .select("CustomerID", "Recency", "Frequency", "Monetary", "PrimaryCategory", "Country"))


def forest_model(spark, sf_dir, split=None):
    """The fitted forest, trained once per input version."""
    from pyspark.ml.classification import RandomForestClassificationModel
    if split is None:
        split = churn_split(spark, sf_dir)
    return stage_model(spark, "forest-t100-d6-s42", source_inputs(sf_dir),
                       lambda: churn.fit_forest(split), RandomForestClassificationModel)


def _forest(spark, sf_dir):
    split = churn_split(spark, sf_dir)
    return split, forest_model(spark, sf_dir, split)


@register("forest_scores")
def q_forest_scores(spark, sf_dir):
    """MLlib forest predictions for every customer."""
    split, model = _forest(spark, sf_dir)
    return present(churn.predictions_table(churn.forest_scores(split, model)))


@register("forest_importances")
def q_forest_importances(spark, sf_dir):
    """P10: forest feature importances, beside each feature's mean over the training rows."""
    split, model = _forest(spark, sf_dir)
    return churn.forest_importances(split, model)


@register("forest_metrics")
def q_forest_metrics(spark, sf_dir):
    """P8/P9 on the fitted forest's test predictions."""
    split, model = _forest(spark, sf_dir)
    scored = churn.forest_scores(split, model)
    auc = churn.roc_auc(scored).select("AUC").scalar()
    return churn.classification_metrics(scored).withColumn("AUC", auc)


@register("forest_nodes")
def q_forest_nodes(spark, sf_dir):
    """P5: the fitted forest as one row a node."""
    _, model = _forest(spark, sf_dir)
    path = temporary_path(spark)
    model.write().overwrite().save(path)
    return present(forest.node_table(spark, path))


#: A small forest as constants (tree, node, feature, threshold, left, right, weight 0, weight 1): the
#: weights of a leaf add up to a power of two, so that shares are exact.
CONSTANT_FOREST = [
    (0, 0, "Frequency", 8.5, 1, 2, 32.0, 32.0), (0, 1, None, 0.0, -1, -1, 4.0, 12.0),
    (0, 2, "CustomerTenureDays", 2200.0, 3, 4, 28.0, 20.0), (0, 3, None, 0.0, -1, -1, 14.0, 2.0),
    (0, 4, None, 0.0, -1, -1, 6.0, 10.0),
    (1, 0, "AvgDaysBetweenOrders", 180.0, 1, 2, 32.0, 32.0), (1, 1, None, 0.0, -1, -1, 24.0, 8.0),
    (1, 2, None, 0.0, -1, -1, 10.0, 22.0),
    (2, 0, "Monetary", 1500000.0, 1, 2, 8.0, 8.0), (2, 1, "UniqueCategories", 20.0, 3, 4, 5.0, 3.0),
    (2, 2, None, 0.0, -1, -1, 3.0, 5.0), (2, 3, None, 0.0, -1, -1, 3.0, 1.0), (2, 4, None, 0.0, -1, -1, 1.0, 3.0),
    (3, 0, None, 0.0, -1, -1, 1.0, 1.0)]


def _tree_sql(tree: int, node: int = 0) -> str:
    """One tree of the constant forest as nested CASE."""
    _, _, feature, threshold, left, right, w0, w1 = next(r for r in CONSTANT_FOREST if r[:2] == (tree, node))
    if feature is None:
        return f"CAST({w1 / (w0 + w1)!r} AS DOUBLE)"
    return (f"CASE WHEN CAST({feature} AS DOUBLE) <= {threshold!r} THEN {_tree_sql(tree, left)} "
            f"ELSE {_tree_sql(tree, right)} END")


@register("constant_forest", SCORED + f"""
SELECT CustomerID, ({' + '.join(_tree_sql(t) for t in range(4))}) / 4 AS ProbRaw
FROM (SELECT *, CAST(g10 AS DOUBLE) / 10 AS AvgDaysBetweenOrders FROM g)""")
def q_constant_forest(spark, sf_dir):
    """Every customer scored by the node table of a forest written as constants."""
    rows = [(t, n, churn.FEATURE_COLS.index(f) if f else -1, x, left, right, 0.0, w0, w1)
            for t, n, f, x, left, right, w0, w1 in CONSTANT_FOREST]
    nodes = spark.createDataFrame(rows, forest.NODE_SCHEMA)
    return forest.score(_features(spark, sf_dir), nodes, churn.FEATURE_COLS, depth=2).select("CustomerID", "ProbRaw")


@register("churn_predictions_head", SCORED + f"""
SELECT {PRED_SELECT} FROM banded ORDER BY CustomerID LIMIT 5""")
def q_churn_predictions_head(spark, sf_dir):
    """Preview of the first rows of the predictions table (by CustomerID)."""
    return present(churn.predictions_table(_scored(spark, sf_dir)).orderBy("CustomerID").limit(5))
