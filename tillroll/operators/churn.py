"""Churn label, split, forest, risk bands and evaluation (P1-P13, A14-A15,
A20, A23-A24, C17).

Everything downstream of the score takes a probability column, so the same
operators serve the fitted forest and the closed-form score used for
checking.  Evaluation works on counts grouped by distinct score; the running
sums over scores are computed per range partition and stitched together
with partition offsets, so no window ever holds all customers in one task.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.money import div_round, np_round
from tillroll.operators.ranking import running_totals

CHURN_DAYS = 60
FEATURE_COLS = ["Frequency", "Monetary", "AvgOrderValue", "TotalProducts", "UniqueCategories",
                "CustomerTenureDays", "AvgDaysBetweenOrders"]
# Risk band thresholds and names.
HIGH, MEDIUM = 0.70, 0.40
RISK_ORDER = ["High Risk", "Medium Risk", "Low Risk"]
PREDICTION_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary", "AvgOrderValue",
                      "PrimaryCategory", "Country", "Churn", "ChurnProbability", "RiskCategory"]
GAP_SCALE = 180  # days; scale of the closed-form check score


def label(features: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Churned when Recency is strictly greater than ``days``."""
    return features.withColumn("Churn", (F.col("Recency") > days).cast("int"))


def base_rate(labelled: DataFrame) -> DataFrame:
    """Churn rate, churned and active counts."""
    return labelled.agg(F.count(F.lit(1)).alias("Customers"),
                        F.sum("Churn").cast("bigint").alias("Churned"),
                        F.sum(1 - F.col("Churn")).cast("bigint").alias("Active"),
                        (F.sum("Churn").cast("double") / F.count(F.lit(1))).alias("ChurnRate"))


def with_split(labelled: DataFrame, test_pct: int = 20) -> DataFrame:
    """Stratified test membership: of each class the first ``test_pct``
    percent (rounded half up) in the order of a hash of CustomerID.

    The order is the first 8 hex digits of md5 as an integer, then the id.
    Ranks come from a two-level running count over (class, hash), so no task
    holds a class; only keys move, and the flags are joined back by customer.
    """
    h = F.conv(F.substring(F.md5(F.col("CustomerID")), 1, 8), 16, 10).cast("bigint")
    keys = labelled.groupBy("Churn", h.alias("_h"), "CustomerID").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(keys, ["Churn", "_h", "CustomerID"], ["n"])
    sizes = ranked.groupBy("Churn").agg(F.sum("n").alias("_size"))
    start = F.coalesce(F.sum("_size").over(Window.orderBy("Churn").rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0))
    sizes = sizes.select(F.col("Churn").alias("_class"), "_size", start.alias("_start"))  # one row per class
    flags = ranked.join(F.broadcast(sizes), F.col("Churn") == F.col("_class")).select(
        F.col("CustomerID").alias("_id"),
        (F.col("Cumn") - F.col("_start") <= div_round(F.col("_size") * test_pct, F.lit(100))).alias("IsTest"))
    return labelled.join(flags, F.col("CustomerID") == F.col("_id")).drop("_id")


def class_weights(split: DataFrame) -> DataFrame:
    """Balanced weights n / (2 n_c) from the training rows (2 rows)."""
    train = split.filter(~F.col("IsTest"))
    counts = train.groupBy("Churn").agg(F.count(F.lit(1)).alias("Count"))
    total = train.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("Weight", total.cast("double") / (F.col("Count") * 2).cast("double"))


def risk_category(prob) -> F.Column:
    """Bands on the 4-dp probability (>= 0.70 High, >= 0.40 Medium)."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return (F.when(p >= HIGH, "High Risk").when(p >= MEDIUM, "Medium Risk").otherwise("Low Risk"))


def band(scored: DataFrame, raw_col: str = "ProbRaw") -> DataFrame:
    """Round the probability to 4 places the way numpy's ``round(4)``
    does (scale, round half-even, unscale), then band the rounded value."""
    p4 = np_round(F.col(raw_col), 4).cast("decimal(5,4)")
    return (scored.withColumn("ChurnProbability", p4)
                  .withColumn("RiskCategory", risk_category("ChurnProbability")))


def gap_score(labelled: DataFrame) -> DataFrame:
    """Closed-form score used to check the score-driven operators:
    p = g / (g + 180) with g = AvgDaysBetweenOrders (a model feature).

    ``ProbRaw`` is the double quotient; ``ChurnProbability`` is its exact
    half-even rounding to 4 places computed on integers (g has 1 decimal).
    """
    g10 = F.round(F.col("AvgDaysBetweenOrders") * 10).cast("bigint")
    p4 = div_round(g10 * 10000, g10 + GAP_SCALE * 10, "half_even")
    return (labelled
            .withColumn("ProbRaw", g10.cast("double") / (g10 + GAP_SCALE * 10).cast("double"))
            .withColumn("ChurnProbability", (p4.cast("decimal(20,0)") / 10000).cast("decimal(5,4)"))
            .withColumn("RiskCategory", risk_category("ChurnProbability")))


def predictions_table(scored: DataFrame) -> DataFrame:
    """The churn predictions table."""
    return scored.select(*PREDICTION_COLUMNS)


def high_risk_list(scored: DataFrame) -> DataFrame:
    """L3: every high-risk customer, largest lifetime value first."""
    return (predictions_table(scored).filter(F.col("RiskCategory") == "High Risk")
            .orderBy(F.col("Monetary").desc(), F.col("CustomerID")))


def risk_breakdown(scored: DataFrame) -> DataFrame:
    """Customers and revenue at risk per band."""
    return scored.groupBy("RiskCategory").agg(F.count("CustomerID").alias("CustomerCount"),
                                              F.sum("Monetary").alias("RevenueAtRisk"))


def high_risk_rollup(scored: DataFrame) -> DataFrame:
    """High-risk count and revenue, 0 when the band is empty."""
    hi = F.col("RiskCategory") == "High Risk"
    return scored.agg(F.count(F.when(hi, 1)).alias("HighRiskCustomers"),
                      F.coalesce(F.sum(F.when(hi, F.col("Monetary"))), F.lit(0).cast("decimal(22,2)"))
                       .alias("HighRiskRevenue"))


def risk_ordered(scored: DataFrame) -> DataFrame:
    """Revenue per band in the fixed order High, Medium, Low; a band
    with no customers gives null.  One global aggregate, unpivoted."""
    sums = [F.sum(F.when(F.col("RiskCategory") == r, F.col("Monetary"))) for r in RISK_ORDER]
    rows = F.array(*[F.struct(F.lit(i).alias("SortOrder"), F.lit(r).alias("RiskCategory"),
                              s.alias("RevenueAtRisk"))
                     for i, (r, s) in enumerate(zip(RISK_ORDER, sums))])
    return scored.agg(rows.alias("_r")).select(F.inline("_r"))


def probability_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Fixed-width bins of the probability over [0, 1] by band."""
    b = F.least(F.floor(F.col("ChurnProbability") * bins), F.lit(bins - 1)).cast("bigint")
    return (scored.groupBy("RiskCategory", b.alias("Bin"))
                  .agg(F.count(F.lit(1)).alias("Customers"))
                  .withColumn("BinStart", F.col("Bin") / float(bins)))


def _predicted(prob_col: str) -> F.Column:
    # argmax of (1-p, p); an exact 0.5 goes to class 0
    return (F.col(prob_col) > 0.5).cast("int")


def confusion(split_scored: DataFrame, prob_col: str = "ProbRaw") -> DataFrame:
    """Confusion matrix on the test rows."""
    test = split_scored.filter("IsTest")
    return (test.groupBy(F.col("Churn").alias("Actual"), _predicted(prob_col).alias("Predicted"))
                .agg(F.count(F.lit(1)).alias("Count")))


def classification_metrics(split_scored: DataFrame, prob_col: str = "ProbRaw") -> DataFrame:
    """Accuracy, precision, recall, F1 on the test rows (0 when undefined)."""
    test = split_scored.filter("IsTest")
    pred, y = _predicted(prob_col), F.col("Churn")
    c = test.agg(F.count(F.when((pred == 1) & (y == 1), 1)).alias("tp"),
                 F.count(F.when((pred == 1) & (y == 0), 1)).alias("fp"),
                 F.count(F.when((pred == 0) & (y == 1), 1)).alias("fn"),
                 F.count(F.when((pred == 0) & (y == 0), 1)).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return c.select(
        F.when(n > 0, (tp + tn) / n).otherwise(0.0).alias("Accuracy"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("Precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("Recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("F1"),
        "tp", "fp", "fn", "tn")


def _score_counts(split_scored: DataFrame, prob_col: str) -> DataFrame:
    test = split_scored.filter("IsTest")
    return test.groupBy(F.col(prob_col).alias("Score")).agg(
        F.count(F.when(F.col("Churn") == 1, 1)).alias("Pos"),
        F.count(F.when(F.col("Churn") == 0, 1)).alias("Neg"))


def _running_above(counts: DataFrame) -> DataFrame:
    """Cumulative Pos/Neg over scores >= each score (descending order), by
    the distributed two-level prefix sum of ``ranking.running_totals``."""
    return running_totals(counts, "Score", ["Pos", "Neg"], descending=True)


def roc_curve(split_scored: DataFrame, prob_col: str = "ProbRaw") -> DataFrame:
    """One ROC point per distinct test score (threshold >= score)."""
    counts = _score_counts(split_scored, prob_col)
    tot = counts.select(F.struct(F.sum("Pos").alias("p"), F.sum("Neg").alias("n"))).scalar()
    run = _running_above(counts)
    return run.select(
        F.col("Score").alias("Threshold"),
        F.when(tot["p"] > 0, F.col("CumPos").cast("double") / tot["p"].cast("double")).otherwise(0.0).alias("TPR"),
        F.when(tot["n"] > 0, F.col("CumNeg").cast("double") / tot["n"].cast("double")).otherwise(0.0).alias("FPR"))


def roc_auc(split_scored: DataFrame, prob_col: str = "ProbRaw") -> DataFrame:
    """ROC-AUC (ties count one half), exact on integer counts.

    AUC = sum_s Pos(s) * (Neg(< s) + Neg(s)/2) / (P * N).
    """
    run = _running_above(_score_counts(split_scored, prob_col))
    neg_below_twice = (F.col("_N") - F.col("CumNeg")) * 2 + F.col("Neg")
    tot = run.select(F.struct(F.sum("Pos").alias("p"), F.sum("Neg").alias("n"))).scalar()
    agg = run.withColumn("_N", tot["n"]).agg(
        F.sum(F.col("Pos").cast("decimal(38,0)") * neg_below_twice).alias("num2"))
    denom = (tot["p"] * tot["n"] * 2).cast("double")
    return agg.select(F.when(denom > 0, F.col("num2").cast("double") / denom).alias("AUC"),
                      tot["p"].alias("Positives"), tot["n"].alias("Negatives"))


# -------------------------------------------------------------- MLlib forest
def _assembled(df: DataFrame) -> DataFrame:
    feats = [F.col(c).cast("double").alias(f"f_{c}") for c in FEATURE_COLS]
    return VectorAssembler(inputCols=[f"f_{c}" for c in FEATURE_COLS],
                           outputCol="features").transform(df.select("*", *feats))


#: Partitions of the training rows: a setting of the model, as bagging draws
#: per partition; it does not follow the number of rows.
FIT_PARTITIONS = 8


def fit_forest(split: DataFrame, seed: int = 42, num_trees: int = 100, max_depth: int = 6,
               partitions: int = FIT_PARTITIONS):
    """Random forest on the training rows with balanced weights.

    Training rows are hash-partitioned and sorted by CustomerID first so the
    forest's per-partition sampling sees a repeatable layout.
    """
    weights = class_weights(split).select("Churn", "Weight")
    train = split.filter(~F.col("IsTest")).join(F.broadcast(weights), "Churn")
    train = train.repartition(partitions, "CustomerID").sortWithinPartitions("CustomerID")
    rf = RandomForestClassifier(featuresCol="features", labelCol="Churn", weightCol="Weight",
                                numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                featureSubsetStrategy="sqrt", maxBins=128)
    return rf.fit(_assembled(train))


def forest_scores(split: DataFrame, model) -> DataFrame:
    """Score every customer (training rows included) and band them."""
    scored = model.transform(_assembled(split)).withColumn(
        "ProbRaw", vector_to_array("probability")[1])
    extra = ["features", "rawPrediction", "probability", "prediction"] + [f"f_{c}" for c in FEATURE_COLS]
    return band(scored.drop(*extra))


def forest_importances(split: DataFrame, model) -> DataFrame:
    """P10: feature importances with each feature's mean over the training
    rows, largest importance first (7 rows)."""
    means = split.filter(~F.col("IsTest")).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATURE_COLS])
    rows = [F.struct(F.lit(c).alias("Feature"), F.lit(float(x)).alias("Importance"), F.col(c).alias("TrainMean"))
            for c, x in zip(FEATURE_COLS, model.featureImportances.toArray())]
    return means.select(F.inline(F.array(*rows))).orderBy(F.col("Importance").desc(), "Feature")
