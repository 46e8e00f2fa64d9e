"""Fits depend on the rows and the settings, not on the input's size or an iteration cap."""

import inspect

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from tests.conftest import SF001, SF01
from tillroll.operators import churn, forest, lloyd, scoring
from tillroll.operators import segments as seg
from tillroll.sources.tables import churn_split, customer_table


def test_fit_does_not_depend_on_the_layout(spark):
    """Exact sums: any partitioning and order of the rows gives the same chain."""
    f = customer_table(spark, SF001)
    first = seg.fit_kmeans(f, restarts=2)
    again = seg.fit_kmeans(f.repartition(5).orderBy("Monetary"), restarts=2)
    # the deviations of the scaler may differ in their last bit, what follows may not
    assert [s.getStatement() for s in first.stages[1:]] == [s.getStatement() for s in again.stages[1:]]
    columns = ["CustomerID", *seg.Z, "Cluster", "CustomerSegment"]
    assert sorted(first.transform(f).select(*columns).collect()) == sorted(again.transform(f).select(*columns).collect())
    assert inspect.signature(churn.fit_forest).parameters["partitions"].default == churn.FIT_PARTITIONS


def test_a_fit_that_does_not_converge_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "STEP_LIMIT", 1)
    with pytest.raises(RuntimeError, match="did not converge"):
        seg.fit_kmeans(customer_table(spark, SF001), restarts=1)


def test_sweep_and_model_agree(spark):
    """At k = 4 the sweep's row describes the segments of the chain, by MLlib's evaluator too."""
    f = customer_table(spark, SF001)
    row = seg.kmeans_sweep(f, ks=[2, 4], restarts=2).where("k = 4").first()
    scored = seg.fit_kmeans(f, restarts=2).transform(f)
    vectors = VectorAssembler(inputCols=seg.Z, outputCol="features").transform(scored)
    points = np.array(scored.select(*seg.Z).collect())
    cluster = np.array([r[0] for r in scored.select("Cluster").collect()])
    cost = sum(((points[cluster == j] - points[cluster == j].mean(0)) ** 2).sum() for j in set(cluster))
    assert row["TrainingCost"] == pytest.approx(cost, rel=1e-6)
    want = ClusteringEvaluator(featuresCol="features", predictionCol="Cluster").evaluate(vectors)
    assert row["Silhouette"] == pytest.approx(want, abs=2e-6)


def test_shared_steps_equal_numpy(spark):
    """All models of one scan, against Lloyd steps in numpy; an empty cluster stays."""
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (300, 2)) * 1_000_000_000
    pts = spark.createDataFrame([(str(i), int(a), int(b)) for i, (a, b) in enumerate(x)],
                                "CustomerID string, u0 bigint, u1 bigint").repartition(3)
    starts = {k: x[:k].astype(float) for k in (2, 3, 5)} | {"empty": np.array([[0.0, 0.0], [1e18, 1e18]])}
    for name, (got, steps) in lloyd.fit(pts, starts, 1e9, tolerance=0.0).items():
        c = starts[name].copy()
        for _ in range(steps):
            near = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        assert np.allclose(got, c, rtol=1e-12)


def test_silhouette_of_pairs(spark):
    """Cluster moments against the definition over all pairs; a lone member counts 0."""
    rng = np.random.default_rng(1)
    x, c = rng.integers(-9, 9, (40, 3)), np.array([0] * 20 + [1] * 19 + [2])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    scores = []
    for i in range(40):
        own = (c == c[i]).sum()
        a = d[i][c == c[i]].sum() / max(1, own - 1)
        b = min(d[i][c == j].mean() for j in set(c) - {c[i]})
        scores.append(0.0 if own == 1 else (b - a) / max(a, b))
    df = spark.createDataFrame([(int(k), *map(int, r)) for k, r in zip(c, x)], "Cluster int, u0 bigint, u1 bigint, u2 bigint")
    got = lloyd.silhouette(df, ["u0", "u1", "u2"], 1.0).first()[0]
    assert got == pytest.approx(np.mean(scores), abs=1e-6)
    assert lloyd.silhouette(df.where("Cluster = 0"), ["u0", "u1", "u2"], 1.0).first()[0] is None


def test_saved_chain_scores_a_slice_alone(spark, tmp_path):
    """Scores from disk equal those in memory, whoever else is scored."""
    f = customer_table(spark, SF001)
    for chain in (seg.fit_kmeans(f, restarts=1), scoring.segment_chain(f, seg.FIXED_CENTROIDS)):
        loaded = scoring.load(scoring.save(chain, str(tmp_path / chain.uid)))
        columns = ["CustomerID", *seg.Z, "Cluster", "CustomerSegment"]
        whole = {r["CustomerID"]: r for r in chain.transform(f).select(*columns).collect()}
        some = loaded.transform(f.where("Frequency > 12")).select(*columns).collect()
        assert 0 < len(some) < len(whole) and all(r == whole[r["CustomerID"]] for r in some)


def test_forest_nodes_equal_the_model(spark, tmp_path):
    """Scores and importances from the node table are the forest's own, from a loaded chain too."""
    split = churn_split(spark, SF001)
    model = churn.fit_forest(split, num_trees=12, max_depth=5)
    path = scoring.save(scoring.forest_chain(model), str(tmp_path / "chain"))
    saved = str(tmp_path / "forest")
    model.write().overwrite().save(saved)
    nodes = forest.node_table(spark, saved)
    mine = {r["CustomerID"]: r["p"] for r in forest.score(split, nodes, churn.FEATURE_COLS, 5, "p").select("CustomerID", "p").collect()}
    for scored in (churn.forest_scores(split, model), scoring.load(path).transform(split).select(
            "CustomerID", vector_to_array("probability")[1].alias("ProbRaw"))):
        assert {r["CustomerID"]: r["ProbRaw"] for r in scored.collect()} == pytest.approx(mine, abs=1e-12)
    got = {r["Feature"]: r["Importance"] for r in forest.importances(nodes, churn.FEATURE_COLS).collect()}
    assert got == pytest.approx(dict(zip(churn.FEATURE_COLS, model.featureImportances.toArray())), abs=1e-9)


def test_split_takes_a_fifth_of_each_class(spark):
    for r in churn_split(spark, SF01).groupBy("Churn").agg({"IsTest": "count"}).collect():
        n = r["count(IsTest)"]
        test = churn_split(spark, SF01).where(f"IsTest AND Churn = {r['Churn']}").count()
        assert test == (2 * n * 20 + 100) // 200
