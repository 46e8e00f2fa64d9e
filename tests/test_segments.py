"""Segment labelling and k-means invariants."""

from pyspark.sql import functions as F

from tests.conftest import SF01
from tillroll.operators import segments as seg
from tillroll.operators.campaigns import slug


def _assigned(spark, rows):
    return spark.createDataFrame(rows, "CustomerID string, Cluster int, Recency long, Frequency long, Monetary double")


def test_composite_tie_goes_to_higher_monetary(spark):
    # cluster 0: best M, worst F; cluster 1: worst M, best F -> equal composite scores
    rows = [("a", 0, 10, 1, 100.0), ("b", 1, 10, 5, 50.0)]
    lab = {r.Cluster: r.CustomerSegment for r in seg.label_clusters(_assigned(spark, rows)).collect()}
    assert lab == {0: "High-Value VIPs", 1: "Loyal Regulars"}


def test_more_than_four_clusters(spark):
    rows = [(f"c{i}", i, i, 10 - i, 100.0 - i) for i in range(6)]
    names = sorted(r.CustomerSegment for r in seg.label_clusters(_assigned(spark, rows)).collect())
    assert names[-2:] == ["Segment 5", "Segment 6"]


def test_slug(spark):
    df = spark.createDataFrame([("At-Risk / Inactive",), ("High-Value VIPs",)], "s string")
    assert [r[0] for r in df.select(slug("s")).collect()] == ["at_risk__inactive", "high_value_vips"]


def test_kmeans_invariants(spark):
    from tillroll.plans.q_segments import kmeans_model
    from tillroll.sources.tables import customer_table
    f = customer_table(spark, SF01)
    out = seg.kmeans_segments(f, model=kmeans_model(spark, SF01))
    assert out.select("CustomerSegment").distinct().count() == 4
    assert out.count() == 1500
    total = f.agg(F.sum("Monetary")).first()[0]
    assert out.agg(F.sum("Monetary")).first()[0] == total
    again = seg.kmeans_segments(f, model=kmeans_model(spark, SF01))
    assert sorted(out.collect()) == sorted(again.collect())
