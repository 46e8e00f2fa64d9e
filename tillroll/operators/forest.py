"""Forests as tables of nodes.

A saved forest is flattened to one row a node: tree, node, feature, threshold,
children, gain and the class weights that reached it.  Scores are an expression
over that table: each customer row walks all trees inside the JVM, without the
model object.  The table is bounded by the settings (trees x 2^depth), not by
the customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = ("Tree int, Node int, Feature int, Threshold double, LeftNode int, RightNode int, "
               "Gain double, Weight0 double, Weight1 double")


def node_table(spark: SparkSession, saved: str) -> DataFrame:
    """The nodes of a two-class forest that MLlib's writer saved at ``saved``;
    a leaf has feature, children and gain -1."""
    stored = spark.read.parquet(f"{saved.rstrip('/')}/data")
    n = F.col("nodeData")
    threshold = F.when(n["split"]["featureIndex"] >= 0, n["split"]["leftCategoriesOrThreshold"][0]).otherwise(F.lit(0.0))
    return stored.select(
        F.col("treeID").alias("Tree"), n["id"].alias("Node"), n["split"]["featureIndex"].alias("Feature"),
        threshold.alias("Threshold"), n["leftChild"].alias("LeftNode"), n["rightChild"].alias("RightNode"),
        n["gain"].alias("Gain"), n["impurityStats"][0].alias("Weight0"), n["impurityStats"][1].alias("Weight1"))


def _trees(nodes: DataFrame) -> F.Column:
    """All trees as one array (by tree) of arrays (by node)."""
    row = F.struct("Node", "Feature", "Threshold", "LeftNode", "RightNode", "Weight0", "Weight1")
    trees = nodes.groupBy("Tree").agg(F.sort_array(F.collect_list(row)).alias("Nodes"))
    return trees.agg(F.transform(F.sort_array(F.collect_list(F.struct("Tree", "Nodes"))), lambda t: t["Nodes"])).scalar()


def score(customers: DataFrame, nodes: DataFrame, features: list[str], depth: int, out: str = "ProbRaw") -> DataFrame:
    """Probability of class 1: the mean over the trees of their leaf's class weights.

    Nodes are numbered from 0 (the root) without gaps in a tree; no tree is
    deeper than ``depth``.  At or below the threshold goes left.
    """
    x = F.array(*[F.col(c).cast("double") for c in features])

    def down(tree):
        def move(at, _):
            n = tree[at]
            return F.when(n["Feature"] < 0, at).when(F.get(F.col("_x"), n["Feature"]) <= n["Threshold"], n["LeftNode"]) \
                .otherwise(n["RightNode"])
        leaf = tree[F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), move)]
        whole = leaf["Weight0"] + leaf["Weight1"]
        return F.struct((leaf["Weight0"] / whole).alias("p0"), (leaf["Weight1"] / whole).alias("p1"))

    votes = F.aggregate(F.transform("_trees", down), F.struct(F.lit(0.0).alias("p0"), F.lit(0.0).alias("p1")),
                        lambda a, v: F.struct((a["p0"] + v["p0"]).alias("p0"), (a["p1"] + v["p1"]).alias("p1")))
    return (customers.withColumns({"_x": x, "_trees": _trees(nodes)}).withColumn("_v", votes)
            .withColumn(out, F.col("_v.p1") / (F.col("_v.p0") + F.col("_v.p1"))).drop("_x", "_trees", "_v"))


def importances(nodes: DataFrame, features: list[str]) -> DataFrame:
    """P10: gain times the weight that reached a split, summed by feature, as
    shares within each tree and then over the forest; unused features have 0."""
    weight = F.col("Weight0") + F.col("Weight1")
    split = nodes.where("Feature >= 0").groupBy("Tree", "Feature").agg(F.sum(F.col("Gain") * weight).alias("g"))
    whole = split.groupBy("Tree").agg(F.sum("g").alias("t"))  # one row a tree
    share = split.join(F.broadcast(whole), "Tree").where("t > 0").groupBy("Feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    total = share.agg(F.sum("s")).scalar()
    names = F.array(*[F.lit(f) for f in features])
    used = share.select(F.get(names, F.col("Feature")).alias("Feature"), (F.col("s") / total).alias("Importance"))
    every = nodes.sparkSession.createDataFrame([(f,) for f in features], "Feature string")
    return every.join(F.broadcast(used), "Feature", "left").select("Feature", F.coalesce("Importance", F.lit(0.0)).alias("Importance"))
