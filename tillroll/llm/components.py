"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is tied to the smallest vertex around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = materialize(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low")), "low")
    return (both.where("dst > src").join(low, "src")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    low = materialize(down.groupBy("src").agg(F.min("dst").alias("low")), "low")
    moved = down.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    own = low.select("src", F.col("low").alias("dst"))
    return moved.unionByName(own).where("src <> dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Label every vertex that has an edge with the smallest vertex it can reach.

    ``edges`` has two columns of one orderable type, ``src`` and ``dst``; order
    within a pair, repeats, nulls and loops do not matter (a null end or a loop
    is no edge).  Returns (vertex, component); an empty table gives no rows.
    Each round is one table in the shared folder, so lineage never grows and
    nothing but one counter row reaches the driver.  Rounds go on until the
    edge set no longer changes, which large-star and small-star reach in
    O(log^2 n) rounds.  A vertex with very many edges meets partial minima
    first; the minima are stored, so that the join behind them has a shuffle
    and no aggregate on either side, which adaptive execution can split.
    """
    edges = edges.select("src", "dst").where("src <> dst").distinct()
    edges = materialize(_small_star(edges), "edges")
    before = _signature(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("src").alias("vertex"), F.col("dst").alias("component"))
    roots = edges.select(F.col("dst").alias("vertex"), F.col("dst").alias("component")).distinct()
    return members.unionByName(roots)


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)
