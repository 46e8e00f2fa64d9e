"""RFM segmentation.

Scaling statistics are scalar subqueries over the customer table; centroids
(k of them) are inlined as literals, so assignment is a projection with no
join or shuffle.  Cluster profiles, ranks and labels work on k rows; the
k-row label table is the only broadcast and its size is k.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import cents_to_double, div_round, to_cents
from tillroll.operators import lloyd, scoring

RFM = ["Recency", "Frequency", "Monetary"]
Z = ["zRecency", "zFrequency", "zMonetary"]

# The business labels, best composite score first.
LABELS = ["High-Value VIPs", "Loyal Regulars", "Occasional Buyers", "At-Risk / Inactive"]

# Deterministic starting centroids in standardised (R, F, M) space, used by
# the SQL-checkable assignment and Lloyd step [our choice].
FIXED_CENTROIDS = [(-0.5, 1.0, 1.0), (-0.5, 0.0, 0.0), (0.5, -0.5, -0.5), (2.0, -1.0, -1.0)]

Z_DIGITS = 9


def scaling_statistics() -> F.Column:
    """Means and population deviations of R, F, M; each mean divides an exact sum once."""
    return F.struct(
        *[(F.sum(F.col(c)).cast("double") / F.count(c)).alias(f"m{i}") for i, c in enumerate(RFM)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(RFM)])


def standardise(features: DataFrame) -> DataFrame:
    """M1: z-scores with population std, rounded to 9 places.

    All six statistics come from one scalar subquery over the customer
    table; the rounding makes the scores independent of the accumulation
    order of the std.
    """
    stats = features.select(scaling_statistics()).scalar()
    out = features.withColumn("_stats", stats)  # one subquery, whatever reads it
    scores = {}
    for i, (c, z) in enumerate(zip(RFM, Z)):
        mean, sd = F.col(f"_stats.m{i}"), F.col(f"_stats.s{i}")
        x = F.col(c).cast("double")
        scores[z] = F.round(F.when(sd > 0, (x - mean) / sd).otherwise(F.lit(0.0)), Z_DIGITS)
    return out.withColumns(scores).drop("_stats")


def assign(scaled: DataFrame, centroids) -> DataFrame:
    """M3: nearest centroid (squared Euclidean), lowest id on ties."""
    cands = []
    for i, c in enumerate(centroids):
        d = None
        for z, cz in zip(Z, c):
            term = (F.col(z) - F.lit(float(cz))) * (F.col(z) - F.lit(float(cz)))
            d = term if d is None else d + term
        cands.append(F.struct(d.alias("d"), F.lit(i).alias("Cluster")))
    return scaled.withColumn("Cluster", F.array_min(F.array(*cands))["Cluster"])


def lloyd_step(scaled: DataFrame, centroids) -> DataFrame:
    """M4: one Lloyd iteration: assign, then the mean z-vector per cluster."""
    return (assign(scaled, centroids).groupBy("Cluster")
            .agg(F.count(F.lit(1)).alias("Members"),
                 *[F.round(F.avg(z), Z_DIGITS).alias(f"c_{z}") for z in Z]))


def cluster_profiles(assigned: DataFrame) -> DataFrame:
    """Unscaled mean R, F, M per cluster (k rows)."""
    return assigned.groupBy("Cluster").agg(
        *[(F.sum(F.col(c)).cast("double") / F.count(c)).alias(f"Mean{c}") for c in RFM])


def _avg_rank(col: str, ascending: bool) -> F.Column:
    # Average rank among ties = first rank + (peers - 1) / 2.  The window
    # runs over the k-row profile table only.
    order = F.col(col).asc() if ascending else F.col(col).desc()
    w = Window.orderBy(order)
    peers = F.count(F.lit(1)).over(Window.partitionBy(col))
    return F.rank().over(w) + (peers - 1) / 2.0


def label_clusters(assigned: DataFrame) -> DataFrame:
    """M5: business label per cluster from the composite rank score.

    Score = 0.4 rank(M asc) + 0.4 rank(F asc) + 0.2 rank(R desc), evaluated
    as the integer-weighted 2M + 2F + R (doubled ranks are integers) so that
    ties are exact; ties go to the higher mean Monetary, then lower cluster id.
    """
    prof = cluster_profiles(assigned)
    ranked = (prof.withColumn("MonetaryRank", _avg_rank("MeanMonetary", True))
                  .withColumn("FrequencyRank", _avg_rank("MeanFrequency", True))
                  .withColumn("RecencyRank", _avg_rank("MeanRecency", False)))
    score2 = ((F.col("MonetaryRank") * 4 + F.col("FrequencyRank") * 4 + F.col("RecencyRank") * 2)
              .cast("bigint"))
    ordered = ranked.withColumn("_score2", score2).withColumn(
        "SegmentOrder",
        F.row_number().over(Window.orderBy(F.col("_score2").desc(),
                                           F.col("MeanMonetary").desc(), F.col("Cluster"))) - 1)
    labels = F.array(*[F.lit(x) for x in LABELS])
    name = F.when(F.col("SegmentOrder") < len(LABELS), F.element_at(labels, F.col("SegmentOrder") + 1)) \
        .otherwise(F.concat(F.lit("Segment "), (F.col("SegmentOrder") + 1).cast("string")))
    return ordered.select(
        "Cluster", "MeanRecency", "MeanFrequency", "MeanMonetary", "MonetaryRank",
        "FrequencyRank", "RecencyRank", (F.col("_score2") / 10.0).alias("CompositeScore"),
        F.col("SegmentOrder").cast("bigint").alias("SegmentOrder"), name.alias("CustomerSegment"))


SEGMENT_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary", "AvgOrderValue",
                   "TotalProducts", "UniqueCategories", "PrimaryCategory", "Country",
                   "Cluster", "CustomerSegment"]


def attach_labels(assigned: DataFrame) -> DataFrame:
    """M6: customer segment table (labels table is k rows: broadcast)."""
    labels = label_clusters(assigned).select("Cluster", "CustomerSegment")
    return assigned.join(F.broadcast(labels), "Cluster").select(*SEGMENT_COLUMNS)


def fixed_segments(features: DataFrame) -> DataFrame:
    """Segments from the deterministic centroids (SQL-checkable path)."""
    return attach_labels(assign(standardise(features), FIXED_CENTROIDS))


def segment_breakdown(segments: DataFrame) -> DataFrame:
    """Count, revenue, average spend (2 dp) and recency (1 dp) per segment."""
    agg = segments.groupBy("CustomerSegment").agg(
        F.count("CustomerID").alias("CustomerCount"),
        F.sum("Monetary").alias("TotalSegmentRevenue"),
        F.count("Monetary").alias("_nm"),
        F.sum("Recency").alias("_sr"), F.count("Recency").alias("_nr"))
    return agg.select(
        "CustomerSegment", "CustomerCount", "TotalSegmentRevenue",
        cents_to_double(div_round(to_cents("TotalSegmentRevenue"), "_nm")).alias("AvgSpendPerCustomer"),
        (div_round(F.col("_sr") * 10, "_nr").cast("double") / 10.0).alias("AvgRecencyDays"))


def segment_matrix(segments: DataFrame) -> DataFrame:
    """Count and unrounded mean recency, frequency and spend per segment."""
    return segments.groupBy("CustomerSegment").agg(
        F.count("CustomerID").alias("CustomerCount"),
        (F.sum("Recency").cast("double") / F.count("Recency")).alias("AvgRecency"),
        (F.sum("Frequency").cast("double") / F.count("Frequency")).alias("AvgFrequency"),
        (F.sum("Monetary").cast("double") / F.count("Monetary")).alias("AvgMonetarySpend"))


def share_of(rows: DataFrame, column: str) -> DataFrame:
    """Customers per value of ``column`` and percent of all customers (2 dp);
    the window runs over one row per value."""
    agg = rows.groupBy(column).agg(F.count(F.lit(1)).alias("CustomerCount"))
    total = F.sum("CustomerCount").over(Window.partitionBy(F.lit(0)))
    return agg.withColumn("SharePct", div_round(F.col("CustomerCount") * 10000, total)
                          .cast("double") / 100.0)


def segment_share(segments: DataFrame) -> DataFrame:
    """Customers per segment and percent of all customers (2 dp)."""
    return share_of(segments, "CustomerSegment")


# ------------------------------------------------------------------- fits
UNIT = float(10 ** Z_DIGITS)
_AXES = ["u0", "u1", "u2"]


def _fits(scaled: DataFrame, ks: list[int], seed: int, restarts: int):
    """The points, and for each k the centroids of the restart with the lowest
    training cost (ties to the earliest seed).  All k and seeds share the scans."""
    pts = lloyd.points(scaled, Z, Z_DIGITS).persist()
    seeds = [seed + i for i in range(restarts)]
    sample = lloyd.hash_sample(pts, lloyd.SAMPLE, seed)
    drawn = lloyd.hash_starts(sample, max(ks), seeds)
    warm = lloyd.warm(sample, {(k, s): drawn[s][:k] for k in ks for s in seeds}, UNIT, tolerance=0.0)
    found = {m: c for m, (c, _) in lloyd.fit(pts, lloyd.distinct(dict(sorted(warm.items()))), UNIT).items()}
    cost = lloyd.costs(pts, found, UNIT)
    best = {k: min((m for m in found if m[0] == k), key=lambda m: (round(cost[m], 6), m[1])) for k in ks}
    return pts, {k: found[m] for k, m in best.items()}, {k: cost[m] for k, m in best.items()}


def _assigned(pts: DataFrame, centroids: dict) -> DataFrame:
    """(model, Cluster, u0, u1, u2): every point once for each model, lowest cluster on ties."""
    def distance(c):
        terms = [(F.col(a) - c[i]) * (F.col(a) - c[i]) for i, a in enumerate(_AXES)]
        return terms[0] + terms[1] + terms[2]

    models = F.array(*[F.struct(F.lit(m).alias("model"), F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in c])
                                .alias("c")) for m, c in centroids.items()])
    nearest = F.transform(models, lambda m: F.struct(
        m["model"].alias("model"), F.array_min(F.transform(m["c"], lambda c, j: F.struct(distance(c).alias("d"), j.alias("j"))))["j"]
        .alias("Cluster")))
    return pts.select(F.inline(nearest), *_AXES)


def fit_kmeans(features: DataFrame, k: int = 4, seed: int = 42, restarts: int = 10):
    """K-means with ``restarts`` hash-drawn starts, the lowest training
    cost kept, as one saved-ready chain of scaling, assignment and labels."""
    pts, centroids, _ = _fits(standardise(features), [k], seed, restarts)
    pts.unpersist()
    return scoring.segment_chain(features, (centroids[k] / UNIT).tolist())


def fixed_fit(features: DataFrame, centroids=FIXED_CENTROIDS) -> DataFrame:
    """M2 from given starts until no centroid moves: (Cluster, Steps, centroid in standardised space)."""
    pts = lloyd.points(standardise(features), Z, Z_DIGITS).persist()
    found, steps = lloyd.fit(pts, {"fixed": np.array(centroids) * UNIT}, UNIT, tolerance=0.0)["fixed"]
    pts.unpersist()
    rows = [(j, steps, *(round(float(v) / UNIT, Z_DIGITS) for v in c)) for j, c in enumerate(found)]
    return features.sparkSession.createDataFrame(
        rows, "Cluster long, Steps long, c_zRecency double, c_zFrequency double, c_zMonetary double")


def kmeans_segments(features: DataFrame, model=None, **settings) -> DataFrame:
    """M2 + M3 + M5 + M6: fitted segmentation of every customer, by a saved chain or a new fit."""
    return (model or fit_kmeans(features, **settings)).transform(features).select(*SEGMENT_COLUMNS)


def fixed_silhouette(features: DataFrame) -> DataFrame:
    """M7 for the fixed-centroid clusters."""
    assigned = assign(standardise(features), FIXED_CENTROIDS)
    return lloyd.silhouette(lloyd.points(assigned, Z, Z_DIGITS, "Cluster"), _AXES, UNIT)


def kmeans_sweep(features: DataFrame, ks=range(2, 9), seed: int = 42, restarts: int = 10) -> DataFrame:
    """M7: elbow (training cost) and silhouette for each k, with the restarts
    and settings of ``fit_kmeans``: at the same k it is the same model."""
    pts, centroids, cost = _fits(standardise(features), list(ks), seed, restarts)
    rows = features.sparkSession.createDataFrame([(k, float(cost[k])) for k in ks], "model int, TrainingCost double")
    score = lloyd.silhouette(_assigned(pts, centroids), _AXES, UNIT, by=["model"])
    return rows.join(F.broadcast(score), "model").select(F.col("model").cast("long").alias("k"), "TrainingCost", "Silhouette")
