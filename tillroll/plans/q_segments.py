"""Segmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import scoring
from tillroll.operators import segments as seg
from tillroll.plans import sqlfrag as S
from tillroll.plans.registry import present, register
from tillroll.session import temporary_path
from tillroll.sources.stages import source_inputs, stage_model
from tillroll.sources.tables import customer_table, transactions
from tillroll.sources.tables import segment_table as segments_stage


def _features(spark, sf_dir):
    """The customer stage table (written once, read by every branch)."""
    return customer_table(spark, sf_dir)


def _z_sql(col: str, i: int) -> str:
    m, s = f"(SELECT m{i} FROM stats)", f"(SELECT s{i} FROM stats)"
    return (f"round(CASE WHEN {s} > 0 THEN (CAST({col} AS DOUBLE) - {m}) / {s} ELSE 0.0 END, "
            f"{seg.Z_DIGITS})")


SCALED_CTES = S.features_ctes() + [
    """stats AS (SELECT CAST(sum(Recency) AS DOUBLE) / count(Recency) AS m0,
                  CAST(sum(Frequency) AS DOUBLE) / count(Frequency) AS m1,
                  CAST(sum(Monetary) AS DOUBLE) / count(Monetary) AS m2,
                  stddev_pop(CAST(Recency AS DOUBLE)) AS s0,
                  stddev_pop(CAST(Frequency AS DOUBLE)) AS s1,
                  stddev_pop(CAST(Monetary AS DOUBLE)) AS s2 FROM features)""",
    f"""scaled AS (SELECT f.*, {_z_sql('Recency', 0)} AS zRecency, {_z_sql('Frequency', 1)} AS zFrequency,
                   {_z_sql('Monetary', 2)} AS zMonetary FROM features f)""",
]


def _dist(c) -> str:
    terms = [f"(({z} - ({v!r})) * ({z} - ({v!r})))" for z, v in zip(seg.Z, c)]
    return "(" + " + ".join(terms) + ")"


_D = [_dist(c) for c in seg.FIXED_CENTROIDS]
ASSIGN_CTE = f"""assigned AS (
  SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0
                 WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS Cluster
  FROM (SELECT *, {_D[0]} AS d0, {_D[1]} AS d1, {_D[2]} AS d2, {_D[3]} AS d3 FROM scaled))"""

_LABEL_LIST = "[" + ", ".join("'" + x + "'" for x in seg.LABELS) + "]"
LABEL_CTES = [
    """prof AS (SELECT Cluster, CAST(sum(Recency) AS DOUBLE) / count(Recency) AS MeanRecency,
                 CAST(sum(Frequency) AS DOUBLE) / count(Frequency) AS MeanFrequency,
                 CAST(sum(Monetary) AS DOUBLE) / count(Monetary) AS MeanMonetary
          FROM assigned GROUP BY Cluster)""",
    """ranked AS (SELECT *,
        rank() OVER (ORDER BY MeanMonetary) + (count(*) OVER (PARTITION BY MeanMonetary) - 1) / 2.0 AS MonetaryRank,
        rank() OVER (ORDER BY MeanFrequency) + (count(*) OVER (PARTITION BY MeanFrequency) - 1) / 2.0 AS FrequencyRank,
        rank() OVER (ORDER BY MeanRecency DESC) + (count(*) OVER (PARTITION BY MeanRecency) - 1) / 2.0 AS RecencyRank
      FROM prof)""",
    """prof_scored AS (SELECT *, CAST(MonetaryRank * 4 + FrequencyRank * 4 + RecencyRank * 2 AS BIGINT) AS score2
      FROM ranked)""",
    f"""labels AS (SELECT *, CASE WHEN SegmentOrder < {len(seg.LABELS)} THEN {_LABEL_LIST}[SegmentOrder + 1]
                              ELSE 'Segment ' || CAST(SegmentOrder + 1 AS VARCHAR) END AS CustomerSegment
      FROM (SELECT *, row_number() OVER (ORDER BY score2 DESC, MeanMonetary DESC, Cluster) - 1 AS SegmentOrder
            FROM prof_scored))""",
    """segments AS (SELECT a.*, l.CustomerSegment FROM assigned a JOIN labels l ON a.Cluster = l.Cluster)""",
]
SEGMENTS_CTES = SCALED_CTES + [ASSIGN_CTE] + LABEL_CTES


@register("rfm_scaled", S.with_ctes(*SCALED_CTES) + """
SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary,
       zRecency, zFrequency, zMonetary FROM scaled""")
def q_rfm_scaled(spark, sf_dir):
    """M1: standardised R, F, M."""
    return present(seg.standardise(_features(spark, sf_dir))
                   .select("CustomerID", "Recency", "Frequency", "Monetary", *seg.Z))


@register("nearest_centroid", S.with_ctes(*SCALED_CTES, ASSIGN_CTE) + """
SELECT CustomerID, CAST(Cluster AS BIGINT) AS Cluster FROM assigned""")
def q_nearest_centroid(spark, sf_dir):
    """M3: assignment to fixed centroids."""
    scaled = seg.standardise(_features(spark, sf_dir))
    return present(seg.assign(scaled, seg.FIXED_CENTROIDS).select("CustomerID", "Cluster"))


@register("lloyd_step", S.with_ctes(*SCALED_CTES, ASSIGN_CTE) + f"""
SELECT CAST(Cluster AS BIGINT) AS Cluster, count(*) AS Members,
       round(avg(zRecency), {seg.Z_DIGITS}) AS c_zRecency,
       round(avg(zFrequency), {seg.Z_DIGITS}) AS c_zFrequency,
       round(avg(zMonetary), {seg.Z_DIGITS}) AS c_zMonetary
FROM assigned GROUP BY Cluster""")
def q_lloyd_step(spark, sf_dir):
    """M4: one Lloyd iteration from the fixed centroids."""
    return present(seg.lloyd_step(seg.standardise(_features(spark, sf_dir)), seg.FIXED_CENTROIDS))


@register("segment_labels", S.with_ctes(*SCALED_CTES, ASSIGN_CTE, *LABEL_CTES[:4]) + """
SELECT CAST(Cluster AS BIGINT) AS Cluster, MeanRecency, MeanFrequency, MeanMonetary,
       CAST(MonetaryRank AS DOUBLE) AS MonetaryRank, CAST(FrequencyRank AS DOUBLE) AS FrequencyRank,
       CAST(RecencyRank AS DOUBLE) AS RecencyRank, CAST(score2 AS DOUBLE) / 10.0 AS CompositeScore,
       CAST(SegmentOrder AS BIGINT) AS SegmentOrder, CustomerSegment
FROM labels""")
def q_segment_labels(spark, sf_dir):
    """A18 + W2-W4 + M5: cluster profiles, average-tie ranks and labels."""
    scaled = seg.standardise(_features(spark, sf_dir))
    return present(seg.label_clusters(seg.assign(scaled, seg.FIXED_CENTROIDS)))


@register("segment_table", S.with_ctes(*SEGMENTS_CTES) + """
SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary,
       CAST(AvgOrderValue AS DOUBLE) AS AvgOrderValue, TotalProducts, UniqueCategories,
       PrimaryCategory, Country, CAST(Cluster AS BIGINT) AS Cluster, CustomerSegment
FROM segments""")
def q_segment_table(spark, sf_dir):
    """M6: customer segment table."""
    return present(segments_stage(spark, sf_dir))


@register("segment_breakdown", S.with_ctes(*SEGMENTS_CTES) + f"""
SELECT CustomerSegment, count(CustomerID) AS CustomerCount,
       CAST(sum(Monetary) AS DOUBLE) AS TotalSegmentRevenue,
       {S.money(S.div_half_up(S.cents('sum(Monetary)'), 'count(Monetary)'))} AS AvgSpendPerCustomer,
       CAST({S.div_half_up('sum(Recency) * 10', 'count(Recency)')} AS DOUBLE) / 10.0 AS AvgRecencyDays
FROM segments GROUP BY CustomerSegment""")
def q_segment_breakdown(spark, sf_dir):
    """Segment revenue contribution."""
    return present(seg.segment_breakdown(segments_stage(spark, sf_dir))
                   .orderBy(F.col("TotalSegmentRevenue").desc(), "CustomerSegment"))


@register("segment_matrix", S.with_ctes(*SEGMENTS_CTES) + """
SELECT CustomerSegment, count(CustomerID) AS CustomerCount,
       CAST(sum(Recency) AS DOUBLE) / count(Recency) AS AvgRecency,
       CAST(sum(Frequency) AS DOUBLE) / count(Frequency) AS AvgFrequency,
       CAST(sum(Monetary) AS DOUBLE) / count(Monetary) AS AvgMonetarySpend
FROM segments GROUP BY CustomerSegment""")
def q_segment_matrix(spark, sf_dir):
    """Segment matrix."""
    return present(seg.segment_matrix(segments_stage(spark, sf_dir)))


@register("segment_share", S.with_ctes(*SEGMENTS_CTES) + f"""
, c AS (SELECT CustomerSegment, count(*) AS CustomerCount FROM segments GROUP BY 1)
SELECT CustomerSegment, CustomerCount,
       CAST({S.div_half_up('CustomerCount * 10000', '(SELECT sum(CustomerCount) FROM c)')} AS DOUBLE) / 100.0 AS SharePct
FROM c""")
def q_segment_share(spark, sf_dir):
    """Segment share of customers."""
    return present(seg.segment_share(segments_stage(spark, sf_dir)))


@register("rfm_scatter", S.with_ctes(*SEGMENTS_CTES) + """
SELECT CustomerID, Recency, CAST(Monetary AS DOUBLE) AS Monetary, Frequency, CustomerSegment FROM segments""")
def q_rfm_scatter(spark, sf_dir):
    """RFM scatter feed."""
    return present(segments_stage(spark, sf_dir)
                   .select("CustomerID", "Recency", "Monetary", "Frequency", "CustomerSegment"))


def kmeans_model(spark, sf_dir, k: int = 4, seed: int = 42, restarts: int = 10):
    """The fitted segmentation chain, trained once per input version."""
    from pyspark.ml import PipelineModel
    f = _features(spark, sf_dir)
    return stage_model(spark, f"kmeans-k{k}-s{seed}-r{restarts}", source_inputs(sf_dir),
                       lambda: seg.fit_kmeans(f, k=k, seed=seed, restarts=restarts), PipelineModel)


@register("kmeans_segments")
def q_kmeans_segments(spark, sf_dir):
    """M2-M6 with the fitted centroids (10 restarts, lowest cost kept)."""
    return present(seg.kmeans_segments(_features(spark, sf_dir), model=kmeans_model(spark, sf_dir)))


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    """M7: elbow and silhouette over k = 2..8."""
    return seg.kmeans_sweep(_features(spark, sf_dir))


UNITS = f"""pts AS MATERIALIZED (
  SELECT Cluster, {', '.join(f'CAST(round({z} * 1e{seg.Z_DIGITS}) AS BIGINT) AS u{i}' for i, z in enumerate(seg.Z))}
  FROM assigned)"""
_STARTS = ", ".join(f"({j}, " + ", ".join(f"{v!r} * 1e{seg.Z_DIGITS}" for v in c) + ")"
                    for j, c in enumerate(seg.FIXED_CENTROIDS))


@register("kmeans_fixed_fit", S.with_ctes(*SCALED_CTES, ASSIGN_CTE, UNITS).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
fit AS (
  SELECT 0 AS step, j AS k, CAST(a AS DOUBLE) AS c0, CAST(b AS DOUBLE) AS c1, CAST(c AS DOUBLE) AS c2, true AS moved
  FROM (VALUES {_STARTS}) AS t(j, a, b, c)
  UNION ALL
  SELECT step + 1, k, n0, n1, n2, bool_or(n0 <> c0 OR n1 <> c1 OR n2 <> c2) OVER ()
  FROM (
    SELECT f.step, f.k, f.c0, f.c1, f.c2, coalesce(CAST(s0 AS DOUBLE) / n, f.c0) AS n0,
           coalesce(CAST(s1 AS DOUBLE) / n, f.c1) AS n1, coalesce(CAST(s2 AS DOUBLE) / n, f.c2) AS n2
    FROM fit f LEFT JOIN (
      SELECT best.j AS j, count(*) AS n, sum(u0) AS s0, sum(u1) AS s1, sum(u2) AS s2
      FROM (SELECT u0, u1, u2, (SELECT min({{'d': (u0 - g.c0) * (u0 - g.c0) + (u1 - g.c1) * (u1 - g.c1)
                                               + (u2 - g.c2) * (u2 - g.c2), 'j': g.k}}) FROM fit g) AS best FROM pts)
      GROUP BY best.j) m ON m.j = f.k
    WHERE f.moved))
SELECT CAST(k AS BIGINT) AS Cluster, CAST(step AS BIGINT) AS Steps, round(c0 / 1e{seg.Z_DIGITS}, {seg.Z_DIGITS}) AS c_zRecency,
       round(c1 / 1e{seg.Z_DIGITS}, {seg.Z_DIGITS}) AS c_zFrequency, round(c2 / 1e{seg.Z_DIGITS}, {seg.Z_DIGITS}) AS c_zMonetary
FROM fit WHERE step = (SELECT max(step) FROM fit)""")
def q_kmeans_fixed_fit(spark, sf_dir):
    """M2: a whole fit from the fixed starting centroids."""
    return seg.fixed_fit(_features(spark, sf_dir))


@register("fixed_silhouette", S.with_ctes(*SCALED_CTES, ASSIGN_CTE, UNITS) + """
, m AS (SELECT Cluster AS c, CAST(count(*) AS DOUBLE) AS n, CAST(sum(u0) AS DOUBLE) / 1e9 AS y0,
               CAST(sum(u1) AS DOUBLE) / 1e9 AS y1, CAST(sum(u2) AS DOUBLE) / 1e9 AS y2,
               CAST(sum(CAST(u0 AS HUGEINT) * u0 + CAST(u1 AS HUGEINT) * u1 + CAST(u2 AS HUGEINT) * u2) AS DOUBLE)
                 / 1e9 / 1e9 AS q FROM pts GROUP BY Cluster),
x AS (SELECT row_number() OVER () AS id, Cluster, u0 / 1e9 AS x0, u1 / 1e9 AS x1, u2 / 1e9 AS x2 FROM pts),
apart AS (
  SELECT id, Cluster, c, n, greatest(n * (x0 * x0 + x1 * x1 + x2 * x2) + q - 2.0 * (x0 * y0 + x1 * y1 + x2 * y2), 0.0) AS d
  FROM x CROSS JOIN m),
ab AS (
  SELECT id, max(CASE WHEN c = Cluster THEN n END) AS n, max(CASE WHEN c = Cluster AND n > 1 THEN d / (n - 1) END) AS a,
         min(CASE WHEN c <> Cluster THEN d / n END) AS b FROM apart GROUP BY id)
SELECT round(avg(CASE WHEN b IS NULL THEN NULL WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
         AS Silhouette FROM ab""")
def q_fixed_silhouette(spark, sf_dir):
    """M7: exact silhouette of the fixed-centroid clusters from cluster moments."""
    return seg.fixed_silhouette(_features(spark, sf_dir))


@register("scored_from_disk", S.with_ctes(*SEGMENTS_CTES) + """
SELECT CustomerID, zRecency, zFrequency, zMonetary, CAST(Cluster AS BIGINT) AS Cluster, CustomerSegment FROM segments""")
def q_scored_from_disk(spark, sf_dir):
    """The fixed-centroid chain saved, loaded, and every customer scored by it."""
    f = _features(spark, sf_dir)
    chain = scoring.load(scoring.save(scoring.segment_chain(f, seg.FIXED_CENTROIDS), temporary_path(spark)))
    return present(chain.transform(f).select("CustomerID", *seg.Z, "Cluster", "CustomerSegment"))


SLICE = ["High-Value VIPs", "Loyal Regulars"]


@register("segment_slice", S.with_ctes(*SEGMENTS_CTES) + """
SELECT CustomerID, CustomerSegment, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary
FROM segments WHERE CustomerSegment IN ('High-Value VIPs', 'Loyal Regulars')""")
def q_segment_slice(spark, sf_dir):
    """The segment slicer applied to the segment table."""
    from tillroll.operators.cleaning import segment_slice
    return present(segment_slice(segments_stage(spark, sf_dir), SLICE)
                   .select("CustomerID", "CustomerSegment", "Recency", "Frequency", "Monetary"))
