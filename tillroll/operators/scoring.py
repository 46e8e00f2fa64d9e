"""Saved scoring chains (S10): everything that a fit learned, in one ``PipelineModel``.

A chain holds its statistics, centroids and labels as constants, so a customer
is scored from the saved chain alone: without the training table, one row or a
billion at a time, with the result it had among the customers of the fit.
Stages are ``SQLTransformer`` projections, the assembler and the forest, all of
which MLlib's own writer and reader keep.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame


def _number(x: float) -> str:
    return f"{float(x)!r}D"


def scaler(features: DataFrame) -> SQLTransformer:
    """M1 with the statistics of ``features`` as constants (one row to the driver)."""
    from tillroll.operators.segments import RFM, Z, Z_DIGITS, scaling_statistics
    stats = features.select(scaling_statistics().alias("s")).first()["s"]
    exprs = []
    for i, (c, z) in enumerate(zip(RFM, Z)):
        mean, sd = stats[f"m{i}"], stats[f"s{i}"]
        score = f"(CAST({c} AS DOUBLE) - {_number(mean)}) / {_number(sd)}" if sd and sd > 0 else "0.0D"
        exprs.append(f"round({score}, {Z_DIGITS}) AS {z}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def assigner(centroids) -> SQLTransformer:
    """M3 with the centroids as constants; ties go to the lowest cluster."""
    from tillroll.operators.segments import Z
    near = []
    for i, c in enumerate(centroids):
        d = " + ".join(f"({z} - {_number(v)}) * ({z} - {_number(v)})" for z, v in zip(Z, c))
        near.append(f"named_struct('d', {d}, 'Cluster', {i})")
    return SQLTransformer(statement=f"SELECT *, array_min(array({', '.join(near)})).Cluster AS Cluster FROM __THIS__")


def labeller(names: dict[int, str]) -> SQLTransformer:
    """M5: the label each cluster got at the fit."""
    cases = " ".join(f"WHEN {int(c)} THEN '{n}'" for c, n in sorted(names.items()))
    return SQLTransformer(statement=f"SELECT *, CASE Cluster {cases} END AS CustomerSegment FROM __THIS__")


def segment_chain(features: DataFrame, centroids) -> PipelineModel:
    """Scaling, assignment and labels of the customers of ``features`` as one model.
    A cluster without a customer at the fit takes the place after the labelled ones."""
    from tillroll.operators.segments import label_clusters
    scale, near = scaler(features), assigner(centroids)
    labels = label_clusters(near.transform(scale.transform(features))).select("Cluster", "CustomerSegment").collect()
    names = {r["Cluster"]: r["CustomerSegment"] for r in labels}  # one row a cluster
    for c in range(len(centroids)):
        names.setdefault(c, f"Segment {len(names) + 1}")
    return PipelineModel([scale, near, labeller(names)])


def forest_chain(model) -> PipelineModel:
    """Feature vector and forest as one model (probability and prediction columns)."""
    from tillroll.operators.churn import FEATURE_COLS
    cast = ", ".join(f"CAST({c} AS DOUBLE) AS f_{c}" for c in FEATURE_COLS)
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"),
                          VectorAssembler(inputCols=[f"f_{c}" for c in FEATURE_COLS], outputCol="features"), model])


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
