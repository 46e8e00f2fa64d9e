"""K-means for many models in one scan a step, and its silhouette (M2, M7).

All restarts of all k are fitted together: one step assigns every customer in
every model that still moves and sums by (model, cluster) in a single
aggregate, so a sweep of 7 sizes with 10 seeds costs as many passes as its
slowest model has steps, not 70 fits.  Tasks hand on at most one row a cluster
and batch; the driver holds the centroids, bounded by the settings.

Standardised scores are whole numbers of 1e-9 (``Z_DIGITS``), so sums are exact
integers: the fit is the same for any layout of the rows and any order of the
tasks.  A bounded sample (the customers of smallest md5) gives the starts, drawn
by seed, and moves them first, so that few passes over all customers remain;
those go on until the centroids of all customers settle.

The silhouette needs no pairs: with N, Y and Q a cluster's count, sum of
vectors and sum of squared lengths, the squared distances of x to its members
add up to N |x|^2 - 2 x.Y + Q.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps after which a fit that still moves is an error, never a result.
STEP_LIMIT = 10_000
TOLERANCE = 1e-4
BLOCK = 2048
HALF = 22  # bits of the low part of a score when it is squared
MERGE_ROWS = 100_000  # partial sums that the driver may add up itself
SAMPLE = 4096  # customers that give and move the starts, whatever the table's size
_EXACT = "decimal(38,0)"


def points(scaled: DataFrame, columns: list[str], digits: int, key: str = "CustomerID") -> DataFrame:
    """(key, u0, u1, ...): the scores as whole numbers of 10^-digits."""
    return scaled.select(key, *[F.round(F.col(c) * 10 ** digits).cast("bigint").alias(f"u{i}")
                                for i, c in enumerate(columns)])


def hash_sample(pts: DataFrame, size: int, seed: int, key: str = "CustomerID") -> np.ndarray:
    """The ``size`` rows of smallest md5 of ``seed:key`` (top-k by partition, no sort of the table)."""
    axes = [c for c in pts.columns if c != key]
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary"))
    rows = pts.select(order.alias("h"), *axes).orderBy("h", *axes).limit(size).toArrow()
    return np.stack([rows.column(a).to_numpy() for a in axes], axis=1)


def hash_starts(sample: np.ndarray, k: int, seeds: list[int]) -> dict[int, np.ndarray]:
    """For every seed k distinct rows of the sample, drawn by the seed."""
    return {s: sample[np.random.default_rng(s).permutation(len(sample))[:k]].astype(float) for s in seeds}


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, added up axis by axis."""
    total = np.zeros((len(x), len(centroids)))
    for axis in range(x.shape[1]):
        apart = x[:, axis, None] - centroids[None, :, axis]
        total += apart * apart
    return total


def _sums(rows: np.ndarray, every: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """By place (a cluster of a model) of one assignment of ``rows``: count, exact sums by axis, and the
    sum of squared lengths in three parts of 2^(2 * HALF), 2^(HALF + 1) and 1, as a square may exceed 64 bits."""
    total = np.zeros((len(every), rows.shape[1] + 4), dtype=np.int64)
    for at in range(0, len(rows), BLOCK):
        block = rows[at:at + BLOCK]
        high, low = block >> HALF, block & ((1 << HALF) - 1)
        facts = np.column_stack([np.ones(len(block), dtype=np.int64), block, (high * high).sum(axis=1),
                                 (high * low).sum(axis=1), (low * low).sum(axis=1)])
        distance = _distances(block.astype(float), every)
        for lo, hi in zip(starts[:-1], starts[1:]):
            np.add.at(total, lo + distance[:, lo:hi].argmin(axis=1), facts)
    return total


def _places(models: dict) -> tuple[np.ndarray, np.ndarray]:
    """All centroids, and where each model's begin."""
    return np.concatenate(list(models.values())), np.concatenate([[0], np.cumsum([len(c) for c in models.values()])])


def _moved(models: dict, starts: np.ndarray, found: dict) -> dict:
    """Means by place; an empty cluster stays where it is."""
    out = {}
    for (m, before), lo in zip(models.items(), starts):
        out[m] = before.copy()
        for j in range(len(before)):
            if row := found.get(int(lo) + j):
                out[m][j] = [float(s) / row[0] for s in row[1:-3]]
    return out


def _scan(pts: DataFrame, axes: list[str], models: dict) -> dict:
    """The sums of ``_sums`` over all rows, by place.

    Every batch hands on one row a place that it met; while those of the whole
    table are few (by its partitions) the driver adds them up, else an aggregate does."""
    every, starts = _places(models)
    names = ["n", *axes, "q2", "q1", "q0"]

    def summed(batches):
        for batch in batches:
            total = _sums(np.stack([batch.column(a).to_numpy() for a in axes], axis=1), every, starts)
            held = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(held), *(pa.array(total[held, i]) for i in range(len(names)))],
                                             ["place", *names])

    partial = pts.select(*axes).mapInArrow(summed, "place bigint, " + ", ".join(f"{n} bigint" for n in names))
    if pts.rdd.getNumPartitions() * len(every) > MERGE_ROWS:
        partial = partial.groupBy("place").agg(*[F.sum(F.col(n).cast(_EXACT)).alias(n) for n in names])
    found: dict[int, list[int]] = {}
    for r in partial.collect():
        place, *sums = (int(v) for v in r)
        found[place] = [a + b for a, b in zip(found.get(place, [0] * len(names)), sums)]
    return found


def _step(pts: DataFrame, axes: list[str], models: dict) -> dict:
    """One assignment of all rows in all models, and the means of their clusters."""
    return _moved(models, _places(models)[1], _scan(pts, axes, models))


def warm(sample: np.ndarray, models: dict, unit: float, tolerance: float = TOLERANCE) -> dict:
    """Lloyd steps on a bounded sample alone: starts from which few passes over all rows remain."""
    moving, done = dict(models), {}
    for _ in range(STEP_LIMIT):
        every, starts = _places(moving)
        after = _moved(moving, starts, {i: t for i, t in enumerate(_sums(sample, every, starts).tolist()) if t[0]})
        settled = [m for m in moving if ((after[m] - moving[m]) ** 2).sum(axis=1).max() <= (tolerance * unit) ** 2]
        done |= {m: after[m] for m in settled}
        moving = {m: after[m] for m in moving if m not in done}
        if not moving:
            break
    return done | moving


def distinct(models: dict) -> dict:
    """Models less those whose centroids an earlier one has in another order: their steps would be the same."""
    seen, out = set(), {}
    for m, c in models.items():
        same = tuple(sorted(map(tuple, c.tolist())))
        if same not in seen:
            seen.add(same)
            out[m] = c
    return out


def fit(pts: DataFrame, starts: dict, unit: float, tolerance: float = TOLERANCE, key: str = "CustomerID") -> dict:
    """Lloyd steps for all models of ``starts`` (name: k x axes) until each one's
    centroids move no more than ``tolerance``; models that settled leave the scan.
    Returns name: (centroids, steps), in the units of ``pts``."""
    axes = [c for c in pts.columns if c != key]
    moving, done, steps = dict(starts), {}, 0
    while moving:
        if steps == STEP_LIMIT:
            raise RuntimeError(f"k-means did not converge in {STEP_LIMIT} steps: {sorted(map(str, moving))}")
        steps += 1
        after = _step(pts, axes, moving)
        for m in list(moving):
            if ((after[m] - moving[m]) ** 2).sum(axis=1).max() <= (tolerance * unit) ** 2:
                done[m] = (after[m], steps)
                del moving[m]
            else:
                moving[m] = after[m]
    return done


# ------------------------------------------------------------------ moments
def _squares(axes: list[str]) -> F.Column:
    return reduce(lambda a, b: a + b, [F.col(a).cast("decimal(19,0)") * F.col(a).cast("decimal(19,0)") for a in axes])


def moments(assigned: DataFrame, axes: list[str], by: list[str]) -> DataFrame:
    """Count N, exact sums and sum of squared lengths Q of every cluster."""
    return assigned.groupBy(*by).agg(
        F.count(F.lit(1)).alias("N"), *[F.sum(F.col(a).cast(_EXACT)).alias(a) for a in axes],
        F.sum(_squares(axes).cast(_EXACT)).alias("Q"))


def silhouette(assigned: DataFrame, axes: list[str], unit: float, cluster: str = "Cluster",
               by: list[str] | None = None) -> DataFrame:
    """Mean squared-distance silhouette of the rows (a lone member counts 0), in
    two aggregates: moments (one row a cluster, gathered into one array per
    group of ``by``) and the mean.  Null where a group has a single cluster."""
    by = by or []
    m = moments(assigned, axes, by + [cluster])
    packed = F.struct(F.col(cluster).alias("c"), F.col("N").cast("double").alias("n"),
                      *[(F.col(a).cast("double") / unit).alias(a) for a in axes],
                      (F.col("Q").cast("double") / unit / unit).alias("q"))
    clusters = m.groupBy(*by).agg(F.sort_array(F.collect_list(packed)).alias("_clusters"))
    if by:  # as many rows as models
        rows = assigned.join(F.broadcast(clusters), by)
    else:
        rows = assigned.withColumn("_clusters", clusters.select("_clusters").scalar())
    x = {a: F.col(a).cast("double") / unit for a in axes}
    square = reduce(lambda p, q: p + q, [x[a] * x[a] for a in axes])

    def apart(c):
        return c["n"] * square + c["q"] - 2.0 * reduce(lambda p, q: p + q, [x[a] * c[a] for a in axes])

    own = F.filter("_clusters", lambda c: c["c"] == F.col(cluster))[0]
    rows = rows.select(
        *by, own["n"].alias("n"), (F.greatest(apart(own), F.lit(0.0)) / F.greatest(own["n"] - 1, F.lit(1.0))).alias("a"),
        F.array_min(F.transform(F.filter("_clusters", lambda c: c["c"] != F.col(cluster)),
                                lambda c: F.greatest(apart(c), F.lit(0.0)) / c["n"])).alias("b"))
    top = F.greatest("a", "b")
    score = F.when(F.col("b").isNull(), F.lit(None)).when((F.col("n") == 1) | (top == 0), F.lit(0.0)) \
        .otherwise((F.col("b") - F.col("a")) / top)
    return rows.groupBy(*by).agg(F.round(F.avg(score), 6).alias("Silhouette"))


def costs(pts: DataFrame, models: dict, unit: float, key: str = "CustomerID") -> dict:
    """Training cost of each model (squared distances to its centroids) in one
    scan, from exact counts, sums and squares."""
    axes = [c for c in pts.columns if c != key]
    every, starts = _places(models)
    out = dict.fromkeys(models, 0.0)
    owner = [m for m, c in models.items() for _ in c]
    for place, (n, *y, q2, q1, q0) in _scan(pts, axes, models).items():
        c = every[place] / unit
        q = float(q2 * (1 << 2 * HALF) + q1 * (1 << HALF + 1) + q0) / unit / unit
        out[owner[place]] += q - 2 * float(c @ np.array([float(v) / unit for v in y])) + n * float(c @ c)
    return out
