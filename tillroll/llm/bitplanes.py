"""Centroid clustering on bit planes: exact distances by AND and popcount.

A vector of 64 integers in two's complement is b bit planes, and a plane's 64
bits (one a component) are one unsigned 64-bit word: 8 * b bytes a vector.
With w the weights of the planes (1, 2, 4, ..., the top one negative),

    x . c    = sum over planes i, j of w_i * w_j * popcount(x_i AND c_j)
    |x - c|^2 = x . x - 2 x . c + c . c

which is integer arithmetic throughout, so distances, ties and sums are exact.

Spark packs the vectors once into a table of planes.  A round reads that table;
each task keeps sums for k clusters (k * 64 integers, whatever its rows) and
hands on k rows, which one aggregate merges.  Only the k centroids, k * 64
integers bounded by the parameter, pass through the driver.  A cluster that
holds a third of all vectors is summed where they lie and adds one row a task.

Defined results: a vector that is null, has not 64 components, or has one that
is null, NaN or infinite is left out; a row with a null id is kept (it can't be
a start, and its id stays null); repeated rows count and come back as often as
they occur; of equal distances the smaller cluster number wins; fewer usable
vectors than k give as many clusters; an empty table gives no rows; other
columns are ignored whatever their names.  Components beyond 2^27 after scaling
are refused with an error, as 64-bit distances could not hold them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, table

DIMENSIONS = 64
MAX_COMPONENT = 1 << 27
BLOCK = 4096  # vectors whose distances to all centroids are held at once


def weights(bits: int) -> np.ndarray:
    """Plane weights of two's complement: 1, 2, 4, ... and the sign plane."""
    w = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def pack(vectors: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers as (n, bits) words; bit d of word i is bit i of component d."""
    planes = (vectors[:, None, :] >> np.arange(bits, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of all rows of two plane tables (n, bits) and (k, bits)."""
    w = weights(left.shape[1])
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for i, wi in enumerate(w):
        inner = np.zeros_like(total)
        for j, wj in enumerate(w):
            inner += wj * np.bitwise_count(left[:, i, None] & right[None, :, j])
        total += wi * inner
    return total


def norms(planes: np.ndarray) -> np.ndarray:
    """Squared lengths, from the planes of each row."""
    w = weights(planes.shape[1])
    shared = np.bitwise_count(planes[:, :, None] & planes[:, None, :]).astype(np.int64)
    return np.einsum("nij,i,j->n", shared, w, w)


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its nearest centroid (ties: the smaller number) and the squared distance."""
    own = norms(centroids)
    cluster, distance = (np.empty(len(planes), dtype=np.int64) for _ in range(2))
    for at in range(0, len(planes), BLOCK):
        block = planes[at:at + BLOCK]
        rest = own[None, :] - 2 * dots(block, centroids)
        best = rest.argmin(axis=1)
        cluster[at:at + BLOCK] = best
        distance[at:at + BLOCK] = norms(block) + rest[np.arange(len(block)), best]
    return cluster, distance


def cluster_sums(planes: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """(k, 64) component sums of each cluster's rows, from bit counts a plane."""
    bits = planes.shape[1]
    total = np.zeros((k, DIMENSIONS), dtype=np.int64)
    for at in range(0, len(planes), BLOCK):
        block = np.ascontiguousarray(planes[at:at + BLOCK])
        ones = np.unpackbits(block.view(np.uint8).reshape(len(block), bits, 8), axis=2, bitorder="little")
        member = np.zeros((k, len(block)), dtype=np.float32)
        member[cluster[at:at + BLOCK], np.arange(len(block))] = 1
        counts = (member @ ones.reshape(len(block), -1).astype(np.float32)).astype(np.int64)
        total += np.einsum("kbd,b->kd", counts.reshape(k, bits, DIMENSIONS), weights(bits))
    return total


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has 64 finite components, as (vec_id, vector of doubles)."""
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select("vec_id", F.col(vector).cast("array<double>").alias("vector"))
            .where(F.size("vector") == DIMENSIONS).where(F.coalesce(finite, F.lit(False))))


def _scaled(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * values).astype(np.int64)


def plane_count(kept: DataFrame, scale: int) -> int:
    """Planes that hold every component, from the extremes of the table (one row to the driver)."""
    low, high = kept.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    if low is None:
        return 1
    low, high = np.floor(scale * low), np.floor(scale * high)
    if max(-low, high) > MAX_COMPONENT:
        raise ValueError(f"a component times {scale} is beyond {MAX_COMPONENT}: distances would not fit in 64 bits")
    return max(int(high).bit_length(), (-int(low) - 1).bit_length() if low < 0 else 0) + 1


def plane_table(kept: DataFrame, bits: int, scale: int) -> DataFrame:
    """(vec_id, planes): the packed vectors."""
    def packed(batches):
        for batch in batches:
            vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            words = pack(_scaled(vectors, scale), bits).view(np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(words.ravel()), bits).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], ["vec_id", "planes"])

    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, planes array<bigint>"
    return kept.mapInArrow(packed, schema)


def start_centroids(kept: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The k vectors of smallest sha256 of ``seed:vec_id`` (ties: by components)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.where("vec_id IS NOT NULL").orderBy(order, "vector").limit(k).select("vector").collect()
    return _scaled(np.array([r["vector"] for r in first], dtype=np.float64).reshape(-1, DIMENSIONS), scale)


def _batch_planes(batch, bits: int) -> np.ndarray:
    return batch.column("planes").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, bits)


def lloyd_round(planes: DataFrame, centroids: np.ndarray, bits: int) -> np.ndarray:
    """One round: assign all rows, then floor(sum / count) by component; an empty cluster stays."""
    k, packed = len(centroids), pack(centroids, bits)

    def sums(batches):
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, DIMENSIONS), dtype=np.int64)
        for batch in batches:
            rows = _batch_planes(batch, bits)
            cluster, _ = nearest(rows, packed)
            count += np.bincount(cluster, minlength=k)
            total += cluster_sums(rows, cluster, k)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": held, "n": count[held], "sums": list(total[held])},
                                         pa.schema([("cluster", pa.int64()), ("n", pa.int64()),
                                                    ("sums", pa.list_(pa.int64()))]))

    partial = planes.mapInArrow(sums, "cluster bigint, n bigint, sums array<bigint>")
    whole = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*(F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(DIMENSIONS))).alias("sums"))
    moved = centroids.copy()
    for row in whole.collect():  # at most k rows
        moved[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
    return moved


def assign(planes: DataFrame, centroids: np.ndarray, bits: int) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""
    packed = pack(centroids, bits)

    def assigned(batches):
        for batch in batches:
            cluster, distance = nearest(_batch_planes(batch, bits), packed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"])

    schema = f"vec_id {planes.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint"
    return planes.mapInArrow(assigned, schema)


def cluster_vectors(vectors: DataFrame, k: int, rounds: int, seed: int = 0, scale: int = 256,
                    vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assignments (vec_id, cluster, distance) after ``rounds`` rounds, and the centroids."""
    kept = usable(vectors, vector)
    bits = plane_count(kept, scale)
    planes = materialize(plane_table(kept, bits, scale), "planes")
    centroids = start_centroids(kept, k, seed, scale)
    if not len(centroids):
        if planes.first() is not None:
            raise ValueError("no vector has an id, so there is nothing to start from")
        return planes.selectExpr("vec_id", "CAST(0 AS int) AS cluster", "CAST(0 AS bigint) AS distance"), centroids
    for _ in range(rounds):
        centroids = lloyd_round(planes, centroids, bits)
    return assign(planes, centroids, bits), centroids


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of all embeddings after five rounds, with exact distances and inertia."""
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2)
    found = materialize(found, "assigned")
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
               for i, c in enumerate(centroids)]
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = inertia.agg(F.sum("cluster_inertia")).first()[0]
    # one row a centroid: k rows, whatever the number of vectors
    facts = (spark.createDataFrame(digests, "cluster int, centroid_sha256 string").join(inertia, "cluster")
             .withColumn("inertia", F.lit(whole).cast("bigint")))
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql(k: int, rounds: int) -> str:
    """DuckDB SQL: the same rounds over (component, value) rows of the kept vectors."""
    out = [f"""WITH kept AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k}))"""]
    near = """a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min({{'d': d, 'k': cluster}}) AS best
  FROM (SELECT vec_id, v, cluster,
               list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)]) AS d
        FROM kept CROSS JOIN c{r})
  GROUP BY vec_id)"""
    step = """s{r} AS (
  SELECT best.k AS cluster, i, sum(v[i]) AS s, count(*) AS n
  FROM a{r} CROSS JOIN range(1, 65) AS t(i) GROUP BY ALL),
m{r} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY cluster),
c{n} AS MATERIALIZED (
  SELECT cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))"""
    for r in range(rounds):
        out += [near.format(r=r), step.format(r=r, n=r + 1)]
    out.append(near.format(r=rounds))
    return ",\n".join(out) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON cluster = best.k"""


OP11_SQL = _rounds_sql(40, 5)
