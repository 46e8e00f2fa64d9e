"""Bit-plane distances, rounds and odd rows against plain integer arithmetic."""

import hashlib

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.helpers import CLASHING
from tillroll.llm import bitplanes as bp

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, k, rounds, seed):
    """The contract in loops over Python integers."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(col) // len(members) for col in zip(*members)]
    return sorted(((i, best(v)[1], best(v)[0]) for i, v in kept), key=str), centroids


@pytest.mark.parametrize("bits", [1, 2, 9, 20, 28])
def test_popcount_equals_integers(bits):
    rng = np.random.default_rng(bits)
    low, high = -(1 << (bits - 1)), 1 << (bits - 1)
    x, c = rng.integers(low, high, (50, 64)), rng.integers(low, high, (7, 64))
    x[0], c[0] = low, high - 1
    px, pc = bp.pack(x, bits), bp.pack(c, bits)
    assert px.shape == (50, bits) and px.dtype == np.uint64
    assert (bp.dots(px, pc) == x @ c.T).all() and (bp.norms(px) == (x * x).sum(1)).all()
    d = ((x[:, None, :] - c[None]) ** 2).sum(2)
    cluster, distance = bp.nearest(px, pc)
    assert (cluster == d.argmin(1)).all() and (distance == d.min(1)).all()
    sums = bp.cluster_sums(px, cluster, 7)
    assert all((sums[j] == x[cluster == j].sum(0)).all() for j in range(7))


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.1, 64).astype(np.float32).tolist()) for i in range(60)]
    rows += [rows[3], rows[3], (70, rows[4][1]), (None, rows[5][1])]  # repeats, an equal vector, no id
    rows += [(71, None), (72, []), (73, [0.5] * 63), (74, [0.5] * 65), (75, [None] + [0.1] * 63),
             (76, [float("nan")] + [0.1] * 63), (77, [float("-inf")] + [0.1] * 63), (78, [0.0] * 64)]
    return rows


def test_rounds_equal_plain_loops(spark):
    from pyspark.sql import functions as F
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in CLASHING})
    found, centroids = bp.cluster_vectors(df, k=6, rounds=4, seed=9)
    want, plain_centroids = plain(rows, 6, 4, 9)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert centroids.tolist() == plain_centroids


def test_few_empty_and_wide_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bp.cluster_vectors(empty, k=4, rounds=2)[0].collect() == []
    two = spark.createDataFrame([(1, [0.25] * 64), (2, [-0.25] * 64)], SCHEMA)
    found, centroids = bp.cluster_vectors(two, k=4, rounds=2)
    assert len(centroids) == 2 and {r["distance"] for r in found.collect()} == {0}
    wide = spark.createDataFrame([(1, [3e6] * 64)], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        bp.cluster_vectors(wide, k=1, rounds=1)


def test_hot_cluster_adds_one_row_a_task(spark):
    """Half of all rows equal: the merge still sees at most k rows a task."""
    rows = [(i, [0.5] * 64) for i in range(500)] + [(9000 + i, [float(i % 7) / 7] * 64) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found, _ = bp.cluster_vectors(df, k=5, rounds=3)
    want, _ = plain(rows, 5, 3, 0)
    assert sorted(map(tuple, found.collect()), key=str) == want


def test_query_columns(spark):
    out = bp.op11_centroid_clustering(spark, SF001)
    rows = out.collect()
    assert len(rows) == 500 and len({r["inertia"] for r in rows}) == 1
    assert sum(r["distance"] for r in rows) == rows[0]["inertia"]
    assert out.schema.simpleString() == ("struct<vec_id:bigint,cluster:int,distance:bigint,cluster_inertia:bigint,"
                                         "inertia:bigint,centroid_sha256:string>")
