import random

from tests.llm.helpers import everything_is_skewed, final_plan
from tillroll.llm.components import _large_star, _small_star, connected_components


def test_random_graph_and_long_path(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(5000, 6000 + i) for i in range(300)]
    edges += [(7, 7), (None, 3), (4, None), (1, 2), (2, 1)]
    root = {}

    def find(v):
        root.setdefault(v, v)
        while root[v] != v:
            v = root[v]
        return v
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()))
    assert got == {v: find(v) for v in root}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_a_hot_vertex_is_split(spark):
    edges = spark.createDataFrame([(1, 10 + i) for i in range(20_000)], "src bigint, dst bigint").repartition(8)
    with everything_is_skewed(spark):
        assert "skew=true" in final_plan(_large_star(edges))
        down = edges.selectExpr("100000 AS src", "dst")
        assert "skew=true" in final_plan(_small_star(down))
        assert {r["component"] for r in connected_components(edges).collect()} == {1}
