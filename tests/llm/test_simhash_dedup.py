import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.helpers import empty, everything_is_skewed, final_plan, frame, odd_documents, words
from tillroll.llm import simhash_dedup as S


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                found.append(word)
            word = ""
        else:
            word += c
    if not found:
        return 0
    terms = [" ".join(found[i:i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(t.encode(), 42) for t in terms]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return [(i, f"{f:016x}", low.get(find(f))) for (i, _), f in zip(rows, fps)]


def got(df):
    from tillroll.llm.common import hex16
    return Counter(map(tuple, df.select("doc_id", hex16(F.col("fp")), "component_id").collect()))


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, S.op2_simhash_dedup(spark, SF001).collect())) == Counter(brute_components(rows))


def test_odd_rows(spark):
    rows = odd_documents()
    found = S.near_duplicates(frame(spark, rows))
    assert got(found) == Counter(brute_components([r[:2] for r in rows]))
    assert S.near_duplicates(empty(spark)).count() == 0


def test_representatives_keep_columns(spark):
    rows = odd_documents()
    docs = frame(spark, rows)
    kept = S.keep_representatives(docs)
    assert kept.columns == docs.columns and S.keep_representatives(empty(spark)).count() == 0
    components = {c for _, _, c in brute_components([r[:2] for r in rows])}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(components)


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_position_sets_cover(radius):
    from itertools import combinations
    sets = S.position_sets(8 - radius)
    assert all(any(set(s) <= set(t) for s in sets) for t in combinations(range(8), 8 - radius))


@pytest.mark.parametrize("most", [64, 3])
def test_long_lists_give_the_same_components(spark, monkeypatch, most):
    """Clusters of fingerprints a few bits apart, with and without the way for long lists."""
    monkeypatch.setattr(S, "LIST_PAIRS", most)
    rng = random.Random(3)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            value = centre
            for bit in rng.sample(range(64), rng.randrange(5)):
                value ^= 1 << bit
            fps.add(value)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in fps]
    edges = S.fingerprint_edges(spark.createDataFrame(signed, "fp bigint"), 3)
    from tillroll.llm.components import connected_components
    labels = dict(map(tuple, connected_components(edges).collect()))
    unsigned = sorted(fps)
    root = {f: f for f in unsigned}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(unsigned):
        for b in unsigned[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    group = {}
    for v in unsigned:
        s = v - (1 << 64) if v >> 63 else v
        group.setdefault(find(v), set()).add(labels.get(s, s))
    assert all(len(g) == 1 for g in group.values())
    assert len({next(iter(g)) for g in group.values()}) == len(group)


def test_fingerprint_of_long_text():
    text = words(random.Random(5), 70_000)
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_a_long_posting_list_is_split(spark):
    lists = spark.createDataFrame([(3, 0 if i % 3 else i, i) for i in range(30_000)], "mask bigint, posting bigint, fp bigint").repartition(8)
    with everything_is_skewed(spark):
        counted = S._with_counts(lists)
        assert "skew=true" in final_plan(counted)
    got = counted.collect()
    assert len(got) == 20_001 and {r["n"] for r in got} == {20_001}
