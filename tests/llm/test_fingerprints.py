import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.helpers import empty, frame, odd_documents
from tillroll.llm import fingerprints as P


def edited(rows):
    """(doc_id, text) in ring order -> edited texts."""
    out = []
    for i, (_, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        m = len(text) // 4
        out.append(text[:len(text) - m] + after[:m])
    return out


@pytest.fixture(scope="module")
def result(spark):
    return {r["doc_id"]: r for r in P.op10_document_fingerprints(spark, SF001).collect()}


def test_edited_texts(spark, result):
    rows = sorted((r[0], r[1] or "") for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    for (i, text), other in zip(rows, edited(rows)):
        assert result[i]["n_chars"] == len(text)
        assert result[i]["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()


def test_likeness_tells_edits_from_strangers(result):
    longer = [r for r in result.values() if r["n_chars"] > 200]
    assert sum(r["near_edited"] > r["near_next"] for r in longer) > 0.97 * len(longer)
    ids = sorted(result)
    for a, b in zip(ids, ids[1:] + ids[:1]):
        diff = int(result[a]["fingerprint"], 16) ^ int(result[b]["fingerprint"], 16)
        assert result[a]["near_next"] == 1 - diff.bit_count() / 64


def test_search_finds_all_within_the_radius(result):
    fps = {i: int(r["fingerprint"], 16) for i, r in result.items()}
    for i, r in result.items():
        want = sum((fps[i] ^ f).bit_count() <= P.RADIUS for f in fps.values()) - 1
        assert r["within_radius"] == (want if i % 50 == 0 else None)


def test_odd_rows(spark):
    rows = odd_documents()
    out = P.edited_fingerprints(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in rows)
    zero = [r for r in out if r["n_chars"] == 0]
    assert len(zero) == 3 and all(r["fingerprint"] == "0" * 16 and r["near_edited"] == 1.0 for r in zero)
    by_text = {}
    for r in out:
        if r["doc_id"] in (1, 2):
            by_text.setdefault(r["fingerprint"], []).append(r)
    assert len(by_text) == 1  # equal texts, equal fingerprints
    assert P.edited_fingerprints(empty(spark)).count() == 0
    one = P.edited_fingerprints(frame(spark, [(1, "only one document here", "en", "a", 1)])).first()
    assert one["near_next"] == 1.0


def test_tables_cover_the_radius():
    import random
    rng = random.Random(2)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), P.RADIUS))
        assert any(flips & (m % (1 << 64)) == 0 for m in P._tables())


def test_no_python_in_the_plan(spark):
    rows = frame(spark, odd_documents(), clashing=False).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    plan = P.simhash(rows, ["doc_id"], "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_simhash(text):
    """The fingerprint in plain Python: words with their followers, weighted by length, voting by Spark's xxHash64."""
    import re
    import xxhash
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower().strip(" \t\n\x0b\x0c\r")) if w]
    votes, total = [0] * 64, 0
    for a, b in zip(words, words[1:] + [None]):
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        if b is not None:
            h = xxhash.xxh64_intdigest(b.encode(), h)
        weight = min(64, len(a) + len(b or ""))
        total += weight
        votes = [v + weight * (h >> i & 1) for i, v in enumerate(votes)]
    return f"{sum(1 << i for i, v in enumerate(votes) if 2 * v > total):016x}"


def test_fingerprints_equal_plain_simhash(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = P.op10_document_fingerprints(spark, SF001).collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: plain_simhash(t) for i, t in texts.items()}


def test_copies_vote_once_and_full_counters_are_an_error(spark, monkeypatch):
    """Copies that together weigh more than a counter holds leave the fingerprint
    as it is; one group of such weight is refused."""
    monkeypatch.setattr(P, "MOST", 20_000)
    text = " ".join(f"word{i}" for i in range(400))
    one = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    many = one.select(F.explode(F.sequence(F.lit(1), F.lit(50))), "doc_id", "text").drop("col")
    alone, copied = (P.edited_fingerprints(df).select("fingerprint", "edited_fingerprint").collect() for df in (one, many))
    assert len(copied) == 50 and set(copied) == set(alone)
    with pytest.raises(Exception, match="2\\^31"):
        P.simhash(many, ["doc_id"], "text").collect()
