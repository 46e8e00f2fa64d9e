"""Queries with SQL equal DuckDB's rows; all queries and the pipeline are registered."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF001, SF01
from tests.oracle_harness import compare, duck_connection
from tillroll.llm import queries


def connection(sf):
    con = duck_connection(sf)
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, name):
    got = queries.QUERIES[name](spark, SF01).toPandas()
    want = connection(SF01).sql(queries.ORACLE[name]).df()
    assert [p for p in compare(got, want) if not p.startswith("dtype")] == []


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert set(queries.ORACLE) <= set(entry.oracle_sql()) and duckdb is not None


def test_pipeline_equals_its_stages(spark):
    """Each stage's rows follow from a plain reading of its operator's result."""
    from tillroll.llm.decontaminate import find_leaks
    from tillroll.llm.simhash_dedup import near_duplicates
    from tillroll.llm.toxicity import learn, score_documents, train_rows
    docs = spark.read.parquet(f"{SF001}/documents.parquet").cache()
    clean = corpus_pipeline.toxicity(spark, docs, SF001).cache()
    scores = score_documents(docs, learn(docs, train_rows(spark.read.parquet(f"{SF001}/labels.parquet"))))
    assert ids(clean) == sorted(r["doc_id"] for r in scores.where("predicted = 0").collect())
    lines = corpus_pipeline.line_dedup(spark, clean, SF001).cache()
    assert lines.columns == docs.columns and set(ids(lines)) <= set(ids(clean))
    assert lines.where("text IS NOT NULL AND n_chars <> length(text)").count() == 0
    one = corpus_pipeline.simhash_dedup(spark, lines, SF001).cache()
    groups = near_duplicates(lines).select("component_id").distinct()
    assert ids(one) == sorted(r[0] for r in groups.collect())
    kept = corpus_pipeline.decontaminate(spark, one, SF001).cache()
    leaks = find_leaks(one, spark.read.parquet(f"{SF001}/benchmark.parquet"))
    assert ids(kept) == sorted(set(ids(one)) - {r[0] for r in leaks.select("doc_id").collect()})
    mixed = corpus_pipeline.mixing(spark, kept, SF001)
    assert set(r["doc_id"] for r in mixed.collect()) <= set(ids(kept))
    whole = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, mixed.collect()), key=str)


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_take_odd_rows(spark):
    from tests.llm.helpers import empty, frame, odd_documents
    for rows in (odd_documents(), []):
        docs = frame(spark, rows) if rows else empty(spark)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, SF001)
            assert docs.columns == columns
        corpus_pipeline.mixing(spark, docs, SF001).count()
