"""Sink layouts."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF001
from tillroll.sources import sinks
from tillroll.sources.csv_io import write_csv
from tillroll.sources.tables import transactions


def test_fact_table_layout_prunes_months(spark, tmp_path):
    p = str(tmp_path / "tx")
    sinks.write_transactions(transactions(spark, SF001), p)
    months = sorted(d for d in os.listdir(p) if d.startswith("TxMonth="))
    assert months and all(len(m) == len("TxMonth=1995-01") for m in months)
    df = spark.read.parquet(p).filter(F.col("TxMonth") == months[0][8:])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TxMonth" in plan
    assert df.count() == transactions(spark, SF001).filter(
        F.substring(F.col("TransactionDate").cast("string"), 1, 7) == months[0][8:]).count()


def test_json_document_and_texts(spark, tmp_path):
    doc = spark.createDataFrame([(1, "a")], "n long, s string").select(
        F.struct("n", "s").alias("section"), F.lit(2.5).alias("x"))
    sinks.write_json_document(doc, str(tmp_path / "doc"))
    text = spark.read.text(str(tmp_path / "doc")).first().value
    assert json.loads(text) == {"section": {"n": 1, "s": "a"}, "x": 2.5}
    texts = spark.createDataFrame([("vip", "hello"), ("other", "bye")], "slug string, body string")
    sinks.write_texts(texts, str(tmp_path / "t"), "slug", "body")
    assert sorted(os.listdir(tmp_path / "t"))[-2:] == ["slug=other", "slug=vip"]
    write_csv(texts, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert sorted(r.slug for r in back.collect()) == ["other", "vip"]


def test_fingerprint_follows_folder_content(spark, tmp_path):
    from tillroll.sources.stages import fingerprint
    d = tmp_path / "tbl"
    d.mkdir()
    (d / "a.parquet").write_bytes(b"x" * 10)
    first = fingerprint(spark, [str(d)])
    assert fingerprint(spark, [str(d)]) == first
    (d / "b.parquet").write_bytes(b"y" * 5)
    assert fingerprint(spark, [str(d)]) != first


def test_fact_files_are_in_order_and_few(spark, tmp_path):
    p = str(tmp_path / "tx")
    sinks.write_transactions(transactions(spark, SF001).repartition(6), p)
    checked = sinks.order_check(spark.read.parquet(p)).collect()
    assert checked and sum(r["OutOfOrder"] for r in checked) == 0
    files = [f for d, _, names in os.walk(p) for f in names if f.endswith(".parquet")]
    assert len(files) == len(checked)  # one small file a month, not one from every task
    broken = spark.read.parquet(p).orderBy(F.col("TransactionDate").desc()).coalesce(1)
    sinks.write_table(broken, str(tmp_path / "bad"))
    assert sum(r["OutOfOrder"] for r in sinks.order_check(spark.read.parquet(str(tmp_path / "bad"))).collect()) > 0


def test_fingerprint_notices_a_nested_rewrite(spark, tmp_path):
    from tillroll.sources.stages import fingerprint
    nested = tmp_path / "tbl" / "day=1"
    nested.mkdir(parents=True)
    (nested / "a.parquet").write_bytes(b"x" * 10)
    first = fingerprint(spark, [str(tmp_path / "tbl")])
    (nested / "a.parquet").write_bytes(b"y" * 10)
    os.utime(nested / "a.parquet", (1, 1_000_000_000))
    assert fingerprint(spark, [str(tmp_path / "tbl")]) != first


def test_order_check_sorts_narrow_rows(spark, tmp_path):
    """What is shuffled and sorted by file holds its number, not its path."""
    rows = spark.range(10).selectExpr("cast(id as string) CustomerID", "timestamp_ntz'2024-01-01 00:00:00' TransactionDate",
                                      "cast(1 as decimal(12,2)) Revenue", "'2024-01' TxMonth")
    rows.write.parquet(str(tmp_path / "t"))
    plan = sinks.order_check(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [" in line)
    below = plan.splitlines()[plan.splitlines().index(window) + 1]
    assert "Project" in below and "_path" not in below and "file_path" not in below
