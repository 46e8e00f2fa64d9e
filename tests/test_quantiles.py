"""Quantile sketches against exact ranks: hot values, a hot day, ties and nulls."""

import random

from pyspark.sql import functions as F

from tillroll.operators import sales


def _frame(spark, rows):
    typed = "d string, q int, p double, r double"
    return spark.createDataFrame(rows, typed).select(
        F.col("d").cast("timestamp_ntz").alias("TransactionDate"), F.col("q").alias("Quantity"),
        F.col("p").cast("decimal(10,2)").alias("UnitPrice"), F.col("r").cast("decimal(12,2)").alias("Revenue"))


def test_merged_days_keep_the_rank_error(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(30_000):  # a third of the rows on one day, a third with one price
        day = "2024-01-05" if rng.random() < 1 / 3 else f"2024-{rng.randrange(1, 4):02d}-{rng.randrange(1, 28):02d}"
        price = 9.99 if rng.random() < 1 / 3 else round(rng.paretovariate(1.2), 2)
        rows.append((f"{day} 10:00:00", rng.randrange(1, 50), min(price, 9e6), round(rng.gauss(0, 1e4), 2)))
    tx = _frame(spark, rows).repartition(16)
    mart = sales.daily_quantile_mart(tx)
    values = sales.numeric_values(tx)
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    for period in (F.lit("all"), F.substring(F.col("Date").cast("string"), 1, 7)):
        found = sales.merged_quantiles(mart, period, probs)
        inside = sales.quantiles_within_bound(values.select(period.alias("Period"), "Column", "v"), found, probs).collect()
        assert inside and all(r["WithinBound"] for r in inside)
    seen = {r[0] for r in values.where("Column = 'UnitPrice'").select("v").distinct().collect()}
    whole = {r["Column"]: r for r in sales.merged_quantiles(mart, F.lit("all"), probs).collect()}
    assert whole["UnitPrice"]["n"] == 30_000
    assert all(whole["UnitPrice"][f"e{i}"] in seen for i in range(5)) and whole["UnitPrice"]["e2"] is not None


def test_a_wrong_estimate_is_flagged(spark):
    tx = _frame(spark, [("2024-01-01 00:00:00", i, 1.0, 1.0) for i in range(1, 1_001)])
    values = sales.numeric_values(tx).select(F.lit("x").alias("Period"), "Column", "v").where("Column = 'Quantity'")
    for guess, want in ((500.0, True), (700.0, False), (100.0, False)):
        found = spark.createDataFrame([("x", "Quantity", 1_000, guess)], "Period string, Column string, n long, e0 double")
        assert [r["WithinBound"] for r in sales.quantiles_within_bound(values, found, (0.5,)).collect()] == [want]


def test_nulls_small_and_empty_days(spark):
    rows = [("2024-01-01 00:00:00", None, 2.0, 5.0), ("2024-01-01 00:00:00", 7, 2.0, None), ("2024-01-02 00:00:00", 7, 2.0, None)]
    found = {r["Column"]: r for r in sales.merged_quantiles(sales.daily_quantile_mart(_frame(spark, rows)), F.lit("all")).collect()}
    assert (found["Quantity"]["n"], found["Quantity"]["e1"]) == (2, 7.0)
    assert (found["UnitPrice"]["n"], found["UnitPrice"]["e0"]) == (3, 2.0)
    assert (found["Revenue"]["n"], found["Revenue"]["e2"]) == (1, 5.0)
    assert sales.merged_quantiles(sales.daily_quantile_mart(_frame(spark, rows).where("false")), F.lit("all")).count() == 0
