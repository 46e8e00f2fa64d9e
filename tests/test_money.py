"""Exact rounding helpers against Python's decimal module."""

import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tillroll.functions.money import div_round, round_money_avg


def _py(num, den, mode):
    q = Decimal(num) / Decimal(den)
    return int(q.quantize(Decimal(1), rounding=ROUND_HALF_UP if mode == "half_up" else ROUND_HALF_EVEN))


def test_half_cent_ties(spark):
    # 388.245 * 36 = 13976.82 (an exact half-cent tie); 12015.72 / 24 = 500.655
    df = spark.createDataFrame([("a", "13976.82", 36), ("b", "12015.72", 24)], "k string, m string, n long")
    df = df.withColumn("m", F.col("m").cast("decimal(12,2)"))
    out = {r.k: (r.even, r.up) for r in df.select(
        "k", round_money_avg("m", "n", "half_even").alias("even"),
        round_money_avg("m", "n", "half_up").alias("up")).collect()}
    assert out["a"] == (388.24, 388.25)
    assert out["b"] == (500.66, 500.66)


def test_div_round_random(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(-10 ** 9, 10 ** 9), rnd.randint(1, 1000)) for _ in range(400)]
    rows += [(2 * k + 1, 2) for k in range(-5, 6)] + [(5, 10), (15, 10), (-25, 10)]
    df = spark.createDataFrame(rows, "num long, den long")
    got = df.select("num", "den", div_round("num", "den", "half_up").alias("u"),
                    div_round("num", "den", "half_even").alias("e")).collect()
    for r in got:
        assert r.u == _py(r.num, r.den, "half_up"), r
        assert r.e == _py(r.num, r.den, "half_even"), r
