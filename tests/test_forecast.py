"""Dense series, moving average, Holt-Winters and ridge on small frames."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import forecast as fc
from tillroll.operators import sales

SCHEMA = "TransactionID string, CustomerID string, Quantity int, Revenue decimal(12,2), TransactionDate timestamp_ntz"


def _tx(spark, values, start=dt.datetime(2024, 1, 1)):
    rows = [(str(i), "c", 1, Decimal(str(v)), start + dt.timedelta(days=d)) for i, (d, v) in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def test_gap_day_dense_vs_sql(spark):
    tx = _tx(spark, [(0, 10), (1, 20), (3, 40)])
    dense = {r.Date.day: float(r.ActualRevenue) for r in sales.dense_daily(tx).collect()}
    assert dense == {1: 10.0, 2: 20.0, 3: 0.0, 4: 40.0}
    assert sales.daily_sales(tx).count() == 3


def test_short_frame_moving_average(spark):
    tx = _tx(spark, [(0, 10), (1, 20), (2, 40)])
    got = {r.SalesDate.day: r.MovingAvg7DayRevenue for r in sales.daily_sales_ma7(tx).collect()}
    assert got == {1: 10.0, 2: 15.0, 3: 23.33}


def _hw_python(ys, a, b, g):
    lvl = sum(ys[:7]) / 7.0
    trend, s, sse, sr = 0.0, [y - lvl for y in ys[:7]], 0.0, 0.0
    for y in ys[7:]:
        s0, lb = s[0], lvl + trend
        f = lb + s0
        new_l = a * (y - s0) + (1.0 - a) * lb
        trend = b * (new_l - lvl) + (1.0 - b) * trend
        s = s[1:] + [g * (y - lb) + (1.0 - g) * s0]
        sse += (y - f) * (y - f)
        sr += y - f
        lvl = new_l
    return lvl, trend, s, sse


def test_holt_winters_fold_matches_python(spark):
    ys = [100 + 10 * (i % 7) + 0.5 * i + (i * 37 % 11) for i in range(60)]
    tx = _tx(spark, list(enumerate(ys)))
    st = fc.holt_winters(fc.series_arrays(sales.dense_daily(tx), [])).first()
    lvl, trend, s, sse = _hw_python([float(Decimal(str(y))) for y in ys], 0.3, 0.1, 0.2)
    assert (st.Level, st.Trend, list(st.Seasonals), st.SSE) == (lvl, trend, s, sse)


def test_short_horizon_prefix_and_clipping(spark):
    ys = [1000 - 40 * i for i in range(30)]
    tx = _tx(spark, list(enumerate(ys)))
    arrays = fc.series_arrays(sales.dense_daily(tx), [])
    st = fc.holt_winters(arrays)
    h3 = [r.PredictedRevenue for r in fc.project(st, [], 3).orderBy("h").collect()]
    h30 = fc.project(st, [], 30).orderBy("h").collect()
    assert h3 == [r.PredictedRevenue for r in h30[:3]]
    assert min(r.LowerBound for r in h30) == 0.0
    assert min(r.PredictedRevenue for r in h30) < 0  # the prediction itself is not clipped


def test_previous_period_zero(spark):
    tx = _tx(spark, [(d, 0) for d in range(40)])
    s = fc.holt_winters_forecast(tx, fit="fixed")["summary"].first()
    assert s.ProjectedChangePct == 0.0


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    n = 120
    ys = [round(500 + 2 * i + 30 * ((i % 7) == 5) + float(rng.normal(0, 20)), 2) for i in range(n)]
    tx = _tx(spark, list(enumerate(ys)))
    got = fc.ridge_forecast(tx, horizon=7).orderBy("h").collect()
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(n)]

    def design(d):
        return [float((d - start).days)] + [1.0 if d.weekday() == k else 0.0 for k in range(1, 7)]

    x = np.array([design(d) for d in days])
    y = np.array([float(Decimal(str(v))) for v in ys])
    xm, ym = x.mean(axis=0), y.mean()
    w = np.linalg.solve((x - xm).T @ (x - xm) + np.eye(7), (x - xm).T @ (y - ym))
    b = ym - xm @ w
    resid = y - (x @ w + b)
    sigma = np.std(resid)
    assert got[0].Coef == pytest.approx(list(w), rel=1e-9)
    assert got[0].Sigma == pytest.approx(sigma, rel=1e-9)
    fut = days[-1] + dt.timedelta(days=1)
    assert got[0].PredictedRevenue == pytest.approx(round(float(np.dot(design(fut), w) + b), 2), abs=0.011)


def test_forecast_entry_point(spark):
    tx = _tx(spark, [(d, 100 + d % 7 * 10) for d in range(60)])
    for method in ("holt_winters", "holt_winters_fixed", "trend_dow"):
        rows = fc.forecast(tx, horizon=5, method=method).collect()
        assert [r.h for r in sorted(rows, key=lambda r: r.h)] == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        fc.forecast(tx, method="prophet")


def test_parents_equal_the_sum_of_their_children(spark):
    """On every day: total = categories = countries, category = its countries; one shuffle of days per aggregate."""
    from decimal import Decimal

    from tests.conftest import SF001
    from tillroll.operators import forecast as fc
    from tillroll.sources.tables import transactions
    days = fc.level_days(transactions(spark, SF001))
    sums, by_pair = {}, {}
    for r in days.collect():
        sums.setdefault(r["LevelName"], {}).setdefault(r["Date"], Decimal(0))
        sums[r["LevelName"]][r["Date"]] += r["ActualRevenue"]
        parent = r["Series"].split(" / ")[0] if r["LevelName"] == "category x country" else None
        key = (parent or (r["Series"] if r["LevelName"] == "category" else None), r["Date"])
        if key[0]:
            by_pair.setdefault(r["LevelName"], {}).setdefault(key, Decimal(0))
            by_pair[r["LevelName"]][key] += r["ActualRevenue"]
    assert len(sums) == 4 and all(s == sums["total"] for s in sums.values())
    assert by_pair["category"] == by_pair["category x country"]


def test_dense_arrays_equal_the_calendar(spark):
    from tests.conftest import SF001
    from tillroll.operators import forecast as fc
    from tillroll.operators.sales import dense_daily
    from tillroll.sources.tables import transactions
    tx = transactions(spark, SF001)
    want = fc.series_arrays(dense_daily(tx, ["Country"]), ["Country"]).select("Country", "FirstDate", "LastDate", "ys").collect()
    days = fc.level_days(tx, {"country": ["Country"]})
    got = fc.dense_arrays(days, ["Series"]).select("Series", "FirstDate", "LastDate", "ys").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_fitted_values_are_linear_and_equal_one_fold(spark):
    """Blocks give the forecasts of a plain recursion; ten times the days cost about ten times the work."""
    import random
    import time

    from pyspark.sql import functions as F

    from tillroll.operators import forecast as fc

    def series(n):
        rng = random.Random(n)
        return spark.createDataFrame([(1, [rng.uniform(0, 9) for _ in range(n)])], "k int, ys array<double>").withColumn(
            "FirstDate", F.lit("2020-01-01").cast("date"))

    for n in (3, 7, 8, 300):
        ys = series(n).first()["ys"]
        a, b, g = fc.FIXED_PARAMS
        level, trend = sum(ys[:7]) / len(ys[:7]), 0.0
        season, want = [y - level for y in ys[:7]], []
        for y in ys[7:]:
            s, base = season[0], level + trend
            want.append(base + s)
            new = a * (y - s) + (1 - a) * base
            trend = b * (new - level) + (1 - b) * trend
            season, level = season[1:] + [g * (y - base) + (1 - g) * s], new
        got = [r["p"] for r in fc.fitted_values(series(n), ["k"]).orderBy("t").collect()]
        assert got == want
    took = {}
    for n in (2_000, 2_000, 20_000):
        df = series(n).cache()
        df.count()
        started = time.perf_counter()
        assert fc.fitted_values(df, ["k"]).agg(F.count("*")).first()[0] == n - 7
        took[n] = time.perf_counter() - started
    assert took[20_000] < 15 * took[2_000] + 2
