"""Revenue forecasting for many series at once (FC1-FC11, J2-J3, U1, A25-A26).

A series is the dense daily revenue of one key combination (the global
series has no key).  Per series the days are gathered into one ordered
array, whose length is bounded by the calendar span, not by data volume;
Holt-Winters is a left fold over it with Spark's ``aggregate`` higher-order
function, so it stays in the JVM.  Parameter search expands each series into
grid rows with ``explode`` (no join) and keeps the lowest SSE per series.
The trend + day-of-week ridge model is solved from per-series normal
equations accumulated by an ordinary partial aggregate.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import dates
from tillroll.functions.money import div_round, np_round, to_cents
from tillroll.operators.sales import dense_daily

PERIOD = 7
HORIZON = 30
Z95 = 1.96
# Fixed parameters of the SQL-checked single fit, and the search grid.
FIXED_PARAMS = (0.3, 0.1, 0.2)
ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
BETAS = (0.01, 0.05, 0.1, 0.2)
GAMMAS = (0.05, 0.1, 0.3)
GRID = list(itertools.product(ALPHAS, BETAS, GAMMAS))


def series_arrays(dense: DataFrame, keys: list[str]) -> DataFrame:
    """One row per series: first/last date and the day-ordered values."""
    return (dense.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("Date", F.col("ActualRevenue").cast("double")
                                                      .alias("y")))).alias("_pts"),
                 F.min("Date").alias("FirstDate"), F.max("Date").alias("LastDate"))
            .select(*keys, "FirstDate", "LastDate",
                    F.transform("_pts", lambda p: p["y"]).alias("ys")))


def _start(ys) -> F.Column:
    """The state after the first PERIOD days: level, trend, seasonals, no errors yet."""
    head = F.slice(ys, 1, PERIOD)
    level0 = F.aggregate(head, F.lit(0.0), lambda acc, y: acc + y) / F.size(head).cast("double")
    fields = [level0.alias("l"), F.lit(0.0).alias("b")]
    fields += [F.coalesce(F.try_element_at(head, F.lit(i + 1)) - level0, F.lit(0.0)).alias(f"s{i}")
               for i in range(PERIOD)]
    return F.struct(*fields, F.lit(0.0).alias("sse"), F.lit(0.0).alias("sr"))


def _rest(ys) -> F.Column:
    return F.when(F.size(ys) > PERIOD, F.slice(ys, PERIOD + 1, 1 << 30)).otherwise(F.array().cast("array<double>"))


def _move(alpha, beta, gamma):
    """One day of the recursion: (state, value) to (state, one-step forecast)."""
    one_a, one_b, one_g = F.lit(1.0) - alpha, F.lit(1.0) - beta, F.lit(1.0) - gamma

    def step(st, y):
        s0 = st["s0"]
        lb = st["l"] + st["b"]
        f = lb + s0
        lvl = alpha * (y - s0) + one_a * lb
        out = [lvl.alias("l"), (beta * (lvl - st["l"]) + one_b * st["b"]).alias("b")]
        out += [st[f"s{i + 1}"].alias(f"s{i}") for i in range(PERIOD - 1)]
        out += [(gamma * (y - lb) + one_g * s0).alias(f"s{PERIOD - 1}"),
                (st["sse"] + (y - f) * (y - f)).alias("sse"),
                (st["sr"] + (y - f)).alias("sr")]
        return out, f

    return step


def _fold(ys, alpha, beta, gamma) -> F.Column:
    """FC2: the state after all days of ``ys``."""
    step = _move(alpha, beta, gamma)
    return F.aggregate(_rest(ys), _start(ys), lambda st, y: F.struct(*step(st, y)[0]))


#: Days of a block of fitted values.
FIT_BLOCK = 128


def fitted_values(arrays: DataFrame, keys: list[str], params=FIXED_PARAMS) -> DataFrame:
    """FC8: (keys, FirstDate, t, p): the one-step forecast of day t (from 0, after the start-up days).

    A first fold keeps the state at the start of every block; then each block,
    a row of its own, is folded once more from there and lists its forecasts.
    Only arrays of a block's length are appended to, so the time is linear in
    the days, and the blocks of one long series spread over the tasks.
    """
    step = _move(*(F.lit(float(x)) for x in params))
    rest, n = _rest(F.col("ys")), FIT_BLOCK
    cuts = F.when(F.size(rest) > 0, F.sequence(F.lit(1), F.size(rest), F.lit(n))).otherwise(F.array().cast("array<int>"))
    with_blocks = arrays.select(*keys, "FirstDate", "ys", F.transform(cuts, lambda i: F.slice(rest, i, F.lit(n))).alias("_blocks"))
    start = _start(F.col("ys"))
    walk = F.aggregate(
        "_blocks", F.struct(start.alias("s"), F.slice(F.array(start), 1, 0).alias("at")),
        lambda acc, block: F.struct(
            F.aggregate(block, acc["s"], lambda st, y: F.struct(*step(st, y)[0])).alias("s"),
            F.concat(acc["at"], F.array(acc["s"])).alias("at")))
    blocks = with_blocks.select(*keys, "FirstDate", F.posexplode(F.arrays_zip(F.col("_blocks").alias("ys"), walk["at"].alias("st")))
                                .alias("_block", "_z"))

    def listed(acc, y):
        out, f = step(acc["st"], y)
        return F.struct(F.struct(*out).alias("st"), F.concat(acc["fit"], F.array(f)).alias("fit"))

    fit = F.aggregate(F.col("_z.ys"), F.struct(F.col("_z.st").alias("st"), F.array().cast("array<double>").alias("fit")), listed)["fit"]
    return blocks.select(*keys, "FirstDate", "_block", F.posexplode(fit).alias("_i", "p")).select(
        *keys, "FirstDate", (F.col("_block") * n + F.col("_i")).alias("t"), "p")


def _with_state(arrays: DataFrame, alpha, beta, gamma) -> DataFrame:
    st = _fold(F.col("ys"), alpha, beta, gamma)
    out = arrays.withColumn("_st", st)
    residuals = F.greatest(F.size("ys") - PERIOD, F.lit(0))
    m = F.nullif(residuals.cast("double"), F.lit(0.0))
    var = F.col("_st.sse") / m - (F.col("_st.sr") / m) * (F.col("_st.sr") / m)
    cols = {"Level": F.col("_st.l"), "Trend": F.col("_st.b"),
            "Seasonals": F.array(*[F.col(f"_st.s{i}") for i in range(PERIOD)]),
            "SSE": F.col("_st.sse"), "Residuals": residuals,
            "Sigma": F.when(m > 0, F.sqrt(F.greatest(var, F.lit(0.0)))),
            "Status": F.when(m > 0, "fitted").otherwise("short history")}
    return out.withColumns(cols).drop("_st")


def holt_winters(arrays: DataFrame, params=FIXED_PARAMS) -> DataFrame:
    """FC2 with given (alpha, beta, gamma)."""
    a, b, g = (F.lit(float(x)) for x in params)
    return _with_state(arrays.withColumns({"Alpha": a, "Beta": b, "Gamma": g}),
                       F.col("Alpha"), F.col("Beta"), F.col("Gamma"))


def holt_winters_grid(arrays: DataFrame, keys: list[str], grid=GRID) -> DataFrame:
    """FC2 parameter fit: every grid point per series, lowest SSE kept
    (ties to the smaller alpha, beta, gamma).

    The grid runs inside the series' row: its values are shuffled once, when
    the array is gathered, however many points there are."""
    points = F.array(*[F.struct(F.lit(float(a)).alias("Alpha"), F.lit(float(b)).alias("Beta"),
                                F.lit(float(g)).alias("Gamma")) for a, b, g in grid])
    errors = F.transform(points, lambda p: F.struct(
        _fold(F.col("ys"), p["Alpha"], p["Beta"], p["Gamma"])["sse"].alias("e"),
        p["Alpha"].alias("Alpha"), p["Beta"].alias("Beta"), p["Gamma"].alias("Gamma")))
    best = arrays.withColumn("_b", F.array_min(errors)).select(*arrays.columns, "_b.Alpha", "_b.Beta", "_b.Gamma")
    return _with_state(best, F.col("Alpha"), F.col("Beta"), F.col("Gamma")).drop("ys")


def project(states: DataFrame, keys: list[str], horizon: int = HORIZON) -> DataFrame:
    """FC3/FC4: h-step forecasts with 95% bands (lower bound clipped at 0;
    the prediction itself is not clipped).  Values rounded half-even to 2.
    A series without residuals (7 days or fewer) has a prediction but no band."""
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    rows = states.select(*keys, "LastDate", "Level", "Trend", "Seasonals", "Sigma", h)
    pred = (F.col("Level") + F.col("h") * F.col("Trend")
            + F.element_at("Seasonals", ((F.col("h") - 1) % PERIOD) + 1))
    band = F.lit(Z95) * F.col("Sigma")
    return rows.select(*keys, F.date_add("LastDate", F.col("h")).alias("Date"), "h",
                       np_round(pred, 2).alias("PredictedRevenue"),
                       F.when(F.col("Sigma").isNotNull(), np_round(F.greatest(pred - band, F.lit(0.0)), 2))
                       .alias("LowerBound"),
                       np_round(pred + band, 2).alias("UpperBound"))


GLOBAL_KEY = "_series"


def keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Give the global series a constant key so that every per-series step
    is an ordinary keyed aggregate or equi-join."""
    if keys:
        return df, list(keys)
    return df.withColumn(GLOBAL_KEY, F.lit(0)), [GLOBAL_KEY]


def forecast_table(dense: DataFrame, future: DataFrame, keys: list[str]) -> DataFrame:
    """FC6/FC7/U1: history rows (prediction = bounds = actual) followed by
    forecast rows.  Forecast days come after a series' last history day, so
    either side is labelled where it arises."""
    # counts become doubles: forecast rows carry NaN-like nulls there, as in
    # the reference's float columns
    hist = dense.select(*keys, "Date", F.col("ActualRevenue").cast("double").alias("ActualRevenue"),
                        F.col("OrderVolume").cast("double").alias("OrderVolume"),
                        F.col("UnitsSold").cast("double").alias("UnitsSold"),
                        *[F.col("ActualRevenue").cast("double").alias(c)
                          for c in ("PredictedRevenue", "LowerBound", "UpperBound")],
                        F.lit("Historical").alias("DataType"))
    return hist.unionByName(future.drop("h").withColumn("DataType", F.lit("Forecast")), allowMissingColumns=True)


def forecast_summary(table: DataFrame, keys: list[str], window: int = 30) -> DataFrame:
    """FC9/A26: last ``window`` actual days, forecast total and change %
    (2 dp half-even, 0 when the previous period is 0); sums exact in cents.
    The row_number window is per series and kind over its days."""
    rank = Window.partitionBy(*keys, "DataType").orderBy(F.col("Date").desc())
    ranked = table.withColumn("_r", F.row_number().over(rank))
    actual = (F.col("DataType") == "Historical") & (F.col("_r") <= window)
    total = lambda kind, c: F.sum(F.when(kind, F.col(c)).cast("decimal(20,2)"))
    both = ranked.groupBy(*keys).agg(
        total(actual, "ActualRevenue").alias("Last30"),
        total(F.col("DataType") == "Forecast", "PredictedRevenue").alias("Next30"))
    lc, nc = to_cents("Last30"), to_cents("Next30")
    pct = F.when(lc > 0, div_round((nc - lc) * 10000, lc, "half_even").cast("double") / 100.0) \
        .otherwise(F.lit(0.0))
    return both.select(*keys, F.col("Last30").cast("double").alias("Last30DayActualRevenue"),
                       F.col("Next30").cast("double").alias("Next30DayPredictedRevenue"),
                       pct.alias("ProjectedChangePct"))


def holt_winters_forecast(tx: DataFrame, keys: list[str] | None = None, fit: str = "grid",
                          horizon: int = HORIZON) -> dict[str, DataFrame]:
    """FC1-FC4 + FC6-FC9 for every series: returns the states, the
    forecast rows, the history+forecast table and the summary."""
    keys = list(keys or [])
    dense, k = keyed(dense_daily(tx, keys), keys)
    arrays = series_arrays(dense, k)
    states = holt_winters_grid(arrays, k) if fit == "grid" else holt_winters(arrays)
    future = project(states, k, horizon)
    table = forecast_table(dense, future, k)
    summary = forecast_summary(table, k)
    drop = [GLOBAL_KEY] if not keys else []
    return {name: df.drop(*drop) for name, df in
            dict(states=states, future=future, table=table, summary=summary).items()}


def merged_fitted(tx: DataFrame, keys: list[str] | None = None, params=FIXED_PARAMS,
                  horizon: int = HORIZON) -> DataFrame:
    """FC8/J2: outer-merge form.  History days carry the in-sample one-step
    forecast (none for the 7 start-up days); predictions and lower bounds
    are clipped at 0 and everything is rounded half-even to 2 places."""
    keys = list(keys or [])
    dense, k = keyed(dense_daily(tx, keys), keys)
    st = holt_winters(series_arrays(dense, k), params)
    band = F.lit(Z95) * F.col("Sigma")
    fitted = fitted_values(st, k + ["Sigma"], params).select(
        *k, F.date_add("FirstDate", F.col("t") + PERIOD).alias("Date"), "p", "Sigma")
    future = project(st, k, horizon).select(
        *k, "Date", F.lit(None).cast("double").alias("p"), "PredictedRevenue", "LowerBound",
        "UpperBound")
    hist_pred = fitted.select(
        *k, "Date", "p", np_round(F.greatest(F.col("p"), F.lit(0.0)), 2).alias("PredictedRevenue"),
        np_round(F.greatest(F.col("p") - band, F.lit(0.0)), 2).alias("LowerBound"),
        np_round(F.col("p") + band, 2).alias("UpperBound"))
    future = future.withColumn("PredictedRevenue", F.greatest("PredictedRevenue", F.lit(0.0)))
    preds = hist_pred.unionByName(future).drop("p")
    out = dense.join(preds, k + ["Date"], "full").select(
        *k, "Date", np_round(F.col("ActualRevenue").cast("double"), 2).alias("ActualRevenue"),
        F.col("OrderVolume").cast("double").alias("OrderVolume"),
        F.col("UnitsSold").cast("double").alias("UnitsSold"),
        "PredictedRevenue", "LowerBound", "UpperBound")
    return out.drop(GLOBAL_KEY) if not keys else out


# ------------------------------------------------------ trend + weekday ridge
RIDGE_ALPHA = 1.0
N_FEATURES = 7  # DayIndex + weekday indicators for Tuesday..Sunday (Monday is the base)


def _design(date_col, first_col) -> list:
    wd = F.weekday(date_col)
    return [F.datediff(date_col, first_col).cast("double")] + \
        [(wd == k).cast("double") for k in range(1, 7)]


def _solve_ridge(batches):
    """Coefficients, intercept and residual spread of each series from its
    day-ordered values; the 7x7 systems of a batch are solved together."""
    for pdf in batches:
        designs, values = [], []
        for first, ys in zip(pdf["FirstWeekday"], pdf["ys"]):
            day = np.arange(len(ys))
            weekday = (first + day) % 7
            designs.append(np.column_stack([day] + [weekday == k for k in range(1, 7)]).astype(float))
            values.append(np.asarray(ys, dtype=float))
        if designs:
            xbar = np.array([x.mean(axis=0) for x in designs])
            ybar = np.array([y.mean() for y in values])
            a = np.array([(x - m).T @ (x - m) for x, m in zip(designs, xbar)]) + RIDGE_ALPHA * np.eye(N_FEATURES)
            b = np.array([(x - m).T @ (y - v) for x, m, y, v in zip(designs, xbar, values, ybar)])
            coef = np.linalg.solve(a, b[:, :, None])[:, :, 0]
            intercept = ybar - (xbar * coef).sum(axis=1)
            spread = [float(np.std(y - x @ w - c)) for x, y, w, c in zip(designs, values, coef, intercept)]
            yield pdf.drop(columns=["ys", "FirstWeekday"]).assign(
                Coef=coef.tolist(), Intercept=intercept, Sigma=spread)


def ridge_forecast(tx: DataFrame, keys: list[str] | None = None, horizon: int = HORIZON) -> DataFrame:
    """FC5: linear trend + day-of-week ridge (alpha 1, intercept not
    penalised), residual-std bands, for every series.

    A series is one row with its day-ordered values (bounded by the calendar
    span); a small vectorised step solves the 7x7 systems of many series at
    once and measures the residuals, and the horizon is exploded from that
    row, so nothing is joined.  Fixed weekday levels 1..6 keep the coding
    stable for any horizon.
    """
    keys = list(keys or [])
    dense, k = keyed(dense_daily(tx, keys), keys)
    arrays = series_arrays(dense, k).withColumn("FirstWeekday", F.weekday("FirstDate"))
    schema = T.StructType([f for f in arrays.schema.fields if f.name not in ("ys", "FirstWeekday")]
                          + [T.StructField("Coef", T.ArrayType(T.DoubleType())),
                             T.StructField("Intercept", T.DoubleType()), T.StructField("Sigma", T.DoubleType())])
    model = arrays.mapInPandas(_solve_ridge, schema)
    fut = (model.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
                .withColumn("Date", F.date_add("LastDate", F.col("h"))))
    pred = F.col("Intercept")
    for i, x in enumerate(_design(F.col("Date"), F.col("FirstDate"))):
        pred = pred + F.col("Coef")[i] * x
    band = F.lit(Z95) * F.col("Sigma")
    out = fut.select(*k, "Date", "h", np_round(pred, 2).alias("PredictedRevenue"),
                     np_round(F.greatest(pred - band, F.lit(0.0)), 2).alias("LowerBound"),
                     np_round(pred + band, 2).alias("UpperBound"), "Intercept", "Coef", "Sigma")
    return out.drop(GLOBAL_KEY) if not keys else out


# ------------------------------------------------------------ decomposition
def decomposition(tx: DataFrame, keys: list[str] | None = None, digits: int = 6) -> DataFrame:
    """FC10: classical additive decomposition of the dense daily series.

    Trend is the centred 7-day mean (null where the window is incomplete),
    the seasonal part is the weekday mean of the detrended values, centred
    to sum to zero, and the residual is what remains.  Windows are
    partitioned by series and ordered by day.
    """
    keys = list(keys or [])
    dense, k = keyed(dense_daily(tx, keys), keys)
    w = Window.partitionBy(*k).orderBy("Date").rowsBetween(-3, 3)
    y = F.col("ActualRevenue")
    d = (dense.withColumn("_s", F.sum(y).over(w)).withColumn("_n", F.count(y).over(w))
              .withColumn("Trend", F.when(F.col("_n") == PERIOD, F.col("_s").cast("double") / 7.0))
              .withColumn("Weekday", F.weekday("Date"))
              .withColumn("_detr", y.cast("double") - F.col("Trend")))
    wk = d.groupBy(*k, "Weekday").agg(F.avg("_detr").alias("_wm"))
    centred = wk.withColumn("Seasonal", F.col("_wm") - F.avg("_wm").over(Window.partitionBy(*k)))
    out = (d.join(centred.select(*k, "Weekday", "Seasonal"), k + ["Weekday"])
             .select(*k, "Date", y.cast("double").alias("ActualRevenue"),
                     F.round("Trend", digits).alias("Trend"),
                     F.round("Seasonal", digits).alias("Seasonal"),
                     F.round(y.cast("double") - F.col("Trend") - F.col("Seasonal"), digits).alias("Residual")))
    return out.drop(GLOBAL_KEY) if not keys else out


# --------------------------------------------------------- levels in one job
#: The levels of the forecast hierarchy, by the columns that name a series.
LEVELS = {"total": [], "category": ["ProductCategory"], "country": ["Country"],
          "category x country": ["ProductCategory", "Country"]}


def level_days(tx: DataFrame, levels: dict[str, list[str]] | None = None) -> DataFrame:
    """FC1 for all levels at once: (LevelName, Series, Date, ActualRevenue, UnitsSold), days with sales.

    Facts are summed once to the finest grain and day; grouping sets then give
    every level from those few rows in one shuffle.  Sums are decimals, so a
    parent is exactly the sum of its children on every day.
    """
    levels = levels or LEVELS
    names = sorted({c for cols in levels.values() for c in cols})
    finest = tx.groupBy(*names, dates.day("TransactionDate").alias("Date")).agg(
        F.sum("Revenue").alias("ActualRevenue"), F.sum("Quantity").cast("bigint").alias("UnitsSold"))
    sets = [[*(F.col(c) for c in cols), F.col("Date")] for cols in levels.values()]
    grouped = finest.groupingSets(sets, *names, "Date").agg(
        F.sum("ActualRevenue").alias("ActualRevenue"), F.sum("UnitsSold").alias("UnitsSold"), F.grouping_id().alias("_gid"))
    level, series = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, cols in levels.items():
        gid = sum(1 << (len(names) - i) for i, c in enumerate(names) if c not in cols)  # the last bit is Date's
        level = F.when(F.col("_gid") == gid, name).otherwise(level)
        label = F.concat_ws(" / ", *[F.col(c) for c in cols]) if cols else F.lit("all")
        series = F.when(F.col("_gid") == gid, label).otherwise(series)
    return grouped.select(level.alias("LevelName"), series.alias("Series"), "Date", "ActualRevenue", "UnitsSold")


def level_forecasts(tx: DataFrame, levels: dict[str, list[str]] | None = None, horizon: int = HORIZON) -> DataFrame:
    """FC1-FC4: forecasts of every series of every level in one job (fixed parameters)."""
    keys = ["LevelName", "Series"]
    days = level_days(tx, levels)
    return project(holt_winters(dense_arrays(days, keys)), keys, horizon)


def dense_arrays(days: DataFrame, keys: list[str]) -> DataFrame:
    """FC1: ``series_arrays`` of days with sales alone: gaps become zeros inside
    the series' row, without a calendar table and its join.

    The gap before each day is filled as that many zeros and the whole is
    flattened once, linear in the days of the series.
    """
    day = F.struct("Date", F.col("ActualRevenue").cast("double").alias("y"))
    lists = days.groupBy(*keys).agg(F.sort_array(F.collect_list(day)).alias("d"))
    filled = F.flatten(F.transform("d", lambda x, i: F.concat(
        F.array_repeat(F.lit(0.0), F.when(i == 0, 0).otherwise(
            F.datediff(x["Date"], F.get(F.col("d"), i - 1)["Date"]) - 1)), F.array(x["y"]))))
    return lists.select(*keys, filled.alias("ys"), F.col("d")[0]["Date"].alias("FirstDate"),
                        F.element_at("d", -1)["Date"].alias("LastDate"))


def forecast(tx: DataFrame, keys: list[str] | None = None, horizon: int = HORIZON,
             method: str = "holt_winters") -> DataFrame:
    """One entry point for every series' forecast rows: ``holt_winters``
    (grid-fitted, the default), ``holt_winters_fixed`` or ``trend_dow``
    (the ridge model).  The method is an explicit argument."""
    if method == "holt_winters":
        return holt_winters_forecast(tx, keys, "grid", horizon)["future"]
    if method == "holt_winters_fixed":
        return holt_winters_forecast(tx, keys, "fixed", horizon)["future"]
    if method == "trend_dow":
        return ridge_forecast(tx, keys, horizon).drop("Intercept", "Coef", "Sigma")
    raise ValueError(f"unknown forecast method {method!r}")
