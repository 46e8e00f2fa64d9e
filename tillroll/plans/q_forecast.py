"""Forecast queries (FC1-FC11).  The DuckDB oracle runs the same
Holt-Winters recursion as a recursive CTE with identical operand order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import forecast as fc
from tillroll.operators.sales import dense_daily
from tillroll.plans import sqlfrag as S
from tillroll.plans.registry import present, register
from tillroll.sources.tables import transactions


def _series_ctes(key_sql: str) -> list[str]:
    return [
        S.TX_CTE,
        f"""daily AS (SELECT {key_sql} AS k, CAST(TransactionDate AS DATE) AS Date, sum(Revenue) AS rev,
                   count(DISTINCT TransactionID) AS ov, CAST(sum(Quantity) AS BIGINT) AS units
            FROM transactions GROUP BY 1, 2)""",
        "span AS (SELECT k, min(Date) AS lo, max(Date) AS hi FROM daily GROUP BY k)",
        "cal AS (SELECT k, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date FROM span)",
        """dense AS (SELECT c.k, c.Date, coalesce(d.rev, 0) AS ActualRevenue, coalesce(d.ov, 0) AS OrderVolume,
                   coalesce(d.units, 0) AS UnitsSold
            FROM cal c LEFT JOIN daily d ON c.k = d.k AND c.Date = d.Date)""",
        """ser AS (SELECT k, Date, CAST(ActualRevenue AS DOUBLE) AS y,
                   row_number() OVER (PARTITION BY k ORDER BY Date) AS t FROM dense)""",
        """head AS (SELECT k, """ + ", ".join(f"max(y) FILTER (WHERE t = {i}) AS y{i}" for i in range(1, 8))
        + """, count(*) AS n, min(Date) AS FirstDate, max(Date) AS LastDate FROM ser GROUP BY k)""",
    ]


def _params_cte(grid) -> str:
    """The parameter grid as one list literal, unnested per series (no join)."""
    vals = ", ".join(f"{{'alpha': CAST({a!r} AS DOUBLE), 'beta': CAST({b!r} AS DOUBLE), "
                     f"'gamma': CAST({g!r} AS DOUBLE)}}" for a, b, g in grid)
    return f"params AS (SELECT [{vals}] AS grid)"


_L0 = "(y1 + y2 + y3 + y4 + y5 + y6 + y7) / 7.0"
_LB = "(r.l + r.b)"
_LVL = f"(r.alpha * (d.y - r.s[1]) + (1.0 - r.alpha) * {_LB})"
_F = f"({_LB} + r.s[1])"
REC_CTES = [
    "expanded AS (SELECT h.*, unnest((SELECT grid FROM params)) AS p FROM head h)",
    f"init AS (SELECT e.*, e.p.alpha AS alpha, e.p.beta AS beta, e.p.gamma AS gamma, {_L0} AS l0 FROM expanded e)",
    f"""rec AS (
  SELECT k, alpha, beta, gamma, 7 AS t, l0 AS l, CAST(0.0 AS DOUBLE) AS b,
         [y1 - l0, y2 - l0, y3 - l0, y4 - l0, y5 - l0, y6 - l0, y7 - l0] AS s,
         CAST(0.0 AS DOUBLE) AS sse, CAST(0.0 AS DOUBLE) AS sr, CAST(NULL AS DOUBLE) AS fit
  FROM init
  UNION ALL
  SELECT r.k, r.alpha, r.beta, r.gamma, r.t + 1, {_LVL},
         r.beta * ({_LVL} - r.l) + (1.0 - r.beta) * r.b,
         list_concat(r.s[2:7], [r.gamma * (d.y - {_LB}) + (1.0 - r.gamma) * r.s[1]]),
         r.sse + (d.y - {_F}) * (d.y - {_F}), r.sr + (d.y - {_F}), {_F}
  FROM rec r JOIN ser d ON d.k = r.k AND d.t = r.t + 1)""",
    """final AS (
  SELECT r.k, r.alpha, r.beta, r.gamma, r.l, r.b, r.s, r.sse, h.n - 7 AS m, h.FirstDate, h.LastDate,
         CASE WHEN h.n - 7 > 0 THEN sqrt(greatest(r.sse / CAST(h.n - 7 AS DOUBLE)
              - (r.sr / CAST(h.n - 7 AS DOUBLE)) * (r.sr / CAST(h.n - 7 AS DOUBLE)), 0.0)) END AS sigma
  FROM rec r JOIN head h ON r.k = h.k WHERE r.t = h.n)""",
    """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sse, alpha, beta, gamma) AS rn
                            FROM final) WHERE rn = 1)""",
]


def _hw_sql(key_sql: str, grid) -> str:
    return "WITH RECURSIVE " + ",\n".join(_series_ctes(key_sql) + [_params_cte(grid)] + REC_CTES) + "\n"


FUTURE_CTE = f"""future AS (
  SELECT k, CAST(LastDate + INTERVAL (h) DAY AS DATE) AS Date, h,
         round_even(l + h * b + s[((h - 1) % 7) + 1], 2) AS PredictedRevenue,
         round_even(greatest(l + h * b + s[((h - 1) % 7) + 1] - 1.96 * sigma, 0.0), 2) AS LowerBound,
         round_even(l + h * b + s[((h - 1) % 7) + 1] + 1.96 * sigma, 2) AS UpperBound
  FROM (SELECT *, unnest(generate_series(1, {fc.HORIZON})) AS h FROM best))"""

_STATE_SELECT = """alpha AS Alpha, beta AS Beta, gamma AS Gamma, l AS Level, b AS Trend, """ + \
    ", ".join(f"s[{i + 1}] AS S{i + 1}" for i in range(7)) + \
    """, sse AS SSE, CAST(m AS BIGINT) AS Residuals, sigma AS Sigma,
       strftime(FirstDate, '%Y-%m-%d') AS FirstDate, strftime(LastDate, '%Y-%m-%d') AS LastDate"""


def _flat_state(df, keys):
    return present(df.select(*keys, "Alpha", "Beta", "Gamma", "Level", "Trend",
                             *[F.col("Seasonals")[i].alias(f"S{i + 1}") for i in range(7)],
                             "SSE", F.col("Residuals").cast("bigint").alias("Residuals"), "Sigma",
                             "FirstDate", "LastDate"))


@register("holt_winters_fixed", _hw_sql("ProductCategory", [fc.FIXED_PARAMS]) + f"""
SELECT k AS ProductCategory, {_STATE_SELECT} FROM final""")
def q_holt_winters_fixed(spark, sf_dir):
    """FC2: Holt-Winters state per category series, fixed parameters."""
    dense = dense_daily(transactions(spark, sf_dir), ["ProductCategory"])
    return _flat_state(fc.holt_winters(fc.series_arrays(dense, ["ProductCategory"])), ["ProductCategory"])


@register("holt_winters_grid", _hw_sql("ProductCategory", fc.GRID) + f"""
SELECT k AS ProductCategory, {_STATE_SELECT} FROM best""")
def q_holt_winters_grid(spark, sf_dir):
    """FC2: grid-fitted Holt-Winters per category series (lowest SSE)."""
    dense = dense_daily(transactions(spark, sf_dir), ["ProductCategory"])
    return _flat_state(fc.holt_winters_grid(fc.series_arrays(dense, ["ProductCategory"]),
                                            ["ProductCategory"]), ["ProductCategory"])


@register("category_forecast", _hw_sql("ProductCategory", fc.GRID) + "," + FUTURE_CTE + """
SELECT k AS ProductCategory, strftime(Date, '%Y-%m-%d') AS Date, CAST(h AS BIGINT) AS h,
       PredictedRevenue, LowerBound, UpperBound FROM future""")
def q_category_forecast(spark, sf_dir):
    """FC3/FC4 for many series: 30-day forecast per category."""
    return present(fc.holt_winters_forecast(transactions(spark, sf_dir), ["ProductCategory"])["future"])


_GLOBAL = "'ALL'"
TBL_CTE = """tbl AS (
  SELECT Date, CAST(ActualRevenue AS DOUBLE) AS ActualRevenue, CAST(OrderVolume AS DOUBLE) AS OrderVolume,
         CAST(UnitsSold AS DOUBLE) AS UnitsSold,
         CAST(ActualRevenue AS DOUBLE) AS PredictedRevenue, CAST(ActualRevenue AS DOUBLE) AS LowerBound,
         CAST(ActualRevenue AS DOUBLE) AS UpperBound, 'Historical' AS DataType FROM dense
  UNION ALL
  SELECT Date, NULL, NULL, NULL, PredictedRevenue, LowerBound, UpperBound, 'Forecast' FROM future)"""
SUMMARY_CTES = [
    """sm AS (SELECT (SELECT sum(CAST(ActualRevenue AS DECIMAL(20,2))) FROM
                 (SELECT ActualRevenue FROM tbl WHERE DataType = 'Historical' ORDER BY Date DESC LIMIT 30)) AS l30,
              (SELECT sum(CAST(PredictedRevenue AS DECIMAL(20,2))) FROM tbl WHERE DataType = 'Forecast') AS n30)""",
    f"""fsum AS (SELECT *, CAST(l30 AS DOUBLE) AS Last30DayActualRevenue, CAST(n30 AS DOUBLE) AS Next30DayPredictedRevenue,
       CASE WHEN {S.cents('l30')} > 0
            THEN sign({S.cents('n30')} - {S.cents('l30')})
                 * CAST({S.div_half_even(f"abs({S.cents('n30')} - {S.cents('l30')}) * 10000", S.cents('l30'))} AS DOUBLE) / 100.0
            ELSE 0.0 END AS ProjectedChangePct FROM sm)""",
]


def global_forecast_ctes() -> list[str]:
    """Every CTE (after ``transactions``) of the grid-fitted global forecast."""
    return (_series_ctes(_GLOBAL)[1:] + [_params_cte(fc.GRID)] + REC_CTES
            + [FUTURE_CTE, TBL_CTE] + SUMMARY_CTES)


TABLE_SQL = _hw_sql(_GLOBAL, fc.GRID) + "," + FUTURE_CTE + ",\n" + TBL_CTE


@register("forecast_table", TABLE_SQL + """
SELECT strftime(Date, '%Y-%m-%d') AS Date, ActualRevenue, OrderVolume, UnitsSold, PredictedRevenue,
       LowerBound, UpperBound, DataType FROM tbl""")
def q_forecast_table(spark, sf_dir):
    """FC6/FC7/B9: history + 30-day forecast of total daily revenue."""
    return present(fc.holt_winters_forecast(transactions(spark, sf_dir))["table"])


@register("forecast_summary", TABLE_SQL + ",\n" + ",\n".join(SUMMARY_CTES) + """
SELECT Last30DayActualRevenue, Next30DayPredictedRevenue, ProjectedChangePct FROM fsum""")
def q_forecast_summary(spark, sf_dir):
    """FC9/A26: last 30 days actual vs next 30 days forecast."""
    return fc.holt_winters_forecast(transactions(spark, sf_dir))["summary"]


@register("forecast_merged", _hw_sql(_GLOBAL, [fc.FIXED_PARAMS]) + ", best_f AS (SELECT * FROM final)" + """,
fitted AS (SELECT s.Date, r.fit FROM rec r JOIN ser s ON s.k = r.k AND s.t = r.t WHERE r.t > 7),
preds AS (
  SELECT f.Date, round_even(greatest(f.fit, 0.0), 2) AS PredictedRevenue,
         round_even(greatest(f.fit - 1.96 * (SELECT sigma FROM final), 0.0), 2) AS LowerBound,
         round_even(f.fit + 1.96 * (SELECT sigma FROM final), 2) AS UpperBound FROM fitted f
  UNION ALL
  SELECT CAST(LastDate + INTERVAL (h) DAY AS DATE),
         greatest(round_even(l + h * b + s[((h - 1) % 7) + 1], 2), 0.0),
         round_even(greatest(l + h * b + s[((h - 1) % 7) + 1] - 1.96 * sigma, 0.0), 2),
         round_even(l + h * b + s[((h - 1) % 7) + 1] + 1.96 * sigma, 2)
  FROM (SELECT *, unnest(generate_series(1, 30)) AS h FROM final))
SELECT strftime(coalesce(d.Date, p.Date), '%Y-%m-%d') AS Date,
       round_even(CAST(d.ActualRevenue AS DOUBLE), 2) AS ActualRevenue,
       CAST(d.OrderVolume AS DOUBLE) AS OrderVolume, CAST(d.UnitsSold AS DOUBLE) AS UnitsSold,
       p.PredictedRevenue, p.LowerBound, p.UpperBound
FROM dense d FULL OUTER JOIN preds p ON d.Date = p.Date""")
def q_forecast_merged(spark, sf_dir):
    """FC8/J2: outer-merge form with in-sample fitted values."""
    return present(fc.merged_fitted(transactions(spark, sf_dir)))


@register("decomposition", "WITH " + ",\n".join(_series_ctes(_GLOBAL)[:5]) + """,
w AS (SELECT Date, ActualRevenue,
             CASE WHEN count(ActualRevenue) OVER win = 7
                  THEN CAST(sum(ActualRevenue) OVER win AS DOUBLE) / 7.0 END AS Trend,
             isodow(Date) - 1 AS Weekday
      FROM dense WINDOW win AS (ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
wk AS (SELECT Weekday, avg(CAST(ActualRevenue AS DOUBLE) - Trend) AS wm FROM w GROUP BY Weekday),
cen AS (SELECT Weekday, wm - avg(wm) OVER () AS Seasonal FROM wk)
SELECT strftime(w.Date, '%Y-%m-%d') AS Date, CAST(w.ActualRevenue AS DOUBLE) AS ActualRevenue,
       round(w.Trend, 6) AS Trend, round(c.Seasonal, 6) AS Seasonal,
       round(CAST(w.ActualRevenue AS DOUBLE) - w.Trend - c.Seasonal, 6) AS Residual
FROM w JOIN cen c ON w.Weekday = c.Weekday""")
def q_decomposition(spark, sf_dir):
    """FC10: trend / weekday seasonal / residual of total daily revenue."""
    return present(fc.decomposition(transactions(spark, sf_dir)))


# The weekday block of the ridge system is diagonal: eliminating it (its Schur
# complement) leaves two equations in the intercept and the slope.
RIDGE_CTES = [
    "obs AS (SELECT date_diff('day', min(Date) OVER (), Date) AS x, isodow(Date) - 1 AS wd, "
    "CAST(ActualRevenue AS DOUBLE) AS y FROM dense)",
    "grp AS (SELECT wd, CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS sx, sum(y) AS sy, "
    "CASE WHEN wd = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / (count(*) + 1) END AS f, "
    "CASE WHEN wd = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / (count(*) + 1) END AS g FROM obs GROUP BY wd)",
    "tot AS (SELECT CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(x * x) AS DOUBLE) AS sxx, sum(x * y) AS sxy FROM obs)",
    """eqn AS (SELECT sum(f * n) AS a11, sum(f * sx) AS a12, sum(f * sy) AS c1,
              (SELECT sx FROM tot) - sum(g * sx * n) AS a21, (SELECT sxx FROM tot) + 1 - sum(g * sx * sx) AS a22,
              (SELECT sxy FROM tot) - sum(g * sx * sy) AS c2 FROM grp)""",
    """sol AS (SELECT (c1 * a22 - a12 * c2) / (a11 * a22 - a12 * a21) AS b0,
                   (a11 * c2 - a21 * c1) / (a11 * a22 - a12 * a21) AS slope FROM eqn)""",
    """eff AS (SELECT wd, CASE WHEN wd = 0 THEN 0.0::DOUBLE ELSE
                   (sy - (SELECT slope FROM sol) * sx - n * (SELECT b0 FROM sol)) / (n + 1) END AS d FROM grp)""",
    """res AS (SELECT stddev_pop(o.y - (SELECT b0 FROM sol) - (SELECT slope FROM sol) * o.x - e.d) AS sigma
              FROM obs o JOIN eff e ON e.wd = o.wd)""",
    """days AS (SELECT CAST(hi + INTERVAL (h) DAY AS DATE) AS Date, h, date_diff('day', lo, hi) + h AS x
               FROM (SELECT lo, hi, unnest(generate_series(1, 30)) AS h FROM span))""",
    """fut AS (SELECT t.Date, t.h, (SELECT b0 FROM sol) + (SELECT slope FROM sol) * t.x + coalesce(e.d, 0.0) AS p,
                   (SELECT sigma FROM res) AS sigma
              FROM days t LEFT JOIN eff e ON e.wd = isodow(t.Date) - 1)""",
]


@register("ridge_forecast", "WITH " + ",\n".join(_series_ctes(_GLOBAL)[:5] + RIDGE_CTES) + """
SELECT strftime(Date, '%Y-%m-%d') AS Date, CAST(h AS BIGINT) AS h, round_even(p, 2) AS PredictedRevenue,
       round_even(greatest(p - 1.96 * sigma, 0.0), 2) AS LowerBound, round_even(p + 1.96 * sigma, 2) AS UpperBound,
       round((SELECT b0 FROM sol), 2) AS Intercept, round(sigma, 2) AS Sigma
FROM fut""")
def q_ridge_forecast(spark, sf_dir):
    """FC5: trend + weekday ridge forecast of total daily revenue."""
    out = fc.ridge_forecast(transactions(spark, sf_dir)).drop("Coef")
    return present(out.withColumns({c: F.round(c, 2) for c in ("Intercept", "Sigma")}))


SHORT_DAYS = (1, 6, 7, 8)
_SHORT_INIT = "[" + ", ".join(f"coalesce(y{i} - l0, 0.0)" for i in range(1, 8)) + "]"
_ANY_LENGTH = [
    "ser AS (SELECT k, Date, CAST(ActualRevenue AS DOUBLE) AS y, row_number() OVER (PARTITION BY k ORDER BY Date) AS t FROM cut)",
    "head AS (SELECT k, " + ", ".join(f"max(y) FILTER (WHERE t = {i}) AS y{i}" for i in range(1, 8))
    + ", count(*) AS n, max(Date) AS LastDate FROM ser GROUP BY k)",
    "init AS (SELECT *, (" + " + ".join(f"coalesce(y{i}, 0.0)" for i in range(1, 8)) + ") / CAST(least(n, 7) AS DOUBLE) AS l0, "
    "0.3::DOUBLE AS alpha, 0.1::DOUBLE AS beta, 0.2::DOUBLE AS gamma FROM head)",
    f"""rec AS (SELECT k, alpha, beta, gamma, least(n, 7) AS t, l0 AS l, CAST(0.0 AS DOUBLE) AS b, {_SHORT_INIT} AS s,
         CAST(0.0 AS DOUBLE) AS sse, CAST(0.0 AS DOUBLE) AS sr FROM init
  UNION ALL
  SELECT r.k, r.alpha, r.beta, r.gamma, r.t + 1, {_LVL}, r.beta * ({_LVL} - r.l) + (1.0 - r.beta) * r.b,
         list_concat(r.s[2:7], [r.gamma * (d.y - {_LB}) + (1.0 - r.gamma) * r.s[1]]),
         r.sse + (d.y - {_F}) * (d.y - {_F}), r.sr + (d.y - {_F})
  FROM rec r JOIN ser d ON d.k = r.k AND d.t = r.t + 1)""",
    """best AS (SELECT r.*, h.n, h.LastDate, CASE WHEN h.n > 7 THEN sqrt(greatest(r.sse / (h.n - 7) - (r.sr / (h.n - 7)) * (r.sr / (h.n - 7)), 0.0)) END
              AS sigma FROM rec r JOIN head h ON h.k = r.k AND r.t = h.n)""", FUTURE_CTE]
SHORT_SQL = "WITH RECURSIVE " + ",\n".join(_series_ctes("ProductCategory")[:5] + [
    f"cut AS (SELECT d.k || '/' || u.n AS k, d.Date, d.ActualRevenue FROM dense d JOIN span s ON s.k = d.k "
    f"JOIN (SELECT unnest([{', '.join(map(str, SHORT_DAYS))}]) AS n) u ON d.Date < s.lo + INTERVAL (u.n) DAY)"] + _ANY_LENGTH)


@register("short_series_forecast", SHORT_SQL + """
SELECT f.k AS Series, strftime(f.Date, '%Y-%m-%d') AS Date, CAST(f.h AS BIGINT) AS h, f.PredictedRevenue,
       CASE WHEN b.sigma IS NOT NULL THEN f.LowerBound END AS LowerBound, f.UpperBound,
       CASE WHEN b.sigma IS NULL THEN 'short history' ELSE 'fitted' END AS Status
FROM future f JOIN best b ON b.k = f.k""")
def q_short_series_forecast(spark, sf_dir):
    """FC2-FC4 on the first 1, 6, 7 and 8 days of every category: what a series too short to fit gives."""
    dense = dense_daily(transactions(spark, sf_dir), ["ProductCategory"])
    first = F.min("Date").over(Window.partitionBy("ProductCategory"))
    cut = (dense.withColumn("_first", first).select("*", F.explode(F.array(*map(F.lit, SHORT_DAYS))).alias("_n"))
           .where(F.col("Date") < F.date_add("_first", F.col("_n")))
           .withColumn("Series", F.concat_ws("/", "ProductCategory", F.col("_n").cast("string"))))
    states = fc.holt_winters(fc.series_arrays(cut, ["Series"]))
    return present(fc.project(states.withColumn("_key", F.struct("Series", "Status")), ["_key"]).select("_key.*", "Date", "h",
                   "PredictedRevenue", "LowerBound", "UpperBound"))


@register("series_span", "WITH " + ",\n".join(_series_ctes("ProductCategory")[:5]) + """
SELECT k AS ProductCategory, strftime(min(Date), '%Y-%m-%d') AS FirstDate,
       strftime(max(Date), '%Y-%m-%d') AS LastDate, count(*) AS Days
FROM dense GROUP BY k""")
def q_series_span(spark, sf_dir):
    """First day, last day and day count of every category series."""
    dense = dense_daily(transactions(spark, sf_dir), ["ProductCategory"])
    return present(dense.groupBy("ProductCategory").agg(
        F.min("Date").alias("FirstDate"), F.max("Date").alias("LastDate"),
        F.count(F.lit(1)).alias("Days")))


@register("forecast_chart_feed", TABLE_SQL + """
SELECT strftime(Date, '%Y-%m-%d') AS Date,
       CASE WHEN DataType = 'Historical' THEN 'Historical Daily Revenue' ELSE '30-Day Forecasted Revenue' END AS Line,
       CASE WHEN DataType = 'Historical' THEN ActualRevenue ELSE PredictedRevenue END AS Revenue,
       CASE WHEN DataType = 'Forecast' THEN LowerBound END AS BandLower,
       CASE WHEN DataType = 'Forecast' THEN UpperBound END AS BandUpper
FROM tbl""")
def q_forecast_chart_feed(spark, sf_dir):
    """FC11/B9: the actual-vs-forecast line and confidence band feed."""
    t = fc.holt_winters_forecast(transactions(spark, sf_dir))["table"]
    hist = F.col("DataType") == "Historical"
    fcst = F.col("DataType") == "Forecast"
    return present(t.select(
        "Date",
        F.when(hist, "Historical Daily Revenue").otherwise("30-Day Forecasted Revenue").alias("Line"),
        F.when(hist, F.col("ActualRevenue")).otherwise(F.col("PredictedRevenue")).alias("Revenue"),
        F.when(fcst, F.col("LowerBound")).alias("BandLower"),
        F.when(fcst, F.col("UpperBound")).alias("BandUpper")))


@register("country_forecast", _hw_sql("Country", [fc.FIXED_PARAMS]) + "," + FUTURE_CTE + """
SELECT k AS Country, strftime(Date, '%Y-%m-%d') AS Date, CAST(h AS BIGINT) AS h,
       PredictedRevenue, LowerBound, UpperBound FROM future""")
def q_country_forecast(spark, sf_dir):
    """FC2-FC4 for many series: 30-day forecast per country (fixed parameters)."""
    return present(fc.holt_winters_forecast(transactions(spark, sf_dir), ["Country"], fit="fixed")["future"])


@register("forecast_tail", TABLE_SQL + """
SELECT strftime(Date, '%Y-%m-%d') AS Date, ActualRevenue, OrderVolume, UnitsSold, PredictedRevenue,
       LowerBound, UpperBound, DataType FROM tbl ORDER BY tbl.Date DESC LIMIT 5""")
def q_forecast_tail(spark, sf_dir):
    """Preview of the last rows of the forecast table (dates are unique)."""
    t = fc.holt_winters_forecast(transactions(spark, sf_dir))["table"]
    return present(t.orderBy(F.col("Date").desc()).limit(5))


def _level_sql() -> str:
    """The series of all levels under one key: level and series name."""
    keys = {"total": "'all'", "category": "ProductCategory", "country": "Country",
            "category x country": "concat_ws(' / ', ProductCategory, Country)"}
    days = " UNION ALL ".join(
        f"SELECT '{level}|' || {key} AS k, CAST(TransactionDate AS DATE) AS Date, sum(Revenue) AS rev, 0 AS ov, 0 AS units "
        f"FROM transactions GROUP BY 1, 2" for level, key in keys.items())
    ctes = _series_ctes("''")[:5]
    ctes[1] = f"daily AS ({days})"
    return "WITH RECURSIVE " + ",\n".join([*ctes, "cut AS (SELECT k, Date, ActualRevenue FROM dense)", *_ANY_LENGTH])


@register("level_forecasts", _level_sql() + """
SELECT split_part(f.k, '|', 1) AS LevelName, split_part(f.k, '|', 2) AS Series, strftime(f.Date, '%Y-%m-%d') AS Date,
       CAST(f.h AS BIGINT) AS h, f.PredictedRevenue, CASE WHEN b.sigma IS NOT NULL THEN f.LowerBound END AS LowerBound,
       f.UpperBound FROM future f JOIN best b ON b.k = f.k""")
def q_level_forecasts(spark, sf_dir):
    """FC1-FC4: total, category, country and category x country forecast in one job."""
    return present(fc.level_forecasts(transactions(spark, sf_dir)))


@register("level_history", S.with_ctes(S.TX_CTE) + " UNION ALL ".join(
    f"""SELECT '{level}' AS LevelName, {key} AS Series, count(DISTINCT CAST(TransactionDate AS DATE)) AS Days,
       CAST(sum(Revenue) AS DOUBLE) AS Revenue, CAST(sum(Quantity) AS BIGINT) AS Units FROM transactions GROUP BY 2"""
    for level, key in (("total", "'all'"), ("category", "ProductCategory"), ("country", "Country"),
                       ("category x country", "concat_ws(' / ', ProductCategory, Country)"))))
def q_level_history(spark, sf_dir):
    """FC1: days, revenue and units of every series of every level."""
    days = fc.level_days(transactions(spark, sf_dir))
    return present(days.groupBy("LevelName", "Series").agg(
        F.count(F.lit(1)).alias("Days"), F.sum("ActualRevenue").alias("Revenue"), F.sum("UnitsSold").alias("Units")))
