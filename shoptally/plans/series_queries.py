"""Daily and weekly revenue, per payment method as the series, and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally.operators import forecast
from shoptally.operators import series as sr
from shoptally.plans import views
from shoptally.plans.registry import query, rounded

S = ["pay"]
HOLIDAYS = ((1, 1), (5, 1), (7, 28), (7, 29), (12, 25))

DAILY = """, sums AS (SELECT pay, day, sum(total) AS y FROM sales GROUP BY pay, day),
spans AS (SELECT pay, min(day) AS a, max(day) AS b FROM sums GROUP BY pay),
cal AS (SELECT pay, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
daily AS (SELECT c.pay, c.day, coalesce(s.y, 0) AS y FROM cal c LEFT JOIN sums s ON s.pay = c.pay AND s.day = c.day),
weekly AS (SELECT pay, CAST(date_trunc('week', day) + INTERVAL 6 DAY AS DATE) AS ds, sum(y) AS y FROM daily GROUP BY 1, 2)
"""
CALENDAR = """, years AS (SELECT unnest(range(min(year(ds)), max(year(ds)) + 3)) AS yr FROM weekly),
hol AS (SELECT DISTINCT CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS ds FROM (
  SELECT make_date(yr, m, d) AS d FROM years, (VALUES (1, 1), (5, 1), (7, 28), (7, 29), (12, 25)) AS h(m, d))),
school AS (SELECT DISTINCT CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS ds FROM (
  SELECT unnest(generate_series(make_date(yr, 3, 1), make_date(yr, 3, 30), INTERVAL 1 DAY)) AS d FROM years
  UNION ALL SELECT unnest(generate_series(make_date(yr, 7, 20), make_date(yr, 8, 3), INTERVAL 1 DAY)) FROM years)),
flagged AS (SELECT w.*, CAST(CASE WHEN h.ds IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_nat,
  CAST(CASE WHEN s.ds IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_school
  FROM weekly w LEFT JOIN hol h ON h.ds = w.ds LEFT JOIN school s ON s.ds = w.ds)
"""


def daily(spark, sf):
    return sr.daily_revenue(views.sales(spark, sf), "day", "total", S)


def weekly(spark, sf):
    return sr.weekly_revenue(daily(spark, sf), "SUN", S)


def flagged(spark, sf):
    weeks = weekly(spark, sf)
    return sr.calendar_regressors(weeks, sr.yearly_days(weeks, HOLIDAYS), sr.school_days(weeks))


@query("daily_revenue", DAILY + "SELECT pay, day, round(y, 2) AS y FROM daily")
def daily_revenue(spark, sf):
    return rounded(daily(spark, sf), y=2)


@query(
    "weekly_revenue",
    DAILY
    + """SELECT 'SUN' AS week_end, pay, ds, round(y, 2) AS y FROM weekly
UNION ALL SELECT 'MON', pay, CAST(date_trunc('week', day - INTERVAL 1 DAY) + INTERVAL 7 DAY AS DATE), round(sum(y), 2) FROM daily GROUP BY 2, 3""",
)
def weekly_revenue(spark, sf):
    days = daily(spark, sf)
    parts = [sr.weekly_revenue(days, e, S).select(F.lit(e).alias("week_end"), "*") for e in ("SUN", "MON")]
    return rounded(parts[0].unionByName(parts[1]), y=2)


@query("calendar_regressors", DAILY + CALENDAR + "SELECT pay, ds, round(y, 2) AS y, is_nat, is_school FROM flagged")
def calendar_regressors(spark, sf):
    return rounded(flagged(spark, sf), y=2)


@query(
    "attach_calendar",
    DAILY
    + """SELECT w.pay, w.ds, CAST(coalesce(f.first_week, 0) AS INTEGER) AS first_week FROM weekly w
LEFT JOIN (SELECT min(ds) AS ds, 1 AS first_week FROM weekly GROUP BY year(ds)) f ON f.ds = w.ds""",
)
def attach_calendar(spark, sf):
    weeks = weekly(spark, sf)
    firsts = weeks.groupBy(F.year("ds")).agg(F.min("ds").alias("ds")).select("ds", F.lit(1).alias("first_week"))
    return sr.attach_calendar(weeks, firsts).select("pay", "ds", "first_week")


@query(
    "add_lags",
    DAILY
    + """SELECT * FROM (SELECT pay, ds, round(y, 2) AS y, round(lag(y, 1) OVER w, 2) AS lag_1, round(lag(y, 2) OVER w, 2) AS lag_2,
  round(lag(y, 3) OVER w, 2) AS lag_3, CAST(weekofyear(ds) AS INTEGER) AS week FROM weekly WINDOW w AS (PARTITION BY pay ORDER BY ds)) WHERE lag_3 IS NOT NULL""",
)
def add_lags(spark, sf):
    return rounded(sr.add_lags(weekly(spark, sf), 3, series=S), y=2, lag_1=2, lag_2=2, lag_3=2)


@query(
    "moving_means",
    DAILY
    + """SELECT pay, ds, round(coalesce(avg(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), y) + 1e-6, 3) AS ma_pred,
  round(avg(y) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) + 1e-6, 3) AS rolling,
  round(avg(y) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1e-6, 3) AS expanding
FROM weekly WINDOW w AS (PARTITION BY pay ORDER BY ds)""",
)
def moving_means(spark, sf):
    """Lagged, rolling and expanding mean of each week."""
    weeks = sr.lagged_mean(weekly(spark, sf), 3, F.col("y"), series=S)
    weeks = sr.expanding_mean(sr.rolling_mean(weeks, 3, series=S), series=S).drop("y")
    return rounded(weeks, 1e-6, ma_pred=3, rolling=3, expanding=3)


@query(
    "holdout_last",
    DAILY
    + """SELECT pay, ds, CASE WHEN row_number() OVER (PARTITION BY pay ORDER BY ds DESC) <= 4 THEN 'test' ELSE 'train' END AS part FROM weekly""",
)
def holdout_last(spark, sf):
    train, test = sr.holdout_last(weekly(spark, sf), 4, S)
    return train.select("pay", "ds", F.lit("train").alias("part")).unionByName(
        test.select("pay", "ds", F.lit("test").alias("part"))
    )


FLAT = """, back AS (SELECT *, row_number() OVER (PARTITION BY pay ORDER BY ds DESC) AS rn FROM weekly),
flat AS (SELECT pay, CAST(max(ds) + CAST(7 * s AS INTEGER) AS DATE) AS ds, avg(y) AS ma_pred
  FROM back, (SELECT unnest(range(1, 5)) AS s) WHERE rn <= 3 GROUP BY pay, s)
"""


@query("flat_forecast", DAILY + FLAT + "SELECT pay, ds, round(ma_pred + 1e-6, 3) AS ma_pred FROM flat")
def flat_forecast(spark, sf):
    return rounded(sr.flat_forecast(weekly(spark, sf), 3, 4, series=S), 1e-6, ma_pred=3)


TREND = """, placed AS (SELECT *, row_number() OVER (PARTITION BY pay ORDER BY ds DESC) AS rn,
  date_diff('day', min(ds) OVER (PARTITION BY pay), ds) / 7.0 AS t, ln(1 + y) AS ly FROM weekly),
fit AS (SELECT pay, regr_slope(ly, t) AS b, regr_intercept(ly, t) AS a, count(*) AS n FROM placed WHERE rn > 4 GROUP BY pay),
resid AS (SELECT p.pay, sqrt(sum(power(ly - a - b * t, 2)) / (any_value(n) - 2)) AS s FROM placed p JOIN fit f ON f.pay = p.pay WHERE rn > 4 GROUP BY p.pay),
points AS (SELECT pay, ds, y, t, false AS is_future FROM placed
  UNION ALL SELECT pay, CAST(max(ds) + CAST(7 * s AS INTEGER) AS DATE), NULL, max(t) + s, true FROM placed, (SELECT unnest(range(1, 5)) AS s) GROUP BY pay, s),
trend AS (SELECT p.pay, p.ds, p.y, greatest(exp(a + b * t) - 1, 0) AS yhat, greatest(exp(a + b * t - 1.2815515655446004 * s) - 1, 0) AS yhat_lower,
  greatest(exp(a + b * t + 1.2815515655446004 * s) - 1, 0) AS yhat_upper, is_future FROM points p JOIN fit f ON f.pay = p.pay JOIN resid r ON r.pay = p.pay)
"""


@query(
    "trend_forecast_base",
    DAILY
    + TREND
    + "SELECT pay, ds, round(y, 2) AS y, round(yhat, 2) AS yhat, round(yhat_lower, 2) AS yhat_lower, round(yhat_upper, 2) AS yhat_upper, is_future FROM trend",
)
def trend_forecast_base(spark, sf):
    table = forecast.trend_forecast_base(weekly(spark, sf), 4, 4, S)
    return rounded(table, y=2, yhat=2, yhat_lower=2, yhat_upper=2)


def _two_models(spark, sf):
    """Last four weeks with the trend fit and the lagged mean."""
    weeks = weekly(spark, sf)
    trend = forecast.trend_forecast_base(weeks, 4, 4, S).filter("not is_future").select("pay", "ds", "yhat")
    means = sr.lagged_mean(weeks, 3, series=S).select("pay", "ds", "ma_pred")
    return sr.align_forecasts(weeks, trend, means, series=S)


TWO = """, two AS (SELECT t.pay, t.ds, t.y, t.yhat, avg(w.y) OVER (PARTITION BY w.pay ORDER BY w.ds ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS ma_pred,
  row_number() OVER (PARTITION BY w.pay ORDER BY w.ds DESC) AS rn FROM trend t JOIN weekly w ON w.pay = t.pay AND w.ds = t.ds),
err AS (SELECT pay, sqrt(avg(power(y - yhat, 2))) AS trend_rmse, avg(abs((y - yhat) / CASE WHEN y = 0 THEN 1 ELSE y END)) * 100 AS trend_mape,
  sqrt(avg(power(y - ma_pred, 2))) AS ma_rmse, avg(abs((y - ma_pred) / CASE WHEN y = 0 THEN 1 ELSE y END)) * 100 AS ma_mape FROM two WHERE rn <= 4 GROUP BY pay)
"""


@query(
    "align_forecasts",
    DAILY + TREND + TWO + "SELECT pay, ds, round(y, 2) AS y, round(yhat, 2) AS yhat, round(ma_pred, 3) AS ma_pred FROM two",
)
def align_forecasts(spark, sf):
    return rounded(_two_models(spark, sf), y=2, yhat=2, ma_pred=3)


@query(
    "backtest_frame",
    DAILY
    + TREND
    + TWO
    + """SELECT pay, ds, round(y, 2) AS y, round(yhat, 2) AS yhat, round(ma_pred, 3) AS ma_pred, 'Sem ' || (5 - rn) AS week_label,
  round(abs((y - yhat) / y) * 100, 4) AS yhat_mape, round(abs(y - yhat), 3) AS yhat_rmse, round(abs((y - ma_pred) / y) * 100, 4) AS ma_pred_mape,
  round(abs(y - ma_pred), 3) AS ma_pred_rmse FROM two WHERE rn <= 4""",
)
def backtest_frame(spark, sf):
    frame = sr.backtest_frame(_two_models(spark, sf), ["yhat", "ma_pred"], 4, S)
    return rounded(frame, y=2, yhat=2, ma_pred=3, yhat_mape=4, yhat_rmse=3, ma_pred_mape=4, ma_pred_rmse=3)


def _errors(spark, sf):
    _, recent = sr.holdout_last(_two_models(spark, sf), 4, S)
    return {
        "trend": sr.forecast_errors(recent, pred="yhat", series=S),
        "moving_mean": sr.forecast_errors(recent, pred="ma_pred", series=S),
    }


@query(
    "forecast_errors",
    DAILY
    + TREND
    + TWO
    + """SELECT 'trend' AS model, pay, round(trend_rmse, 3) AS rmse, round(trend_mape, 4) AS mape FROM err
UNION ALL SELECT 'moving_mean', pay, round(ma_rmse, 3), round(ma_mape, 4) FROM err""",
)
def forecast_errors(spark, sf):
    return rounded(sr.model_table(**_errors(spark, sf)), rmse=3, mape=4)


@query(
    "pick_winner",
    DAILY
    + TREND
    + TWO
    + """SELECT pay, round(trend_mape, 4) AS trend_mape, round(ma_mape, 4) AS ma_mape,
  CASE WHEN trend_mape < ma_mape THEN 'trend' WHEN ma_mape < trend_mape THEN 'moving_mean' ELSE 'Empate' END AS winner FROM err""",
)
def pick_winner(spark, sf):
    errors = _errors(spark, sf)
    both = errors["trend"].select("pay", F.col("mape").alias("trend_mape")).join(
        errors["moving_mean"].select("pay", F.col("mape").alias("ma_mape")), "pay"
    )
    picked = sr.pick_winner(both, "trend_mape", "ma_mape", ("trend", "moving_mean"))
    return rounded(picked, trend_mape=4, ma_mape=4)


@query(
    "revenue_summary",
    DAILY
    + FLAT
    + """SELECT w.pay, round(sum(y), 2) AS total, round(avg(y), 3) AS mean_week, round(arg_max(y, ds), 2) AS last_week,
  (SELECT round(arg_min(ma_pred, f.ds), 3) FROM flat f WHERE f.pay = w.pay) AS next_week FROM weekly w GROUP BY w.pay""",
)
def revenue_summary(spark, sf):
    weeks = weekly(spark, sf)
    table = sr.revenue_summary(weeks, sr.flat_forecast(weeks, 3, 4, series=S), series=S)
    return rounded(table, total=2, mean_week=3, last_week=2, next_week=3)


CHANGE = "1998-01-04"
TERMS = 5  # intercept, weeks since the first, weeks after the change point, two regressors


def _least_squares_sql():
    """Normal equations of the trend model, one per payment method, solved by Gauss-Jordan elimination."""
    sql = f""", last AS (SELECT pay, min(ds) AS first, max(ds) AS last FROM weekly GROUP BY pay),
grid AS (SELECT pay, ds, y, false AS is_future, row_number() OVER (PARTITION BY pay ORDER BY ds DESC) > 4 AS fit FROM weekly
  UNION ALL SELECT pay, CAST(last + to_days(CAST(7 * step AS INTEGER)) AS DATE), NULL, true, false FROM last, range(1, 5) AS r(step)),
x AS (SELECT g.*, ln(1 + y) AS target, [1.0::DOUBLE, date_diff('day', first, g.ds) / 7.0 - 150,
    greatest(date_diff('day', DATE '{CHANGE}', g.ds) / 7.0, 0),
    (g.ds IN (SELECT ds FROM hol))::INT::DOUBLE, (g.ds IN (SELECT ds FROM school))::INT::DOUBLE] AS v
  FROM grid g JOIN last USING (pay)),
e0 AS (SELECT pay, i, j, sum(v[i] * CASE WHEN j > {TERMS} THEN target ELSE v[j] END) AS a
  FROM x, range(1, {TERMS + 1}) AS r(i), range(1, {TERMS + 2}) AS c(j) WHERE fit GROUP BY ALL)"""
    for k in range(1, TERMS + 1):
        sql += f""",
e{k} AS (SELECT m.pay, m.i, m.j, CASE WHEN m.i = {k} THEN m.a / p.a ELSE m.a - f.a / p.a * h.a END AS a FROM e{k - 1} m
  JOIN e{k - 1} p ON p.pay = m.pay AND p.i = {k} AND p.j = {k} JOIN e{k - 1} f ON f.pay = m.pay AND f.i = m.i AND f.j = {k}
  JOIN e{k - 1} h ON h.pay = m.pay AND h.i = {k} AND h.j = m.j)"""
    return (
        sql
        + f""",
beta AS (SELECT pay, list(a ORDER BY i) AS b FROM e{TERMS} WHERE j = {TERMS + 1} GROUP BY pay),
fitted AS (SELECT x.*, list_dot_product(v, b) AS f FROM x JOIN beta USING (pay)),
spread AS (SELECT pay, sqrt(sum(power(target - f, 2)) / (count(*) - {TERMS})) AS s FROM fitted WHERE fit GROUP BY pay)
SELECT pay, ds, round(y, 2) AS y, round(greatest(exp(f) - 1, 0)) AS yhat, round(greatest(exp(f - {forecast.Z80} * s) - 1, 0)) AS yhat_lower,
  round(greatest(exp(f + {forecast.Z80} * s) - 1, 0)) AS yhat_upper, is_future FROM fitted JOIN spread USING (pay)"""
    )


@query("trend_forecast", DAILY + CALENDAR + _least_squares_sql())
def trend_forecast(spark, sf):
    """With calendar regressors known ahead, in whole units of revenue."""
    weeks = flagged(spark, sf)
    ahead = sr.future_weeks(weeks, 4, S).drop("step")
    ahead = sr.calendar_regressors(ahead, sr.yearly_days(weeks, HOLIDAYS), sr.school_days(weeks))
    table = forecast.trend_forecast(weeks, 4, ["is_nat", "is_school"], ahead, [CHANGE], 4, S)
    return rounded(table, y=2, yhat=0, yhat_lower=0, yhat_upper=0)


def _lagged(spark, sf):
    weeks = sr.weekly_revenue(sr.daily_revenue(views.sales(spark, sf)))
    marked = sr.calendar_regressors(weeks, sr.yearly_days(weeks, HOLIDAYS), sr.school_days(weeks))
    return sr.holdout_last(sr.add_lags(marked, 3), 4)


@query("tree_forecast_table")
def tree_forecast_table(spark, sf):
    """Errors of forest and boosted trees on the last four weeks."""
    train, test = _lagged(spark, sf)
    return sr.model_table(
        forest=sr.forecast_errors(forecast.forest_forecast(train, test)),
        boosted=sr.forecast_errors(forecast.boosted_forecast(train, test)),
    )
