"""Registered model queries (T5-T6 ADF, T8-T15 SARIMA).

The SARIMA fits are iterative; they carry no SQL oracle (the driver records a
rows-only check) and are covered by tests on simulated series. The ADF oracle
finds the same regressions another way: it takes each regressor out of the
columns behind it, one after the other, instead of factoring a Gram matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import round4
from salesmart.operators import forecast, series as ts, stationarity
from salesmart.plans.registry import query, with_sales
from salesmart.plans.timeseries import _SERIES_SQL, _r4
from salesmart.session import materialize
from salesmart.sources.star import star_sum
from salesmart.sources.tables import Tables


def _series(t: Tables) -> DataFrame:
    """Daily series from per-order partial sums and counts (eager aggregation),
    checkpointed in front of the model fits."""
    return materialize(ts.daily_series(star_sum(t, ["order_date"], counts=True), count_col="n"))


def _taken_out(name: str, start: str) -> str:
    """Recursive CTE: columns ``c`` of ``start`` with the first k regressors taken out of the rest."""
    return f"""
, {name} AS (
  SELECT series_id, 0 AS k, c FROM {start}
  UNION ALL
  SELECT series_id, k + 1, list_transform(range(1, len(c)), lambda j: list_transform(c[j + 1], lambda v, i: v - f[j] * c[1][i]))
  FROM (SELECT *, list_transform(c[2:], lambda x: list_dot_product(c[1], x) / list_dot_product(c[1], c[1])) AS f FROM {name} WHERE len(c) > 1))"""


def _poly_sql(x: str, coefficients) -> str:
    return " + ".join(f"({c}) * power({x}, {i})" for i, c in enumerate(coefficients))


def _cdf_sql(z: str) -> str:
    """The same series as ``functions.normal.norm_cdf``, with its double factorials written out."""
    terms = f"list_sum(list_transform(range(0, 100), lambda k: power({z}, 2 * k + 1) * sqrt(pi()) / (power(2.0, k + 1) * gamma(k + 1.5))))"
    return f"(0.5 + exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {terms})"


_ADF_SQL = with_sales(_SERIES_SQL + f"""
, v AS (SELECT series_id, list(y ORDER BY idx) FILTER (y IS NOT NULL) AS y, CAST(count(y) AS BIGINT) AS n FROM di GROUP BY series_id)
, d AS (SELECT *, list_transform(y[2:], lambda b, i: b - y[i]) AS dy,
               CAST(least(n // 2 - 2, ceil(12 * power(n / 100.0, 0.25))) AS BIGINT) AS p FROM v)
, start_ AS (SELECT series_id, [list_transform(range(n - 1 - p), lambda i: 1.0), y[p + 1:n - 1]]
                    || list_transform(range(1, p + 1), lambda j: dy[p + 1 - j:n - 1 - j]) || [dy[p + 1:n - 1]] AS c FROM d)"""
+ _taken_out("steps", "start_") + """
, scores AS (SELECT series_id, k - 2 AS lag, len(c[1]) AS m, list_dot_product(c[len(c)], c[len(c)]) AS ssr, k FROM steps WHERE k >= 2)
, best AS (SELECT DISTINCT ON (series_id) series_id, lag AS q, m * (ln(2 * pi()) + ln(ssr / m) + 1) + 2 * k AS aic FROM scores ORDER BY series_id, aic, lag)
, again_ AS (SELECT series_id, [list_transform(range(n - 1 - q), lambda i: 1.0)]
                    || list_transform(range(1, q + 1), lambda j: dy[q + 1 - j:n - 1 - j]) || [y[q + 1:n - 1], dy[q + 1:n - 1]] AS c
             FROM d JOIN best USING (series_id))"""
+ _taken_out("more", "again_") + f"""
, fit AS (SELECT series_id, q, aic, len(c[1]) AS nobs, list_dot_product(c[1], c[2]) AS xy, list_dot_product(c[1], c[1]) AS xx, list_dot_product(c[2], c[2]) AS yy
          FROM more JOIN best USING (series_id) WHERE len(c) = 2)
, r AS (SELECT *, xy / xx / sqrt((yy - xy * xy / xx) / (nobs - q - 2) / xx) AS t FROM fit)
, cr AS (SELECT *, {", ".join(f"{_poly_sql('(1.0 / nobs)', c)} AS c{k[:-1]}" for k, c in stationarity.CRITICAL_2010.items())},
                {_poly_sql("t", stationarity.SMALL_P)} AS zs, {_poly_sql("t", stationarity.LARGE_P)} AS zl FROM r)
SELECT series_id, {_r4("t")} AS adf_stat,
       {_r4(f"CASE WHEN t > {stationarity.TAU_MAX} THEN 1.0 WHEN t < {stationarity.TAU_MIN} THEN 0.0 WHEN t <= {stationarity.TAU_STAR} THEN {_cdf_sql('zs')} ELSE {_cdf_sql('zl')} END")} AS p_value,
       CAST(q AS BIGINT) AS used_lag, CAST(nobs AS BIGINT) AS nobs, {_r4("c1")} AS crit_1pct, {_r4("c5")} AS crit_5pct, {_r4("c10")} AS crit_10pct,
       {_r4("aic")} AS ic_best, t < c1 AS stationary_1pct, t < c5 AS stationary_5pct, t < c10 AS stationary_10pct, CAST(NULL AS VARCHAR) AS reason
FROM cr""").replace("WITH sales", "WITH RECURSIVE sales", 1)


@query("adf_test", _ADF_SQL)
def adf_test(t: Tables) -> DataFrame:
    """T5+T6: augmented Dickey-Fuller test of the daily series."""
    out = stationarity.adf_test(ts.daily_series(star_sum(t, ["order_date"], counts=True), count_col="n"))
    return out.select(*[round4(c).alias(c) if kind == "double" else c for c, kind in out.dtypes])


@query("sarima_grid")
def sarima_grid(t: Tables) -> DataFrame:
    """T8+T9: 64 SARIMA orders fitted in parallel, best AIC flagged."""
    return forecast.sarima_grid(_series(t))


@query("sarima_coefficients")
def sarima_coefficients(t: Tables) -> DataFrame:
    """SARIMA(1,1,1)(1,1,1,12) coefficient table."""
    return forecast.sarima_coefficients(_series(t))


@query("sarima_predictions")
def sarima_predictions(t: Tables) -> DataFrame:
    """T11+T12: one-step-ahead in-sample predictions with 95 % intervals."""
    return forecast.sarima_predict(_series(t))


@query("sarima_rmse")
def sarima_rmse(t: Tables) -> DataFrame:
    """RMSE of the in-sample predictions, joined to the truth by date."""
    s = _series(t)
    pred = forecast.sarima_predict(s).select("series_id", "ds", "yhat")
    joined = s.join(pred, ["series_id", "ds"])
    return ts.rmse(joined).withColumn("rmse", round4("rmse"))


@query("sarima_forecast")
def sarima_forecast(t: Tables) -> DataFrame:
    """T14+T15: 7-day forecast mart (prediction date, truncated sales)."""
    return forecast.sarima_forecast(_series(t), 7).orderBy("series_id", "prediction_date")


@query("sarima_forecast_by_region")
def sarima_forecast_by_region(t: Tables) -> DataFrame:
    """T14 per region: one daily series and one model per region, fitted in
    parallel (one applyInPandas group each)."""
    s = materialize(ts.daily_series(star_sum(t, ["order_date", "region"], counts=True),
                                    series_cols=["region"], count_col="n"))
    return forecast.sarima_forecast(s, 7)
