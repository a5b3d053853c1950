"""SARIMA on simulated series with known structure."""

import datetime as dt
import math

import numpy as np
import pytest

from salesmart.operators import forecast


def _ar1(n, phi, seed):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    e = rng.normal(size=n)
    for t in range(1, n):
        y[t] = phi * y[t - 1] + e[t]
    return y


def test_sarima_recovers_ar1():
    fit = forecast.fit_sarima(_ar1(2000, 0.6, 3), (1, 0, 0), (0, 0, 0, 12))
    assert fit["params"][0] == pytest.approx(0.6, abs=0.05) and fit["converged"]
    assert fit["sigma2"] == pytest.approx(1.0, rel=0.1)


def test_sarima_recovers_ma1():
    rng = np.random.default_rng(4)
    e = rng.normal(size=3001)
    y = e[1:] + 0.5 * e[:-1]
    fit = forecast.fit_sarima(y, (0, 0, 1), (0, 0, 0, 12))
    assert fit["params"][0] == pytest.approx(0.5, abs=0.05)


def test_sarima_seasonal_model_beats_naive_on_seasonal_series():
    rng = np.random.default_rng(5)
    n = 600
    pattern = np.tile([10, 12, 9, 14, 20, 25, 8, 11, 13, 9, 15, 18], n // 12 + 1)[:n]
    y = 100 + 0.05 * np.arange(n) + pattern + rng.normal(0, 1, n)
    fit = forecast.fit_sarima(y)
    yhat = y[fit["start"]:] - fit["resid"]
    rmse = np.sqrt(np.mean((y[fit["start"]:] - yhat) ** 2))
    naive = np.sqrt(np.mean((y[12:] - y[:-12]) ** 2))
    assert rmse < naive


def test_forecast_of_trend_continues_it():
    y = 5.0 + 2.0 * np.arange(100) + np.random.default_rng(6).normal(0, 0.01, 100)
    # (0,2,0): second differences are white noise -> straight-line extrapolation.
    fit = forecast.fit_sarima(y, (0, 2, 0), (0, 0, 0, 12))
    mean, se = forecast.forecast_path(y, fit, (0, 2, 0), (0, 0, 0, 12), 3)
    assert mean == pytest.approx([y[-1] + 2 * h for h in (1, 2, 3)], abs=0.2)
    assert se[0] < se[1] < se[2]


def test_grid_has_64_orders():
    grid = forecast.order_grid()
    assert len(grid) == 64 and len(set(grid)) == 64 and all(g[-1] == 12 for g in grid)


def _series_frame(spark, y, sid="s"):
    d0 = dt.date(2022, 1, 1)
    rows = [(sid, d0 + dt.timedelta(days=i), i, float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_id string, ds date, idx bigint, y double")


def test_spark_operators_end_to_end(spark):
    # Zero-mean series: like the reference's model, ours has no constant term.
    y = _ar1(300, 0.5, 7)
    df = _series_frame(spark, y).unionByName(_series_frame(spark, _ar1(300, 0.2, 8), "t"))
    coefs = forecast.sarima_coefficients(df, (1, 0, 0), (0, 0, 0, 12)).collect()
    phi = {r.series_id: r.coef for r in coefs if r.term == "ar.L1"}
    assert phi["s"] == pytest.approx(0.5, abs=0.15)
    fc = forecast.sarima_forecast(df, 7).collect()
    assert len(fc) == 14 and {r.prediction_date for r in fc if r.series_id == "s"} == {
        dt.date(2022, 1, 1) + dt.timedelta(days=299 + h) for h in range(1, 8)}
    assert all(r.predicted_sales == math.trunc(r.yhat) for r in fc)
    pred = forecast.sarima_predict(df, start="2022-03-01").collect()
    assert min(r.ds for r in pred) == dt.date(2022, 3, 1)
    assert all(r.lower < r.yhat < r.upper for r in pred)


def test_grid_search_marks_one_best_per_series(spark):
    df = _series_frame(spark, _ar1(200, 0.5, 9))
    grid = [(1, 0, 0, 0, 0, 0, 12), (0, 0, 1, 0, 0, 0, 12), (0, 0, 0, 0, 0, 0, 12)]
    out = forecast.sarima_grid(df, grid).collect()
    assert len(out) == 3 and sum(r.best for r in out) == 1
    best = [r for r in out if r.best][0]
    assert best.aic == min(r.aic for r in out) and (best.ar, best.ma) == (1, 0)


def test_grid_scores_every_order_on_the_same_sample():
    y = _ar1(400, 0.5, 11)
    grid = forecast.order_grid()
    start = max(forecast.conditioning(g[:3], g[3:]) for g in grid)
    assert start == 26
    n = {forecast.fit_sarima(y, g[:3], g[3:], score_from=start)["n_eff"] for g in grid[:8] + grid[-8:]}
    assert n == {400 - start}


def test_a_series_that_cannot_be_fitted_is_a_row_and_fails_no_other(spark):
    df = (_series_frame(spark, _ar1(300, 0.5, 7)).unionByName(_series_frame(spark, _ar1(10, 0.5, 7), "short"))
          .unionByName(_series_frame(spark, [], "none")).unionByName(spark.sql("SELECT 'nulls' AS series_id, DATE'2020-01-01' AS ds, 0L AS idx, CAST(NULL AS DOUBLE) AS y")))
    for out in (forecast.sarima_coefficients(df), forecast.sarima_predict(df), forecast.sarima_forecast(df, 7)):
        rows = out.collect()
        assert {r.series_id for r in rows if r.error} == {"short", "nulls"} and len([r for r in rows if r.error]) == 2
        assert {r.series_id for r in rows if r.error is None} == {"s"}
