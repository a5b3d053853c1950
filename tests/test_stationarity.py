"""ADF in column expressions against least squares in numpy, and the normal distribution against the standard library's."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.functions.normal import norm_cdf, norm_quantile
from salesmart.operators import stationarity


def _regress(x, lags, n):
    dx = np.diff(x)
    rows = np.arange(len(dx) - n, len(dx))
    cols = np.column_stack([np.ones(n), x[rows], *(dx[rows - j] for j in range(1, lags + 1))])
    beta, *_ = np.linalg.lstsq(cols, dx[rows], rcond=None)
    resid = dx[rows] - cols @ beta
    return beta, float(resid @ resid), cols


def _adf(x, maxlag=None):
    """(statistic, lag, observations, AIC), one least-squares fit per lag."""
    x = np.asarray(x, float) - np.mean(x)
    n = len(x)
    top = min(n // 2 - 2, math.ceil(12 * (n / 100) ** 0.25) if maxlag is None else maxlag)
    m = n - 1 - top
    aics = [m * (math.log(2 * math.pi) + math.log(_regress(x, p, m)[1] / m) + 1) + 2 * (p + 2) for p in range(top + 1)]
    p = int(np.argmin(aics))
    beta, ssr, cols = _regress(x, p, n - 1 - p)
    se = math.sqrt(ssr / (len(cols) - p - 2) * np.linalg.inv(cols.T @ cols)[1, 1])
    return beta[1] / se, p, len(cols), aics[p]


def _frame(spark, series):
    rows = [(k, i, v if v is None else float(v)) for k, x in series.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "series_id string, idx bigint, y double").repartition(4)


def _series():
    rng = np.random.default_rng(3)
    e = rng.normal(size=(6, 800))
    ar2, season = np.zeros(800), 10 * np.sin(np.arange(400) * 2 * np.pi / 7)
    for t in range(2, 800):
        ar2[t] = 0.5 * ar2[t - 1] - 0.3 * ar2[t - 2] + e[0, t]
    return {"noise": e[1, :500], "walk": np.cumsum(e[2, :500]), "lagged": np.cumsum(ar2), "level": 38_000 + 1000 * e[3, :700],
            "season": season + e[4, :400], "tiny": e[5, :9], "nine": e[5, :60] * 1e-6, "trend": np.arange(120) + e[5, :120]}


@pytest.mark.parametrize("maxlag", [None, 0, 3])
def test_statistic_lag_and_aic(spark, maxlag):
    series = _series()
    got = {r.series_id: r for r in stationarity.adf_test(_frame(spark, series), maxlag).collect()}
    assert set(got) == set(series)
    for name, x in series.items():
        stat, lag, n, aic = _adf(x, maxlag)
        r = got[name]
        assert (r.used_lag, r.nobs, r.reason) == (lag, n, None), name
        assert (r.adf_stat, r.ic_best) == (pytest.approx(stat, rel=1e-7), pytest.approx(aic, rel=1e-9)), name
        assert [r.stationary_1pct, r.stationary_5pct, r.stationary_10pct] == [stat < c for c in (r.crit_1pct, r.crit_5pct, r.crit_10pct)]
    if maxlag is None:
        assert got["noise"].p_value < 0.01 < got["walk"].p_value and got["lagged"].used_lag >= 2


def test_series_without_a_statistic_say_why(spark):
    series = {"short": [1, 2, 1], "constant": [3] * 50, "line": 2.0 * np.arange(60), "nulls": [None, None], "one": [5.0],
              "nan": [float("nan")] * 30, "good": np.random.default_rng(1).normal(size=80)}
    got = {r.series_id: r for r in stationarity.adf_test(_frame(spark, series)).collect()}
    assert set(got) == set(series)
    for name, r in got.items():
        assert (r.reason is None) == (name == "good") == (r.adf_stat is not None), name
        if name != "good":
            assert [r.p_value, r.used_lag, r.nobs, r.ic_best, r.crit_5pct, r.stationary_5pct] == [None] * 6
    assert got["short"].reason.startswith("too few") and "constant" in got["constant"].reason
    assert stationarity.adf_test(_frame(spark, {"x": [1.0]}).limit(0)).count() == 0


def test_missing_days_are_left_out(spark):
    x = np.random.default_rng(4).normal(size=90)
    gappy = [v if i % 9 else None for i, v in enumerate(x)]
    got = stationarity.adf_test(_frame(spark, {"s": gappy})).first()
    stat, lag, *_ = _adf([v for v in gappy if v is not None])
    assert got.adf_stat == pytest.approx(stat) and got.used_lag == lag


def test_no_python_worker_and_no_single_task(spark):
    plan = stationarity.adf_test(_frame(spark, _series()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def test_mackinnon_p_at_critical_values(spark):
    crit = [c[0] for c in stationarity.CRITICAL_2010.values()]
    df = spark.createDataFrame([(x,) for x in [*crit, -30.0, 3.0, None]], "x double")
    got = [r[0] for r in df.select(stationarity.mackinnon_p(F.col("x"))).collect()]
    assert got[:3] == [pytest.approx(0.01, abs=0.002), pytest.approx(0.05, abs=0.003), pytest.approx(0.10, abs=0.005)]
    assert got[3:] == [0.0, 1.0, None]


def test_normal_distribution(spark):
    xs = [-9.0, -6.6, -6.4, -3.0, -0.1, 0.0, 0.5, 2.0, 6.0, 7.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", norm_cdf(F.col("x")).alias("p")).collect():
        assert r.p == pytest.approx(NormalDist().cdf(r.x), abs=1e-14)
    ps = [1e-6, 1e-4, 0.01, 0.2, 0.5, 0.7, 0.999]
    got = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, None, -1.0]], "p double").select(norm_quantile(F.col("p"))).collect()
    assert [r[0] for r in got] == [*(pytest.approx(NormalDist().inv_cdf(p), abs=1e-9) for p in ps), None, None, None, None]
