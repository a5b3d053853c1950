"""Daily series operators against pandas, plus structural properties."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesmart.operators import series as ts


@pytest.fixture(scope="module")
def gappy(spark):
    # two lines on day 0, gap on days 2-4, duplicate days, a null date, last day present
    rows = [(dt.date(2020, 1, 1), 10.0), (dt.date(2020, 1, 1), 20.0), (dt.date(2020, 1, 2), 30.0),
            (dt.date(2020, 1, 6), 50.0), (dt.date(2020, 1, 6), 70.0), (None, 999.0),
            (dt.date(2020, 1, 8), None), (dt.date(2020, 1, 9), 90.0)]
    return spark.createDataFrame(rows, "order_date date, sales double")


def test_daily_mean_and_interpolation_match_pandas(gappy):
    pdf = gappy.toPandas().dropna(subset=["order_date"])
    s = pdf.set_index(pd.to_datetime(pdf["order_date"]))["sales"]
    want = s.resample("D").mean().interpolate(method="linear")
    got = ts.daily_series(gappy).orderBy("idx").toPandas()
    assert len(got) == len(want) == 9
    assert np.allclose(got["y"].to_numpy(dtype=float), want.to_numpy(), equal_nan=True)


def test_leading_null_stays_trailing_takes_last(spark):
    rows = [("s", dt.date(2020, 1, 1), 0, None), ("s", dt.date(2020, 1, 2), 1, 4.0),
            ("s", dt.date(2020, 1, 3), 2, None), ("s", dt.date(2020, 1, 4), 3, 8.0),
            ("s", dt.date(2020, 1, 5), 4, None)]
    df = spark.createDataFrame(rows, "series_id string, ds date, idx bigint, y double")
    got = [r.y for r in ts.interpolate_linear(df).orderBy("idx").collect()]
    assert got == [None, 4.0, 6.0, 8.0, 8.0]


def _walk(spark, n=200, seed=3, series="s"):
    rng = np.random.default_rng(seed)
    y = 100 + np.cumsum(rng.normal(0, 1, n)) + 5 * np.sin(np.arange(n) * 2 * np.pi / 7)
    d0 = dt.date(2021, 1, 1)
    rows = [(series, d0 + dt.timedelta(days=i), i, float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_id string, ds date, idx bigint, y double"), y


def test_decomposition_adds_up_and_matches_definition(spark):
    df, y = _walk(spark)
    out = ts.decompose_additive(df, 7).orderBy("idx").toPandas()
    full = out.dropna(subset=["trend"])
    assert np.allclose(full["trend"] + full["seasonal"] + full["resid"], full["y"])
    trend = pd.Series(y).rolling(7, center=True).mean()
    assert np.allclose(out["trend"].to_numpy(dtype=float), trend.to_numpy(), equal_nan=True)
    det = pd.Series(y) - trend
    pm = np.array([np.nanmean(det[i::7]) for i in range(7)])
    pm -= pm.mean()
    assert np.allclose(out["seasonal"].to_numpy(dtype=float), np.tile(pm, 40)[:200])
    assert out["trend"].isna().sum() == 6


def test_even_period_decomposition(spark):
    df, y = _walk(spark, n=48)
    out = ts.decompose_additive(df, 4).orderBy("idx").toPandas()
    filt = np.array([0.5, 1, 1, 1, 0.5]) / 4
    trend = np.convolve(y, filt, mode="valid")
    assert np.allclose(out["trend"].to_numpy(dtype=float)[2:-2], trend)


def test_split_is_disjoint_complete_and_sized(spark):
    df, _ = _walk(spark, n=101)
    out = ts.random_split(df, 42).toPandas()
    counts = out["split"].value_counts().to_dict()
    assert counts == {"train": 60, "test": 20, "validate": 21}
    assert out["idx"].is_unique


def test_acf_matches_numpy(spark):
    df, y = _walk(spark, n=150)
    got = {r.lag: r.acf for r in ts.acf(df, "y", 5).collect()}
    c = y - y.mean()
    for k in range(1, 6):
        assert got[k] == pytest.approx(np.sum(c[k:] * c[:-k]) / np.sum(c * c))


def test_series_per_group(spark, gappy):
    two = gappy.withColumn("region", F.lit("r1")).unionByName(gappy.withColumn("region", F.lit("r2")))
    out = ts.daily_series(two, series_cols=["region"])
    assert {r.series_id for r in out.select("series_id").distinct().collect()} == {"r1", "r2"}
    assert out.count() == 18


def test_baselines_and_rmse(spark):
    df, y = _walk(spark, n=60)
    got = ts.rmse(ts.seasonal_naive(df, 7)).collect()[0]
    assert got.n == 53
    assert got.rmse == pytest.approx(np.sqrt(np.mean((y[7:] - y[:-7]) ** 2)))
    ma = ts.rmse(ts.moving_average(df, 7)).collect()[0]
    want = [np.mean(y[i - 7:i]) for i in range(7, 60)]
    assert ma.rmse == pytest.approx(np.sqrt(np.mean((y[7:] - np.array(want)) ** 2)))


def test_series_keys_never_collide(spark):
    day = dt.date(2020, 1, 1)
    rows = [("B", "C|D", 1.0), ("B|C", "D", 9.0), ("A", None, 5.0), (None, "A", 5.0), ("a\\", "b", 2.0), ("a", "\\b", 4.0)]
    df = spark.createDataFrame([(a, b, day, v) for a, b, v in rows], "a string, b string, order_date date, sales double")
    got = {r.series_id: r.y for r in ts.daily_mean(df, series_cols=["a", "b"]).collect()}
    assert sorted(got.values()) == [1.0, 2.0, 4.0, 9.0]


def test_residual_diagnostics_against_numpy(spark):
    from statistics import NormalDist
    rng = np.random.default_rng(5)
    series = {"a": rng.normal(3, 2, 400), "b": np.repeat(rng.normal(size=30), 10), "hot": np.r_[np.zeros(200), rng.normal(size=100)],
              "flat": np.full(20, 4.0), "one": [1.0]}
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)] + [("a", 9999, None), ("none", 0, None)]
    df = spark.createDataFrame(rows, "series_id string, idx bigint, resid double").repartition(4)
    qq, density = ts.normal_qq(df).collect(), ts.kernel_density(df).collect()
    assert {r.series_id for r in qq} == {r.series_id for r in density} == {"a", "b", "hot"}
    for name in ("a", "b", "hot"):
        z = np.sort((series[name] - np.mean(series[name])) / np.std(series[name], ddof=1))
        got = sorted((r.place, r.theoretical, r.sample) for r in qq if r.series_id == name)
        assert [g[0] for g in got] == list(range(1, len(z) + 1))
        assert np.allclose([g[1] for g in got], [NormalDist().inv_cdf(i / (len(z) + 1)) for i in range(1, len(z) + 1)])
        assert np.allclose([g[2] for g in got], z)
        h = len(z) ** -0.2
        for r in density:  # unbinned kernel sums: bins move values by half a bin at most
            if r.series_id == name:
                want = np.exp(-((r.z - z) / h) ** 2 / 2).mean() / (h * np.sqrt(2 * np.pi))
                assert abs(r.density - want) < 0.01
    assert ts.normal_qq(df.limit(0)).count() == ts.kernel_density(df.limit(0)).count() == 0
