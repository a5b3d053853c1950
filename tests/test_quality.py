"""Profiles: exact distributed quantiles against pandas."""

import numpy as np
import pandas as pd
import pytest

from salesmart.operators import quality


def test_exact_quantiles_match_pandas_with_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(100, 20, 700).round(2), np.full(350, 42.0)])  # a third is one value
    pdf = pd.DataFrame({"x": vals})
    df = spark.createDataFrame(pdf)
    got = quality.exact_quantiles(df, "x", (0.1, 0.25, 0.5, 0.75, 0.99)).collect()[0]
    want = pdf["x"].quantile([0.1, 0.25, 0.5, 0.75, 0.99]).to_numpy()
    assert [got[f"q{i}"] for i in range(5)] == pytest.approx(list(want), abs=1e-9)


def test_numeric_profile_matches_describe(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 4.0, 10.0], "b": [5, 5, 5, 6, 7]})
    df = spark.createDataFrame(pdf)
    got = {(r.column_name, r.stat): r.value for r in quality.numeric_profile(df, ["a", "b"]).collect()}
    for c in ("a", "b"):
        d = pdf[c].describe()
        for stat in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
            assert got[(c, stat)] == pytest.approx(d[stat]), (c, stat)


def test_null_profile_and_info(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, None)], "a int, b string")
    nulls = {r.column_name: r.null_count for r in quality.null_profile(df).collect()}
    assert nulls == {"a": 1, "b": 2}
    info = [(r.position, r.column_name, r.dtype, r.non_null) for r in quality.frame_info(df).collect()]
    assert info == [(0, "a", "int", 2), (1, "b", "string", 1)]


def test_date_profile(spark):
    import datetime as dt
    d = [dt.date(2020, 1, 2), dt.date(2020, 1, 1), dt.date(2020, 1, 2), None, dt.date(2020, 1, 5)]
    df = spark.createDataFrame([(x,) for x in d], "d date")
    r = quality.date_profile(df, ["d"]).collect()[0]
    assert (r["count"], r["unique"], r.top, r.freq, r.first, r.last) == (
        4, 3, dt.date(2020, 1, 2), 2, dt.date(2020, 1, 1), dt.date(2020, 1, 5))


def test_quantiles_of_several_columns_with_signs_and_gaps(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(0, 1e6, 501), 2)
    b = rng.integers(-3, 4, 501).astype(float)
    rows = [(float(x), None if i % 5 == 0 else float(y), None) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {r["column_name"]: r for r in quality.quantiles(df, ["a", "b", "c"], probs).collect()}
    assert set(got) == {"a", "b"}
    for name, values in (("a", a), ("b", np.array([r[1] for r in rows if r[1] is not None]))):
        for i, q in enumerate(probs):
            assert abs(got[name][f"q{i}"] - np.quantile(values, q)) < 1e-9 * max(1.0, abs(np.quantile(values, q)))
    assert len(quality.numeric_profile(df, ["a", "c"]).collect()) == 16
