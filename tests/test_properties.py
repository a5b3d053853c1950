"""Property tests (hypothesis) for mart, series and correlation invariants."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.operators import marts
from salesmart.operators import series as ts
from salesmart.operators.correlate import one_hot_corr

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

cents = st.integers(min_value=0, max_value=10_000_00).map(lambda c: c / 100)
line = st.tuples(st.sampled_from(["A", "B", "C", None]), st.sampled_from(["x", "y", "z", "w"]),
                 st.one_of(st.none(), cents))


@SETTINGS
@given(st.lists(line, min_size=1, max_size=40))
def test_topk_never_exceeds_total_and_a6_is_sum_of_a5(spark, rows):
    df = spark.createDataFrame(rows, "category string, sub_category string, sales double")
    total = sum(r[2] for r in rows if r[2] is not None and r[0] is not None)
    top = marts.top_n(df, ["category"], 2).collect()
    assert sum(r.sales for r in top) <= total + 1e-6
    a5 = marts.mart(df, "top_sub_categories").collect()
    a6 = {r.category: r.sales for r in marts.top_sub_categories_all(df).collect()}
    expect = {}
    for r in a5:
        expect[r.category] = expect.get(r.category, 0) + r.sales
    assert a6 == expect


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3)), min_size=3, max_size=40))
def test_interpolation_keeps_observations(spark, ys):
    d0 = dt.date(2020, 1, 1)
    rows = [("s", d0 + dt.timedelta(days=i), i, y) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "series_id string, ds date, idx bigint, y double")
    out = [r.y for r in ts.interpolate_linear(df).orderBy("idx").collect()]
    first = next((i for i, y in enumerate(ys) if y is not None), None)
    for i, (a, b) in enumerate(zip(ys, out)):
        if a is not None:
            assert b == pytest.approx(a)
        elif first is None or i < first:
            assert b is None
        else:
            assert b is not None


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3), min_size=15, max_size=60))
def test_decomposition_and_split_invariants(spark, ys):
    d0 = dt.date(2020, 1, 1)
    rows = [("s", d0 + dt.timedelta(days=i), i, y) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "series_id string, ds date, idx bigint, y double")
    for r in ts.decompose_additive(df, 7).collect():
        if r.trend is not None:
            assert r.trend + r.seasonal + r.resid == pytest.approx(r.y, abs=1e-6)
    split = ts.random_split(df).collect()
    n = len(ys)
    counts = {k: sum(1 for r in split if r.split == k) for k in ("train", "test", "validate")}
    assert counts["train"] == int(0.6 * n) and sum(counts.values()) == n


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), cents), min_size=4, max_size=40))
def test_correlation_symmetric_and_bounded(spark, rows):
    df = spark.createDataFrame(rows, "seg string, sales double")
    got = {(r.pos_x, r.pos_y): r.r for r in one_hot_corr(df, "seg", "sales").collect()}
    for (i, j), r in got.items():
        other = got[(j, i)]
        assert (r is None) == (other is None)
        if r is not None:
            assert r == pytest.approx(other) and -1 - 1e-9 <= r <= 1 + 1e-9
