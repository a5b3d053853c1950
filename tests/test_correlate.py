"""One-hot correlation against pandas get_dummies().corr()."""

import numpy as np
import pandas as pd
import pytest

from salesmart.operators.correlate import one_hot, one_hot_corr
from salesmart.plans import QUERIES


def _pandas_matrix(pdf):
    wide = pd.get_dummies(pdf[["sales", "seg"]], columns=["seg"], dtype=float)
    wide.columns = ["sales"] + [c for c in wide.columns[1:]]
    return wide.corr()


def test_matches_pandas_pairwise_complete(spark):
    rng = np.random.default_rng(7)
    seg = rng.choice(["a", "b", "c", "d"], 300).astype(object)
    seg[::17] = None                                   # null category: all-zero row
    sales = rng.gamma(2.0, 50.0, 300) + (seg == "b") * 30.0
    sales[::23] = np.nan                               # null sales: dropped from sales pairs only
    pdf = pd.DataFrame({"seg": seg, "sales": sales})
    df = spark.createDataFrame(pdf.astype({"seg": object}).where(pdf.notna(), None))
    got = {(r.feature_x, r.feature_y): r.r for r in one_hot_corr(df, "seg", "sales").collect()}
    want = _pandas_matrix(pdf)
    for x in want.index:
        for y in want.columns:
            assert got[(x, y)] == pytest.approx(want.loc[x, y], abs=1e-4), (x, y)


def test_upper_triangle_mask_and_symmetry(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0), ("c", 5.0)], "seg string, sales double")
    rows = one_hot_corr(df, "seg", "sales").collect()
    r = {(x.pos_x, x.pos_y): x for x in rows}
    for (i, j), row in r.items():
        assert row.r == pytest.approx(r[(j, i)].r)
        assert row.r_upper == (row.r if i < j else 0.0)
        assert row.r is None or -1.0 - 1e-9 <= row.r <= 1.0 + 1e-9


def test_zero_variance_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "seg string, sales double")
    got = {(r.feature_x, r.feature_y): r.r for r in one_hot_corr(df, "seg", "sales").collect()}
    assert got[("seg_a", "seg_a")] is None and got[("sales", "seg_a")] is None
    assert got[("sales", "sales")] == 1.0


def test_lines_are_scanned_once(spark, data_dir):
    for name in ("corr_segment", "corr_category", "corr_ship_mode"):
        plan = QUERIES[name](spark, data_dir)._jdf.queryExecution().executedPlan().toString()
        scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "l_extendedprice" in ln]
        assert len(scans) == 1, name


def test_too_many_values_is_an_error(spark):
    df = spark.createDataFrame([(str(i), 1.0) for i in range(9)], "seg string, sales double")
    with pytest.raises(Exception, match="more than 5 values"):
        one_hot_corr(df, "seg", "sales", max_values=5).collect()


def test_one_hot_frame(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", 3.0)], "seg string, sales double")
    got = {tuple(r) for r in one_hot(df, "seg", ["a", "b"]).collect()}
    assert got == {(1.0, 1, 0), (2.0, 0, 0), (3.0, 0, 1)}
    with pytest.raises(Exception, match="not listed"):
        one_hot(df, "seg", ["a"]).collect()
