"""Mart semantics on hand-written rows (null keys, all-null groups, ties, rounding)."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators import geo, marts
from salesmart.session import scratch_path

EDGE_SCHEMA = "customer_name string, city string, state string, category string, sub_category string, sales double"


@pytest.fixture(scope="module")
def edges(spark):
    rows = [
        ("ann", "Springfield", "Ohio", "A", "a1", 0.285),
        ("bob", "Springfield", "Oregon", "A", "a2", 0.125),
        (None, "Dover", "Ohio", "B", "b1", 100.0),       # null key
        ("cat", "Dover", "Ohio", "B", "b1", None),       # all-null group for 'cat'
        ("dan", "Salem", "Oregon", "B", "b2", 2.9),
        ("eve", "Salem", "Oregon", "C", "c1", -2.9),
        ("fay", "Austin", "Texas", "C", "c2", 5.0),
        ("gus", "Austin", "Texas", "C", "c2", 5.0),       # tie with fay at 5.0
    ]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def test_null_key_dropped_and_all_null_group_is_zero(edges):
    out = {r.customer_name: r.sales for r in marts.group_sum(edges, ["customer_name"]).collect()}
    assert None not in out
    assert out["cat"] == 0.0


def test_rounding_is_half_even_after_cut(edges):
    out = {r.customer_name: r.sales for r in marts.top_n(edges, ["customer_name"], 20, "round2").collect()}
    assert out["ann"] == 0.28 and out["bob"] == 0.12


def test_ties_broken_by_key(edges):
    out = [r.customer_name for r in marts.top_n(edges, ["customer_name"], 1).collect()]
    assert out == ["fay"]


def test_int_post_truncates_toward_zero(edges):
    out = {r.customer_name: r.sales for r in marts.top_n(edges, ["customer_name"], None, "int").collect()}
    assert out["dan"] == 2 and out["eve"] == -2


def test_same_city_in_two_states_merges(edges):
    out = {r.city: r.sales for r in marts.top_n(edges, ["city"], 20, "round2").collect()}
    assert out["Springfield"] == 0.41


def test_sub_categories_all_is_sum_of_truncated_top(edges):
    a5 = marts.mart(edges, "top_sub_categories").collect()
    a6 = {r.category: r.sales for r in marts.top_sub_categories_all(edges).collect()}
    expect = {}
    for r in a5:
        expect[r.category] = expect.get(r.category, 0) + r.sales
    assert a6 == expect


def test_rollup_total_row(edges):
    rows = marts.mart_totals(edges, "category").collect()
    total = [r for r in rows if r.is_total][0]
    assert total.category is None
    assert total.sales == pytest.approx(sum(r.sales for r in rows if not r.is_total))
    assert total.label == "$" + str(int(total.sales))


def test_share_sums_to_one(edges):
    shares = [r.share for r in marts.share_of_total(edges, "category").collect()]
    assert sum(shares) == pytest.approx(1.0, abs=1e-3)


def test_share_of_a_zero_total_is_null(edges):
    rows = marts.share_of_total(edges.withColumn("sales", F.lit(0.0)), "category").collect()
    assert len(rows) == 3 and all(r.share is None for r in rows)
    assert marts.share_of_total(edges.limit(0), "category").count() == 0


def test_grouped_sums_hold_every_key_set_from_one_scan(spark, edges):
    path = scratch_path(spark, "t-edges")
    edges.write.parquet(path)
    lines = spark.read.parquet(path)
    sets = [["customer_name"], ["category", "sub_category"], ["category"]]
    sums = marts.grouped_sums(lines, sets)
    assert sums._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    for keys in sets:
        got = marts.group_sum(marts.of_keys(sums, keys), keys).collect()
        assert sorted(got) == sorted(marts.group_sum(lines, keys).collect())
    nobody = marts.of_keys(sums, ["customer_name"]).where("customer_name IS NULL").first()
    assert (nobody["lines"], nobody["n"], float(nobody["sales"])) == (1, 1, 100.0)


def test_top_n_per_group(edges):
    out = marts.top_n_per_group(edges, ["state"], ["customer_name"], 1, post="none").collect()
    by_state = {r.state: r.customer_name for r in out}
    assert by_state["Texas"] == "fay" and by_state["Oregon"] == "dan"
    assert all(r.rank == 1 for r in out)


def test_state_codes_join_by_name(spark, edges):
    lookup = spark.createDataFrame([("Ohio", "OH"), ("Texas", "TX"), ("Utah", "UT")],
                                   "state string, state_code string")
    out = {r.state: r.state_code for r in geo.sales_by_state(edges, lookup).collect()}
    assert out == {"Ohio": "OH", "Oregon": None, "Texas": "TX"}


def test_us_lookup_is_the_fixed_list(spark):
    lk = geo.us_state_lookup(spark)
    assert lk.count() == 49
    codes = {r.state: r.state_code for r in lk.collect()}
    assert codes["Hawaii"] == "HI" and "Alaska" not in codes


def test_topk_plan_uses_take_ordered(spark, edges):
    plan = marts.top_n(edges, ["customer_name"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_per_group_limit_runs_before_shuffle(spark, edges):
    df = marts.top_n_per_group(edges, ["state"], ["customer_name"], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan
    assert df.where(F.col("rank") > 2).count() == 0
