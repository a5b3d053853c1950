"""Scale rules: hot keys, bounded broadcasts, partial aggregation before shuffles."""

import pandas as pd
from pyspark.sql import functions as F

from salesmart.operators import marts, quality
from salesmart.sources.star import sales_view
from salesmart.sources.tables import Tables


def _skewed(spark, n=3000):
    # customer 0 holds a third of all lines
    rows = [(0 if i % 3 == 0 else i, f"c{0 if i % 3 == 0 else i}", float(i % 97) + 0.25) for i in range(n)]
    return spark.createDataFrame(rows, "custkey long, customer_name string, sales double")


def test_hot_key_result_is_whole(spark):
    df = _skewed(spark)
    top = marts.top_n(df, ["customer_name"], 1).collect()[0]
    want = pd.DataFrame(df.collect(), columns=df.columns).groupby("customer_name")["sales"].sum()
    assert top.customer_name == "c0" and top.sales == want["c0"]


def test_partial_aggregation_precedes_the_shuffle(spark):
    plan = marts.group_sum(_skewed(spark), ["customer_name"])._jdf.queryExecution() \
        .executedPlan().toString()
    lines = [ln.strip() for ln in plan.splitlines()]
    ex = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
    assert any("partial_sum" in ln for ln in lines[ex:])   # map-side combine below the exchange


def test_building_a_view_runs_no_job_and_has_no_hint(spark, data_dir):
    tables = Tables(spark, data_dir)
    sales_view(tables)  # opens the tables (reads their footers)
    spark.sparkContext.setJobGroup("build", "build")
    view = sales_view(tables)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Hint" not in view._jdf.queryExecution().logical().toString()


def test_sales_view_without_broadcasts(spark, data_dir):
    want = sorted(sales_view(Tables(spark, data_dir)).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = sales_view(Tables(spark, data_dir))
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(df.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_exact_quantile_with_a_third_of_rows_equal(spark):
    vals = [5.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = quality.exact_quantiles(df, "x", (0.5,)).collect()[0]["q0"]
    assert got == pd.Series(vals).quantile(0.5)


def test_no_row_caps_on_marts_without_k(spark):
    df = _skewed(spark)
    assert marts.top_n(df, ["customer_name"]).count() == df.select("customer_name").distinct().count()
    assert df.where(F.col("custkey") == 0).count() == 1000
