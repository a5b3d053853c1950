"""Top-k by threshold rounds: the rows of the full sum, whatever the signs and ties, and fewer rows shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators import marts, topk
from salesmart.session import scratch_path

COLS = "customer string, city string, sales double"


def _lines(kind, n=3000):
    r = random.Random(kind)
    rows = []
    for i in range(n):
        hot = r.random() < 0.33
        key = "hot" if hot else f"k{int(r.paretovariate(0.6)) % 900}"
        value = {"positive": r.randrange(1, 1000) / 4, "negative": r.randrange(-600, 1000) / 4, "all negative": -r.randrange(1, 100) / 4,
                 "ties": 1.0, "zeros": 0.0, "refunds": -2.5 if hot else 2.5}[kind]
        rows.append((r.choice([key, key, key, None]), r.choice(["a", "b", None]), None if r.random() < 0.1 else value))
    return rows


@pytest.mark.parametrize("kind,k", [("positive", 1), ("positive", 7), ("negative", 7), ("negative", 2000), ("all negative", 7), ("ties", 7),
                                    ("zeros", 7), ("refunds", 7)])
def test_same_rows_as_the_full_sum(spark, kind, k):
    df = spark.createDataFrame(_lines(kind), COLS).repartition(6)
    for keys in (["customer"], ["customer", "city"]):
        assert topk.top_n(df, keys, k, "round2").collect() == marts.top_n(df, keys, k, "round2").collect()


def test_no_lines(spark):
    assert topk.top_n(spark.createDataFrame([], COLS), ["customer"], 3).count() == 0


def test_keys_spread_thinly_over_parts(spark):
    """The winner is in no part's top k."""
    rows = [(f"p{p}x{i}", "a", 10.0 + i) for p in range(8) for i in range(5)] + [("winner", "a", 9.0)] * 8
    df = spark.createDataFrame([], COLS)
    for p in range(8):
        df = df.union(spark.createDataFrame(rows[5 * p:5 * p + 5] + rows[40 + p:41 + p], COLS).coalesce(1))
    got = topk.top_n(df, ["customer"], 2).collect()
    assert [r.customer for r in got] == ["winner", "p0x4"] and got == marts.top_n(df, ["customer"], 2).collect()


def test_few_rows_are_shuffled(spark):
    """40,000 keys whose sums fall off: rounds 2 and 3 touch a small share of the local sums."""
    df = spark.range(400_000).select((F.col("id") % 40_000).cast("string").alias("customer"),
                                     (F.lit(1e6) / (1 + F.col("id") % 40_000)).alias("sales")).repartition(8)
    path = scratch_path(spark, "t-local")
    local = topk.local_sums(df, ["customer"], path)
    all_rows = local.count()
    few = topk.candidates(local, ["customer"], 20)
    fetched = local.join(few, ["customer"], "left_semi").count()
    assert all_rows > 200_000 and few.count() < 400 and fetched < 0.02 * all_rows
    top = topk.top_n(df, ["customer"], 20).collect()
    assert top == marts.top_n(df, ["customer"], 20).collect()


def test_part_of_more_lines_than_a_fold(spark):
    """One task folds its lines more than once; the sums come declared without NULLs."""
    df = spark.range(0, 1_200_000, 1, 1).select(F.concat(F.lit("c"), F.col("id") % 50).alias("customer"), (F.col("id") % 7).cast("double").alias("sales"))
    assert topk.top_n(df, ["customer"], 5).collect() == marts.top_n(df, ["customer"], 5).collect()
