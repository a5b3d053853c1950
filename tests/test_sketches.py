"""Day sketches: exact counts and ends, estimates within the stated errors over hot and uniform columns, any span of days."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators import sketches

DAY = dt.date(2020, 1, 1)
COLS = "order_date date, hot double, uniform double, shipped date, city string, code int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    out = []
    for i in range(30_000):
        day = None if r.random() < 0.02 else DAY + dt.timedelta(3 if r.random() < 0.33 else r.randrange(9))
        hot = None if r.random() < 0.1 else float("nan") if r.random() < 0.01 else 5.0 if r.random() < 0.5 else r.gauss(0, 100)
        city = None if r.random() < 0.05 else "hot" if r.random() < 0.33 else f"c{int(r.paretovariate(0.7)) % 4000}"
        out.append((day, hot, r.random() * 1e6, DAY + dt.timedelta(r.randrange(900)), city, r.randrange(2000)))
    return out


@pytest.fixture(scope="module")
def days(spark, rows):
    df = spark.createDataFrame(rows, COLS).repartition(5)
    return sketches.day_sketches(df, ["hot", "uniform", "shipped"], ["city", "code"]).cache()


@pytest.mark.parametrize("span", [None, (0, 2), (3, 3)])
def test_any_days_are_within_the_bounds(days, rows, span):
    some = days
    if span:
        low, high = (DAY + dt.timedelta(x) for x in span)
        some, rows = days.where(F.col("day").between(low, high)), [r for r in rows if r[0] and low <= r[0] <= high]
    probs = (0.01, 0.25, 0.5, 0.9)
    got = {r.column_name: r for r in sketches.number_profile(some, ["hot", "uniform", "shipped"], probs).collect()}
    for i, c in enumerate(("hot", "uniform", "shipped"), 1):
        v = sorted((r[i] - dt.date(1970, 1, 1)).days if c == "shipped" else r[i] for r in rows if r[i] is not None and r[i] == r[i])
        g = got[c]
        assert (g.lines, g.n, g.low, g.high) == (len(rows), len(v), v[0], v[-1])
        for p, q in zip(probs, (g.q0, g.q1, g.q2, g.q3)):
            under, upto = sum(x < q for x in v) / len(v), sum(x <= q for x in v) / len(v)
            assert under - 2 * sketches.rank_error() <= p <= upto + 2 * sketches.rank_error(), (c, p)
    items = {r.column_name: r for r in sketches.item_profile(some, ["city", "code"], 3).collect()}
    for i, c in ((4, "city"), (5, "code")):
        counts = collections.Counter(str(r[i]) for r in rows if r[i] is not None)
        n = sum(counts.values())
        assert items[c].n == n and abs(items[c].different - len(counts)) <= 4 * sketches.distinct_error() * len(counts)
        for x in items[c].frequent:
            assert abs(x["count"] - counts[x.item]) <= sketches.count_error() * n + 1
    assert items["city"].frequent[0].item == "hot"


def test_a_replaced_day_replaces_its_row(spark, days, rows):
    day = DAY + dt.timedelta(3)
    new = spark.createDataFrame([(day, 1.0, 2.0, day, "new", 1)] * 7, COLS)
    merged = days.where(F.col("day").isNull() | (F.col("day") != F.lit(day))).unionByName(
        sketches.day_sketches(new, ["hot", "uniform", "shipped"], ["city", "code"]))
    got = sketches.number_profile(merged, ["uniform"]).first()
    assert got.lines == got.n == sum(r[0] != day for r in rows) + 7


def test_nothing_and_only_nulls(spark):
    none = sketches.day_sketches(spark.createDataFrame([], COLS), ["hot"], ["city"])
    assert none.count() == 0
    nulls = sketches.day_sketches(spark.createDataFrame([(DAY, None, None, None, None, None)], COLS), ["hot", "shipped"], ["city"])
    got = sketches.number_profile(nulls, ["hot", "shipped"]).collect()
    assert [(r.lines, r.n, r.low, r.q0) for r in got] == [(1, 0, None, None)] * 2
    item = sketches.item_profile(nulls, ["city"]).first()
    assert (item.n, item.different, item.frequent) == (0, 0, [])


def test_one_scan_combined_in_every_task(spark, rows):
    df = spark.createDataFrame(rows[:50], COLS)
    plan = sketches.day_sketches(df, ["hot"], ["city"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_kll_sketch_agg_double" in plan and "SinglePartition" not in plan
