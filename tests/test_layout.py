"""The clustered layout keeps the table and lets a filter on any of its columns skip row groups."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from salesmart.session import scratch_path
from salesmart.sources import layout

COLS = "order_date date, customer string, product string, sales double"
BY = ["order_date", "customer", "product"]


def _rows(n, hot=0.0):
    r = random.Random(n)
    return [(dt.date(2020, 1, 1) + dt.timedelta(r.randrange(400)), "hot" if r.random() < hot else f"Customer#{r.randrange(2000):05}",
             f"part {r.randrange(3000):04}", r.random()) for _ in range(n)]


def _read(path, column, value):
    """Rows in row groups whose minimum and maximum let ``value`` be in them."""
    held = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += meta.row_group(g).num_rows
            held += meta.row_group(g).num_rows * (s is None or not s.has_min_max or s.min <= value <= s.max)
    return held / total


def test_every_filter_reads_a_small_share(spark):
    rows = _rows(60_000, 0.33)
    df = spark.createDataFrame(rows, COLS).repartition(4)
    clustered, sorted_ = scratch_path(spark, "t-clustered"), scratch_path(spark, "t-by-day")
    layout.write_clustered(df, clustered, BY, files=64)
    df.repartitionByRange(64, "order_date").sortWithinPartitions("order_date").write.parquet(sorted_)
    back = spark.read.parquet(clustered)
    assert back.columns == df.columns and back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    values = {"order_date": dt.date(2020, 7, 1), "customer": "Customer#01234", "product": "part 1234"}
    before, after = ({c: _read(path, c, v) for c, v in values.items()} for path in (sorted_, clustered))
    assert before["customer"] > 0.95 and before["product"] > 0.95  # by day alone: nothing to skip
    assert all(share < 0.5 for share in after.values()), after
    assert back.where(F.col("customer") == "Customer#01234").count() == sum(r[1] == "Customer#01234" for r in rows)


def test_nulls_empty_and_one_value(spark):
    none, path = spark.createDataFrame([], COLS), scratch_path(spark, "t-clustered-none")
    layout.write_clustered(none, path, BY)
    assert spark.read.schema(none.schema).parquet(path).count() == 0
    odd = spark.createDataFrame([(None, None, None, 1.0), (None, "", "é" * 9, 2.0), *[(dt.date(2020, 1, 1), "x", None, 3.0)] * 50], COLS)
    path = scratch_path(spark, "t-clustered-odd")
    layout.write_clustered(odd, path, BY)
    back = spark.read.parquet(path)
    assert back.exceptAll(odd).count() == odd.exceptAll(back).count() == 0



def test_ranks_rise_with_the_values(spark):
    names = ["", "a", "aa", "ab", "b", "é", "日本", "Customer#00010", "Customer#00009"]
    df = spark.createDataFrame([(s,) for s in names * 20], "s string")
    got = df.distinct().withColumn("k", layout.interleaved(df, layout.ranges(df, ["s"], 4), 4)).collect()
    ranks = [r.k for r in sorted(got, key=lambda r: r.s.encode())]
    assert ranks == sorted(ranks) and len(set(ranks)) >= 8


def test_ranks_are_searched_by_comparisons(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i), f"c{i % 97:02}", float(i)) for i in range(400)] + [(None, "é", float("nan")), (None, None, -0.0)]
    df = spark.createDataFrame(rows, "d date, s string, x double")
    for bits, searched in ((5, True), (8, False)):  # more bounds are counted in an array
        bounds = {**layout.ranges(df, ["d", "s"], bits), "x": [float(k) for k in range(1, 1 << bits)]}
        for c, cuts in bounds.items():
            held = df.select(c, layout.interleaved(df, {c: cuts}, bits).alias("k"))
            plan = held._jdf.queryExecution().optimizedPlan().toString()
            assert ("lambda" not in plan) == searched
            for v, k in held.collect():  # NaN is above all numbers
                assert k == (0 if v is None else sum(not v < x for x in cuts)), (c, v, k)


def test_rows_are_read_for_the_draw_and_for_the_write(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df, path = spark.createDataFrame(_rows(3000, 0.33), COLS).mapInArrow(count, COLS), scratch_path(spark, "t-clustered-read")
    layout.write_clustered(df, path, BY, files=8)
    assert seen.value == 6000 and spark.read.parquet(path).count() == 3000


def test_tasks_follow_the_order_and_share_a_cell(spark):
    rows = [(dt.date(2020, 1, 1), None if i % 10 == 0 else "hot" if i % 3 else f"é{i % 50}", f"part {i:05}", 1.0) for i in range(8000)]
    df = spark.createDataFrame(rows, COLS)
    for by in (["product"], ["customer", "product"], BY):
        for bits in (1, 5, 7):
            drawn, _ = layout._drawn(df, by, 4000)
            bounds = layout._bounds(drawn, by, bits)
            keyed = df.withColumn("_cluster", layout.interleaved(df, bounds, bits))
            got = keyed.withColumn("task", layout._task(df, drawn, bounds, bits, 16)).orderBy("_cluster", *by).select("task").collect()
            tasks = [r.task for r in got]
            assert tasks == sorted(tasks) and set(tasks) == set(range(16))
            assert max(map(tasks.count, range(16))) < 2 * len(rows) / 16
