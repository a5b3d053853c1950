"""The stream-stream flatten: rows on time equal the batch view, the rest are rejects with a reason, state is bounded."""

import collections

from pyspark.sql import functions as F

from salesmart.plans import streams
from salesmart.session import scratch_path
from salesmart.sources.star import sales_view
from salesmart.sources.tables import Tables
from salesmart.streaming import flatten, ingest


def _run(t, paths, orders, lines, **options):
    return flatten.run_flatten(ingest.file_stream(t.spark, paths["orders"], orders.schema), ingest.file_stream(t.spark, paths["lines"], lines.schema),
                               t, paths["flat"], paths["rejects"], paths["ckpt"], **options)


def test_waves_equal_the_batch_view_and_state_is_bounded(spark, data_dir):
    t = Tables(spark, data_dir)
    orders, lines = streams.feeds(t)
    paths = {x: scratch_path(spark, f"t-flat-{x}") for x in ("orders", "lines", "flat", "rejects", "ckpt")}
    held = []
    for low, high in (("1900-01-01", "1996-06-01"), ("1996-06-01", "1998-06-01"), ("1998-06-01", "2000-06-01"), ("2000-06-01", "2100-01-01")):
        now = (F.col(flatten.LANDED) >= F.lit(low).cast("timestamp")) & (F.col(flatten.LANDED) < F.lit(high).cast("timestamp"))
        orders.where(now).write.mode("append").parquet(paths["orders"])
        lines.where(now).write.mode("append").parquet(paths["lines"])
        q = _run(t, paths, orders, lines)
        state = q.recentProgress[-1].stateOperators[0]
        held.append(state.numRowsTotal)
        assert state.numRowsDroppedByWatermark == 0  # what lands on time is never behind the watermark
    for feed, name in ((orders, "orders"), (lines, "lines")):
        flatten.heartbeat(feed, paths[name], streams.END)
    _run(t, paths, orders, lines)
    # After each wave about a month and a half of both feeds is held, of six years or so.
    assert max(held[1:]) < 0.1 * (t.orders.count() + t.lineitem.count()), held
    got = flatten.flat_rows(t, paths["flat"])
    key = F.col("order_id").cast("long")
    want = sales_view(t).where((key % 17 != 0) & (key % 19 != 0))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    lost = spark.read.parquet(f"{paths['rejects']}/no_order").select("l_orderkey", "reason").union(
        spark.read.parquet(f"{paths['rejects']}/refused").select("l_orderkey", "reason")).groupBy("l_orderkey", "reason").count().collect()
    n = collections.Counter({r.l_orderkey: r["count"] for r in t.lineitem.groupBy("l_orderkey").count().collect()})
    assert {(r.l_orderkey, r.reason, r["count"]) for r in lost} == {
        (k, "landed late" if k % 19 == 0 else "no order in time", c) for k, c in n.items() if k % 17 == 0 or k % 19 == 0}


def test_nulls_unknown_orders_and_repeated_lines(spark, data_dir):
    t = Tables(spark, data_dir)
    orders, lines = streams.feeds(t)
    paths = {x: scratch_path(spark, f"t-flat-odd-{x}") for x in ("orders", "lines", "flat", "rejects", "ckpt")}
    day = "1998-01-0{} 00:00:00".format
    spark.createDataFrame([(1, 1, day(1)), (2, None, day(1)), (None, 3, day(1)), (4, 1, day(3))], "k long, c long, d string").select(
        *[{"o_orderkey": F.col("k"), "o_custkey": F.col("c"), "o_orderdate": F.col("d").cast("timestamp_ntz"), "at": F.col("d").cast("timestamp"),
           "landed_at": F.col("d").cast("timestamp")}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in orders.schema.fields]
    ).write.parquet(paths["orders"])
    rows = [(1, 1, day(2), day(2)), (1, 1, day(2), day(2)), (1, None, day(2), day(2)), (2, 1, day(2), day(2)), (9, 1, day(2), day(2)),
            (None, 5, day(2), day(2)), (4, 1, day(2), day(2)), (1, 1, None, day(2)), (1, 1, day(2), day(8))]
    spark.createDataFrame(rows, "k long, p long, a string, b string").select(
        *[{"l_orderkey": F.col("k"), "l_partkey": F.col("p"), "at": F.col("a").cast("timestamp"), "landed_at": F.col("b").cast("timestamp")}
          .get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in lines.schema.fields]).write.parquet(paths["lines"])
    _run(t, paths, orders, lines)
    for feed, name in ((orders, "orders"), (lines, "lines")):
        flatten.heartbeat(feed, paths[name], streams.END)
    _run(t, paths, orders, lines)
    assert sorted((r.order_id, r.customer_id is not None, r.category is not None) for r in flatten.flat_rows(t, paths["flat"]).collect()) == [
        ("1", True, False), ("1", True, True), ("1", True, True), ("2", False, True)]
    lost = [(r.l_orderkey, r.reason) for d in ("no_order", "refused") for r in spark.read.parquet(f"{paths['rejects']}/{d}").collect()]
    # Line 4 came before its order.
    assert sorted(lost, key=str) == sorted([(9, "no order in time"), (None, "no order in time"), (4, "no order in time"), (1, "no time"), (1, "landed late")], key=str)


def test_a_batch_is_joined_once(spark, data_dir):
    """Found and lost lines are written from one run of the join: its state takes every row once."""
    t = Tables(spark, data_dir)
    orders, lines = streams.feeds(t)
    paths = {x: scratch_path(spark, f"t-flat-once-{x}") for x in ("orders", "lines", "flat", "rejects", "ckpt")}
    for feed, name in ((orders, "orders"), (lines, "lines")):
        feed.write.parquet(paths[name])
    q = _run(t, paths, orders, lines)
    on_time = lines.where("landed_at <= at + INTERVAL 2 days").count()
    assert sum(p.stateOperators[0].numRowsUpdated for p in q.recentProgress) <= t.orders.count() + on_time
