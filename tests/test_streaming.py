"""Structured Streaming ingest, dedupe and daily windows on the events table."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from salesmart.session import scratch_path
from salesmart.streaming import ingest


def _stream(spark, data_dir):
    schema = spark.read.parquet(f"{data_dir}/events.parquet").schema
    return ingest.table_stream(spark, f"{data_dir}/events.parquet", schema)


def test_ingest_day_exactly_once(spark, data_dir):
    out, ckpt = scratch_path(spark, "t-ingest"), scratch_path(spark, "t-ingest-ckpt")
    ingest.run_to_parquet(ingest.ingest_day(_stream(spark, data_dir), "2024-01-03"), out, ckpt)
    first = spark.read.parquet(out).count()
    # Re-running with the same checkpoint finds no new files: nothing duplicated.
    ingest.run_to_parquet(ingest.ingest_day(_stream(spark, data_dir), "2024-01-03"), out, ckpt)
    batch = spark.read.parquet(f"{data_dir}/events.parquet").where(
        F.to_date("ts") == F.lit("2024-01-03").cast("date")).count()
    assert first == batch == spark.read.parquet(out).count()


def test_dedupe_redelivery(spark, data_dir):
    twice = _stream(spark, data_dir).unionByName(_stream(spark, data_dir))
    out, ckpt = scratch_path(spark, "t-dedupe"), scratch_path(spark, "t-dedupe-ckpt")
    ingest.run_to_parquet(ingest.dedupe(ingest.with_event_time(twice), ["event_id"]), out, ckpt)
    got = spark.read.parquet(out)
    assert got.count() == got.select("event_id").distinct().count() == \
        spark.read.parquet(f"{data_dir}/events.parquet").count()


def test_daily_windows_complete(spark, data_dir):
    totals = ingest.daily_totals(ingest.with_event_time(_stream(spark, data_dir)))
    out, ckpt = scratch_path(spark, "t-daily"), scratch_path(spark, "t-daily-ckpt")
    ingest.run_to_parquet(totals, out, ckpt, output_mode="complete")
    got = {r.day: r.events for r in spark.read.parquet(out).collect()}
    want = {r.d: r.n for r in spark.read.parquet(f"{data_dir}/events.parquet")
            .groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_daily_windows_append_emits_closed_days_only(spark, data_dir):
    totals = ingest.daily_totals(ingest.with_event_time(_stream(spark, data_dir)))
    out, ckpt = scratch_path(spark, "t-daily-app"), scratch_path(spark, "t-daily-app-ckpt")
    ingest.run_to_parquet(totals, out, ckpt, output_mode="append")
    got = {r.day for r in spark.read.parquet(out).collect()}
    ev = spark.read.parquet(f"{data_dir}/events.parquet")
    days = {r.d for r in ev.select(F.to_date("ts").alias("d")).distinct().collect()}
    watermark = ev.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)   # delay: 1 day
    # A day is final once its window end is behind the watermark; later days stay open.
    closed = {d for d in days if dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1) <= watermark}
    assert got == closed and len(closed) < len(days)


def test_table_as_a_folder_of_part_files_and_an_empty_day(spark, data_dir):
    root = scratch_path(spark, "t-dir")
    events = spark.read.parquet(f"{data_dir}/events.parquet")
    events.repartition(3).write.parquet(f"{root}/events.parquet")
    from salesmart.plans import QUERIES
    for name in ("stream_ingest", "stream_dedupe", "stream_daily"):
        assert QUERIES[name](spark, root).exceptAll(QUERIES[name](spark, data_dir)).count() == 0, name
    out, ckpt = scratch_path(spark, "t-empty"), scratch_path(spark, "t-empty-ckpt")
    day = ingest.ingest_day(_stream(spark, data_dir), "1999-01-01")
    ingest.run_to_parquet(day, out, ckpt)
    assert spark.read.schema(day.schema).parquet(out).count() == 0


def test_sales_feed_keeps_the_day_once_and_its_rejects(spark):
    feed, out, ckpt, bad = (scratch_path(spark, f"t-sales-{x}") for x in ("feed", "out", "ckpt", "bad"))
    os.makedirs(feed)
    rec = {"Order ID": "CA-1", "Order Date": "2020-11-08", "Ship Date": "2020-11-09", "Customer Name": "O'Hara", "Sales": "2.5"}
    lines = [json.dumps(r) for r in (rec, rec, dict(rec, **{"Order Date": "2020-11-07"}), dict(rec, Sales="a lot"))]
    with open(os.path.join(feed, "a.json"), "w") as fh:
        fh.write("\n".join([*lines, "{broken"]) + "\n")
    records = ingest.sales_records(spark, feed)
    for _ in range(2):  # a second run finds no new files
        ingest.run_to_parquet(ingest.sales_day(records, "2020-11-08"), out, ckpt, partition_by=["order_date"])
    got = spark.read.parquet(out).collect()
    assert [(r.order_id, r.customer_name, r.sales, r.order_date.isoformat()) for r in got] == [("CA-1", "O'Hara", 2.5, "2020-11-08")] * 2
    ingest.run_to_parquet(ingest.sales_rejects(records), bad, ckpt + "-bad")
    assert spark.read.parquet(bad).count() == 2
