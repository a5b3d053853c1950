"""Registered queries that join streams (J2 on X1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.plans.registry import query, with_sales
from salesmart.schema import ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources.tables import Tables
from salesmart.streaming import flatten, ingest

# Fixed parameters: where the feed is cut into landings, and its last heartbeat.
CUTS = ("1997-01-01 00:00:00", "1999-06-01 00:00:00")
END = "2030-01-01 00:00:00"


def feeds(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The order and line tables as feeds. A line follows its order by as many days as its number; those
    of every 17th order come 40 days after it, and those of every 19th land 10 days late."""
    at, key = F.col("o_orderdate").cast("timestamp"), F.col("l_orderkey")
    orders = t.orders.withColumn(flatten.AT, at).withColumn(flatten.LANDED, at)
    line_at = at + F.make_dt_interval(F.when(key % 17 == 0, 40).otherwise(F.col("l_linenumber")))
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), key == F.col("o_orderkey")).withColumn(flatten.AT, line_at)
    landed = F.col(flatten.AT) + F.make_dt_interval(F.when(key % 19 == 0, 10).otherwise(0))
    return orders, lines.withColumn(flatten.LANDED, landed).drop("o_orderkey", "o_orderdate")


@query("stream_flat_sales", with_sales(f"""
SELECT {", ".join(ODS_COLUMNS)} FROM sales WHERE CAST(order_id AS BIGINT) % 17 <> 0 AND CAST(order_id AS BIGINT) % 19 <> 0"""))
def stream_flat_sales(t: Tables) -> DataFrame:
    """J2 as a stream: orders and lines land in three waves with a restart between them; lines that have
    their order in time are the flat sales rows, the others are rejects."""
    orders, lines = feeds(t)
    paths = {x: scratch_path(t.spark, f"flat-{x}") for x in ("sent", "orders", "lines", "flat", "rejects", "ckpt")}
    lines.write.parquet(paths["sent"])  # the lines' times take a join; every wave lands from its result
    lines = t.spark.read.schema(lines.schema).parquet(paths["sent"])
    for low, high in zip((None, *CUTS), (*CUTS, None), strict=True):
        landed = F.lit(True)
        if low:
            landed = landed & (F.col(flatten.LANDED) >= F.lit(low).cast("timestamp"))
        if high:
            landed = landed & (F.col(flatten.LANDED) < F.lit(high).cast("timestamp"))
        for feed, name in ((orders, "orders"), (lines, "lines")):
            feed.where(landed).write.mode("append").parquet(paths[name])
            if not high:
                flatten.heartbeat(feed, paths[name], END)
        flatten.run_flatten(ingest.file_stream(t.spark, paths["orders"], orders.schema), ingest.file_stream(t.spark, paths["lines"], lines.schema),
                            t, paths["flat"], paths["rejects"], paths["ckpt"])
    return flatten.flat_rows(t, paths["flat"])
