"""The last delivery of a day wins, as a stream (X1 + U1).

The feed brings whole days, numbered by delivery. A day may come again, late, or
behind a newer delivery of itself. Two queries read the feed:

* ``delivery_lines`` types the lines and appends them to folders by day and
  delivery (the file sink writes each file of the feed once, over restarts too).
  It holds no state, and a day's lines spread over as many tasks as read them.
* ``latest_deliveries`` keeps one small state per day: the winning delivery and
  its number of lines. Lines are counted per day and delivery in the tasks that
  read them, so what meets in a day's task is a row per reading task, not the
  day. It emits a row whenever a day's winner changes or grows, saying which
  delivery it replaces. A timer drops a day's state once the watermark is ``keep``
  past its last delivery; deliveries that come after the watermark are refused.

``current_lines`` joins the two: for each day the lines of its winner. Each
sending of a day has a number of its own; lines without a day are no part of a
delivery (as in ``replace_days``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from salesmart.operators import cleanse
from salesmart.schema import API_RECORD_SCHEMA, HEADER_NAMES, ODS_COLUMNS
from salesmart.sources.files import CORRUPT
from salesmart.streaming.ingest import file_stream

DELIVERY, DELIVERED = "delivery_id", "delivered_at"
FEED_SCHEMA = T.StructType([*API_RECORD_SCHEMA.fields, T.StructField(DELIVERY, T.LongType()),
                            T.StructField(DELIVERED, T.TimestampType()), T.StructField(CORRUPT, T.StringType())])
LEDGER = "order_date date, delivery_id long, lines long, replaces long, replaced_lines long"


def write_delivery(lines: DataFrame, path: str, delivery: int, at: str) -> None:
    """Land ODS ``lines`` in the feed's folder as delivery number ``delivery``, sent ``at``."""
    cols = [F.col(c).cast("string").alias(HEADER_NAMES[c]) if c in ("order_date", "ship_date")
            else F.col(c).alias(HEADER_NAMES[c]) for c in ODS_COLUMNS]
    lines.select(*cols, F.lit(delivery).cast("long").alias(DELIVERY), F.lit(at).alias(DELIVERED)).write.mode("append").json(path)


def delivery_feed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The feed as a stream: JSON lines landing in ``path``."""
    return file_stream(spark, path, FEED_SCHEMA, "json", max_files_per_trigger=max_files_per_trigger)


def _bad() -> Column:
    return cleanse.is_bad(CORRUPT) | F.col(DELIVERY).isNull() | F.col(DELIVERED).isNull()


def delivery_lines(feed: DataFrame) -> DataFrame:
    """Typed lines with their delivery; records that don't parse whole, or name no delivery, are left out."""
    typed = cleanse.records_to_ods(feed.where(~_bad()), (DELIVERY, DELIVERED))
    return typed.where(F.col("order_date").isNotNull())


def delivery_rejects(feed: DataFrame) -> DataFrame:
    """What ``delivery_lines`` leaves out, as JSON text."""
    no_day = F.col(f"`{HEADER_NAMES['order_date']}`").isNull()
    return feed.where(_bad() | no_day).select(F.to_json(F.struct("*")).alias("record"))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines per day and delivery, in the task that reads them."""
    held: dict[tuple, list] = {}
    for pdf in batches:
        for (day, number), part in pdf.groupby(["order_date", DELIVERY], sort=False)[DELIVERED]:
            row = held.setdefault((day, number), [0, part.max()])
            row[0] += len(part)
            row[1] = max(row[1], part.max())
    yield pd.DataFrame([(d, n, at, lines) for (d, n), (lines, at) in held.items()], columns=["order_date", DELIVERY, DELIVERED, "lines"])


def _latest(keep_ms: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = state.get if state.exists else (None, 0, 0)
        best, lines, last = before
        for pdf in batches:
            for number, at, n in zip(pdf[DELIVERY].tolist(), pdf[DELIVERED], pdf["lines"].tolist(), strict=True):
                last = max(last, int(at.timestamp() * 1000))
                if best is None or number > best:
                    best, lines = number, n
                elif number == best:
                    lines += n
        state.update((best, lines, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + keep_ms)
        if (best, lines) != before[:2]:
            old = before if before[0] not in (None, best) else (None, None)
            yield pd.DataFrame({"order_date": [key[0]], DELIVERY: [best], "lines": [lines],
                                "replaces": pd.array([old[0]], "Int64"), "replaced_lines": pd.array([old[1]], "Int64")})
    return run


def latest_deliveries(lines: DataFrame, delay: str = "2 days", keep_days: int = 30) -> DataFrame:
    """Per day and micro-batch with a change: the winning delivery, its lines so far, and which it replaces."""
    counts = lines.select("order_date", DELIVERY, DELIVERED).mapInPandas(
        _counted, f"order_date date, {DELIVERY} long, {DELIVERED} timestamp, lines long")
    return counts.withWatermark(DELIVERED, delay).groupBy("order_date").applyInPandasWithState(
        _latest(keep_days * 86_400_000), LEDGER, "best long, lines long, last long", "update", GroupStateTimeout.EventTimeTimeout)


def run_ledger(latest: DataFrame, path: str, checkpoint: str):
    """Run ``latest_deliveries`` over everything available now; each micro-batch is a folder of the
    ledger, written again under its number if it is run again. Returns the finished query."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = (latest.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    spark = latest.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(f"{path}/batch=-1")  # a ledger without deliveries
    return q


def winners(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's last word on each day: order_date, delivery_id, lines."""
    rows = spark.read.schema(f"{LEDGER}, batch long").parquet(ledger)
    last = Window.partitionBy("order_date").orderBy(F.desc("batch"), F.desc(DELIVERY))
    return rows.withColumn("n", F.row_number().over(last)).where("n = 1").select("order_date", DELIVERY, "lines")


def current_lines(spark: SparkSession, lines: str, ledger: str) -> DataFrame:
    """The lines of every day's winning delivery, as ODS rows (folders of other deliveries are skipped)."""
    held = spark.read.schema(T.StructType([*cleanse.ODS_SCHEMA.fields, T.StructField(DELIVERY, T.LongType())])).parquet(lines)
    return held.join(winners(spark, ledger).drop("lines"), ["order_date", DELIVERY], "left_semi").select(*ODS_COLUMNS)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
