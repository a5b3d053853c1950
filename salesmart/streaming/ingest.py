"""Structured Streaming re-aim of the daily API load.

The reference fetches the API once a day, keeps today's records and appends
them. As a stream: new files landing in a folder are the increments; a
checkpointed query picks up exactly the files it has not seen, so a crashed
or repeated run neither loses nor duplicates a delivery. ``availableNow``
processes everything present and stops - the daily batch - while the same
query can run continuously.

Event-time operators need ``timestamp`` (not ``timestamp_ntz``) columns;
the session time zone (UTC) makes the cast lossless.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.numeric import money_sum
from salesmart.operators import cleanse
from salesmart.schema import API_RECORD_SCHEMA
from salesmart.sources.files import CORRUPT


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming read of the files in ``path`` (optionally filtered by ``glob``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A streaming read of a parquet table that is one file or a folder of part files.

    A stream's path must be a folder unless it is a pattern; as a pattern that
    only matches itself, ``path`` may be either.
    """
    return file_stream(spark, f"{path[:-1]}[{path[-1]}]", schema)


def with_event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Cast a ``timestamp_ntz`` event-time column to ``timestamp`` (session zone)."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def ingest_day(stream: DataFrame, day: _dt.date | str, column: str = "ts") -> DataFrame:
    """Keep the records of one day (the reference keeps 'today')."""
    d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    start = F.lit(d.isoformat()).cast("timestamp")
    end = F.lit((d + _dt.timedelta(days=1)).isoformat()).cast("timestamp")
    ts = F.col(column).cast("timestamp")
    return stream.where((ts >= start) & (ts < end))


def sales_records(spark: SparkSession, path: str) -> DataFrame:
    """The sales feed as a stream: JSON lines landing in ``path``, with ``_corrupt_record``."""
    schema = T.StructType([*API_RECORD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return file_stream(spark, path, schema, "json")


def sales_day(records: DataFrame, day: _dt.date | str) -> DataFrame:
    """X1 for sales (P8, P9): one day's records that load whole, typed as ODS."""
    return cleanse.daily_increment(records.where(~cleanse.is_bad(CORRUPT)), day)


def sales_rejects(records: DataFrame) -> DataFrame:
    """The records that ``sales_day`` refuses, as JSON text, for a reject table of their own."""
    return records.where(cleanse.is_bad(CORRUPT)).select(F.to_json(F.struct("*")).alias("record"))


def dedupe(stream: DataFrame, keys: list[str], column: str = "ts",
           delay: str = "1 day") -> DataFrame:
    """Drop re-delivered records with the same ``keys`` within ``delay``.

    State per key is kept only until the watermark passes it, so memory is
    bounded by the delay, not by the history.
    """
    return stream.withWatermark(column, delay).dropDuplicatesWithinWatermark(keys)


def daily_totals(stream: DataFrame, column: str = "ts", value: str = "value",
                 delay: str = "1 day") -> DataFrame:
    """Tumbling one-day windows: events and exact value total per day."""
    g = (stream.withWatermark(column, delay)
               .groupBy(F.window(column, "1 day").alias("w"))
               .agg(F.count(F.lit(1)).alias("events"), money_sum(value).alias("value_sum")))
    return g.select(F.col("w.start").cast("date").alias("day"), "events", "value_sum")


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str,
                   output_mode: str = "append", partition_by: list[str] | None = None) -> None:
    """Run a stream over everything available now into parquet at ``path``.

    ``append`` streams go to the file sink (exactly-once through its
    metadata log; such a table is the stream's own, batch loads don't write to
    it), in folders by ``partition_by`` if given. ``complete`` results are rewritten whole on every batch
    through ``foreachBatch``, keyed by batch id in the checkpoint.
    """
    if output_mode == "append":
        q = (stream.writeStream.format("parquet").option("path", path)
                   .option("checkpointLocation", checkpoint).partitionBy(*(partition_by or []))
                   .outputMode("append").trigger(availableNow=True).start())
    else:
        def write_batch(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        q = (stream.writeStream.foreachBatch(write_batch)
                   .option("checkpointLocation", checkpoint)
                   .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if output_mode != "append":  # a stream without any input writes no batch: its result is an empty table
        spark = stream.sparkSession
        spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(path)
