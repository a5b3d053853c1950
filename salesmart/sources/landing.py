"""Ledger of landed API files (S3, P8): which were read, and the days that each holds.

A daily load wants one day's records of a folder that grows every day. The ledger
is a table with a row per file and order day in it, so a load opens the files that
landed since the last one, and of the others only those that hold its day. A file
is known by path, size and modification time: one that was written again is new.
Listing reads no file's content; the driver gets the names of the files to open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import parse_text_date
from salesmart.schema import HEADER_NAMES
from salesmart.sources.files import read_api_json

LEDGER = "path string, modified timestamp, length long, seen date, order_date date, records long"


def listed(spark: SparkSession, landing: str) -> DataFrame:
    """path, modified and length of the files in ``landing``; their content isn't read."""
    return spark.read.format("binaryFile").load(landing).select(
        "path", F.col("modificationTime").alias("modified"), "length")


def _same_path(path: Column) -> Column:
    """A path as both the listing and ``_metadata`` spell it."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "^file:/+", "file:/")


def _read(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    """Records of some files with ``_file``, ``_block`` (where in the file the reading task began) and
    ``_row`` (a number that rises with the place in the task)."""
    records = read_api_json(spark, paths, multi_line)
    return records.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                          F.monotonically_increasing_id().alias("_row"))


def ledger_of(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def record_new(spark: SparkSession, landing: str, ledger: str, seen: str, multi_line: bool = True) -> list[str]:
    """Enter files that the ledger doesn't know with the days they hold; returns their paths."""
    new = listed(spark, landing).join(ledger_of(spark, ledger), ["path", "modified", "length"], "left_anti")
    files = new.collect()
    if not files:
        return []
    day = parse_text_date(f"`{HEADER_NAMES['order_date']}`", "yyyy-MM-dd")
    held = _read(spark, [f.path for f in files], multi_line).groupBy(_same_path(F.col("_file")).alias("of"), day.alias("order_date")).agg(
        F.count(F.lit(1)).alias("records"))
    entered = spark.createDataFrame(files, "path string, modified timestamp, length long")
    # A file without records is entered too.
    rows = entered.join(held, _same_path(F.col("path")) == F.col("of"), "left").select(
        "path", "modified", "length", F.lit(seen).cast("date").alias("seen"), "order_date", F.coalesce("records", F.lit(0)).alias("records"))
    rows.write.mode("append").parquet(ledger)
    return [f.path for f in files]


def files_of_day(spark: SparkSession, landing: str, ledger: str, day: str) -> list[str]:
    """Paths of the files, as they are now, that hold records of ``day`` or were first read on it."""
    known = listed(spark, landing).join(ledger_of(spark, ledger), ["path", "modified", "length"])
    on = F.lit(day).cast("date")
    return [r.path for r in known.where((F.col("order_date") == on) | (F.col("seen") == on)).select("path").distinct().orderBy("path").collect()]


def read_day(spark: SparkSession, landing: str, ledger: str, day: str, multi_line: bool = True) -> DataFrame:
    """The records of the files that matter to ``day``, with their place (see ``_read``)."""
    record_new(spark, landing, ledger, day, multi_line)
    paths = files_of_day(spark, landing, ledger, day)
    if paths:
        return _read(spark, paths, multi_line)
    schema = read_api_json(spark, [landing], multi_line).schema
    return spark.createDataFrame([], schema).select("*", F.lit("").alias("_file"), F.lit(0).cast("bigint").alias("_block"),
                                                   F.lit(0).cast("bigint").alias("_row"))


def placed(records: DataFrame, bad: Column, fields: list[str]) -> DataFrame:
    """The ``bad`` records as JSON text of their ``fields``, with file, block and place in the block (from 0)."""
    first = records.groupBy("_file", "_block").agg(F.min("_row").alias("first"))
    return records.where(bad).join(first, ["_file", "_block"]).select(
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("record"), F.col("_file").alias("file"),
        F.col("_block").alias("block"), (F.col("_row") - F.col("first")).alias("place"))
