"""File sources and sinks: raw CSV (S1, K3), API JSON (S3), parquet ODS (K2).

Every reader takes an explicit schema: no inference job, no type drift
between files, and bad lines are kept (PERMISSIVE) with their raw text in a
``_corrupt_record`` column instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import API_RECORD_SCHEMA, HEADER_NAMES, ODS_SCHEMA, RAW_SCHEMA, to_snake, with_headers

CORRUPT = "_corrupt_record"
FILE_RECORDS = 500_000


def read_raw_csv(spark: SparkSession, path: str, sep: str = ";",
                 decimal_comma: bool = False, infer_schema: bool = False,
                 with_row_id: bool = True) -> DataFrame:
    """Raw sales CSV with the reference headers -> snake_case STG frame.

    CSV columns bind by position: ``with_row_id`` says whether the files
    start with the ``Row ID`` column. ``decimal_comma`` reads Sales written
    as ``12,5``. ``infer_schema`` reproduces the reference (one extra pass
    over the data; types may drift between files).
    """
    reader = spark.read.option("sep", sep).option("header", True)
    if infer_schema:
        return to_snake(reader.option("inferSchema", True).csv(path))
    schema = with_headers(RAW_SCHEMA)
    if not with_row_id:
        schema = T.StructType([f for f in schema.fields if f.name != HEADER_NAMES["row_id"]])
    if decimal_comma:
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "Sales" else f.dataType)
                               for f in schema.fields])
    schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    df = (reader.schema(schema).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    df = to_snake(df)
    if decimal_comma:
        # A Sales text that is no number makes the line a bad one, as it does without a decimal comma.
        number = F.regexp_replace("sales", ",", ".").try_cast("double")
        unread = F.when(F.col("sales").isNotNull() & number.isNull(), F.concat(F.lit("Sales: "), "sales"))
        df = df.withColumn(CORRUPT, F.coalesce(CORRUPT, unread)).withColumn("sales", number)
    return df


def write_raw_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    """K3: write a frame as headed, ``sep``-separated CSV with reference headers."""
    out = df.toDF(*[HEADER_NAMES.get(c, c) for c in df.columns])
    out.write.mode(mode).option("sep", sep).option("header", True).csv(path)


def read_api_json(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """S3: landed API responses -> header-named record columns. ``path``: a folder, a file or several.

    ``multi_line=True`` reads files holding one JSON array of records (the
    API's format); ``False`` reads JSON lines. Text ids and numeric ids both
    land in string columns and are cast when typed (P9).
    """
    schema = T.StructType(API_RECORD_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema)
                 .option("multiLine", multi_line).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def write_api_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ODS rows as JSON lines keyed by the reference headers, gzipped: the headers in every record
    make up most of the text. A gzip file has one reader, so no file holds more than ``FILE_RECORDS``."""
    cols = [F.col(c).cast("string").alias(HEADER_NAMES[c]) if c in ("order_date", "ship_date")
            else F.col(c).alias(HEADER_NAMES[c]) for c in df.columns]
    df.select(*cols).write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).json(path)


def write_ods(df: DataFrame, path: str, mode: str = "overwrite",
              partition_col: str = "order_date", cluster_by: str = "order_id",
              days_only: bool = False) -> None:
    """K1/K2 for files: ODS as parquet partitioned by order day.

    ``mode='overwrite'`` replaces the whole table. With ``days_only`` it
    replaces only the days present in ``df`` - the whole-day replacement of
    U1 done by the file system: re-loading a delivery is idempotent and an
    increment never rewrites the archive; rows without a date are refused
    then, since they would replace the archive's own. Rows are range-partitioned on (day,
    ``cluster_by``) first: each task writes few files, and a day holding a
    third of all rows is split over many tasks instead of landing in one.
    """
    if days_only:
        df = df.where(F.col(partition_col).isNotNull())
    (df.repartitionByRange(partition_col, cluster_by)
       .sortWithinPartitions(partition_col, cluster_by)   # tight row-group min/max
       .write.mode(mode).option("partitionOverwriteMode", "dynamic" if days_only else "static")
       .partitionBy(partition_col).parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """K3: headed CSV export (e.g. the forecast mart)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def create_ods(spark: SparkSession, path: str, partition_col: str = "order_date") -> None:
    """K2's create-if-absent: an empty ODS at ``path`` unless something is there."""
    spark.createDataFrame([], ODS_SCHEMA).write.mode("ignore").partitionBy(partition_col).parquet(path)


def read_ods(spark: SparkSession, path: str) -> DataFrame:
    """Read the partitioned ODS; filters on the partition column prune folders."""
    return spark.read.parquet(path)
