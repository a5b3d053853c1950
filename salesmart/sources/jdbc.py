"""JDBC source and sink.

The reference reads whole tables through one connection (one task) and
writes with default batching. Here reads are split into ``num_partitions``
range queries on a numeric or date column, and writes use a batch size and a
bounded number of concurrent connections. The JDBC driver jar of the target
database must be on the classpath; none is bundled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int = 8, fetch_size: int = 10_000) -> DataFrame:
    """Parallel JDBC scan. Bounds only shape the split; no row is dropped."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partitioned JDBC reads need lower_bound and upper_bound")
        reader = (reader.option("partitionColumn", partition_column)
                        .option("lowerBound", str(lower_bound))
                        .option("upperBound", str(upper_bound))
                        .option("numPartitions", num_partitions))
    return reader.load()


def column_bounds(df: DataFrame, column: str):
    """(min, max) of a column, e.g. to size a partitioned re-read."""
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def write_table(df: DataFrame, url: str, table: str, properties: dict | None = None,
                mode: str = "overwrite", batch_size: int = 10_000,
                num_partitions: int | None = 8, truncate: bool = True) -> None:
    """K1: JDBC write; ``truncate`` keeps the table definition on overwrite,
    ``num_partitions`` caps concurrent connections to the database."""
    out = df.coalesce(num_partitions) if num_partitions else df
    writer = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
                 .option("batchsize", batch_size).option("truncate", truncate))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
