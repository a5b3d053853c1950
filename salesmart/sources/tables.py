"""Parquet table access for a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy, memoised parquet readers for the tables of one directory.

    Reading is lazy in Spark anyway; memoising keeps one relation object per
    table so a plan that uses a table twice can reuse the scan (ReusedExchange).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]
