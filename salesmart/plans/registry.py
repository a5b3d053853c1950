"""Registry of named queries and their SQL oracles.

A query is ``fn(spark, data_dir) -> DataFrame`` over the parquet tables of
``data_dir``; its oracle (when the operator is SQL-expressible) is DuckDB SQL
over the same tables registered as views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.star import SALES_SQL
from salesmart.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``oracle`` is DuckDB SQL (optional)."""
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return fn(Tables(spark, data_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def with_sales(sql: str) -> str:
    """Prefix ``sql`` with the sales view as a CTE."""
    return f"WITH sales AS ({SALES_SQL})\n{sql}"
