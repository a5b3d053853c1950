"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); the root is the least node.

    Each round is a map-side combined minimum per node and a join back (which
    AQE may split where a node has very many edges); edges never outgrow the
    input, and every round is a written table.
    """
    def lowest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("low"))

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "components")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(lowest(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct()
        near = large.join(lowest(large), "u")
        small = near.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            near.select("u", F.col("low").alias("v")))
        now = written(small.distinct(), "components")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
