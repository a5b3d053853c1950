"""Data-quality profiles (A13-A16), all computed on the executors.

Quantiles are exact and distributed: the columns are stacked and counted per
distinct value (a hot value collapses to one row) in one scan. A value's bucket
is a rising function of the value alone, so which rows meet never depends on
how Spark deals them out. Running counts are taken over a column's buckets (a
bounded number) and, inside the buckets in which a quantile falls, over their
distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import money_mean

QUANTILES = (0.25, 0.5, 0.75)


def _long_form(df: DataFrame, columns: list[str], value_exprs) -> DataFrame:
    """One aggregate row -> one row per column (``stack``)."""
    n = len(columns)
    agg = df.agg(*[value_exprs(c).alias(f"v{i}") for i, c in enumerate(columns)])
    args = ", ".join(f"'{c}', v{i}" for i, c in enumerate(columns))
    return agg.selectExpr(f"stack({n}, {args}) AS (column_name, value)")


def rows_missing(df: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is NULL (data-quality drill-down)."""
    return df.where(F.col(f"`{column}`").isNull())


def rows_with(df: DataFrame, column: str, value) -> DataFrame:
    """The rows whose ``column`` equals ``value``."""
    return df.where(F.col(f"`{column}`") == F.lit(value))


def null_profile(df: DataFrame) -> DataFrame:
    """Number of NULLs per column, in one scan."""
    out = _long_form(df, df.columns, lambda c: F.count_if(F.col(f"`{c}`").isNull()))
    return out.withColumnRenamed("value", "null_count")


def frame_info(df: DataFrame) -> DataFrame:
    """Position, column, Spark type and non-null count per column (``info()``)."""
    agg = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(df.columns)])
    args = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', v{i}"
                     for i, f in enumerate(df.schema.fields))
    return agg.selectExpr(
        f"stack({len(df.columns)}, {args}) AS (position, column_name, dtype, non_null)")


def _bucket(v: Column) -> Column:
    """A bucket that never falls when ``v`` rises: 64 a factor of two, so at most 2 * 64 * 1024 in all.
    Beyond the numbers: NaN is last, as in Spark's order."""
    size = F.floor(F.log2(F.abs(v) + 1) * 64)
    top = F.lit(1 << 17).cast("bigint")
    edge = F.when(F.isnan(v), top + 1).when(F.abs(v) == float("inf"), top)
    return F.coalesce(edge, size) * F.when(F.isnan(v), 1).otherwise(F.signum(v)).cast("bigint")


def quantiles(df: DataFrame, columns: list[str], probs=QUANTILES) -> DataFrame:
    """Exact quantiles of each column with linear interpolation between order
    statistics (position q*(n-1), as pandas ``describe``): column_name, q0, q1, ...
    All columns come from one scan; a column without values has no row.
    """
    cells = df.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns])).alias("c"))
    freq = cells.select("c.column_name", "c.v").where("v IS NOT NULL").groupBy("column_name", "v").agg(
        F.count(F.lit(1)).alias("cnt")).withColumn("bucket", _bucket(F.col("v")))
    held = freq.groupBy("column_name", "bucket").agg(F.sum("cnt").alias("held"))
    whole = Window.partitionBy("column_name")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    # Positions of the order statistics wanted, and the buckets that hold them.
    p = lambda q: F.lit(q) * (F.col("n") - 1)
    wanted = F.array_distinct(F.array(*[f(p(q)) for q in probs for f in (F.floor, F.ceil)]))
    places = held.withColumn("n", F.sum("held").over(whole)).withColumn("off", F.sum("held").over(upto) - F.col("held"))
    places = places.where(F.exists(wanted, lambda x: (F.col("off") <= x) & (x < F.col("off") + F.col("held"))))
    # The stacked counts are hashed by (column, value); both uses of them read that exchange.
    inside = Window.partitionBy("column_name", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    pos = freq.join(places.select("column_name", "bucket", "n", "off"), ["column_name", "bucket"]).withColumn(
        "end", F.col("off") + F.sum("cnt").over(inside)).withColumn("start", F.col("end") - F.col("cnt"))
    aggs = []
    for i, q in enumerate(probs):
        lo, hi = F.floor(p(q)), F.ceil(p(q))
        aggs += [F.max(F.when((F.col("start") <= lo) & (lo < F.col("end")), F.col("v"))).alias(f"lo{i}"),
                 F.max(F.when((F.col("start") <= hi) & (hi < F.col("end")), F.col("v"))).alias(f"hi{i}"),
                 F.max(p(q) - lo).alias(f"fr{i}")]
    row = pos.groupBy("column_name").agg(*aggs)
    return row.select("column_name", *[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"fr{i}")).alias(f"q{i}") for i in range(len(probs))])


def exact_quantiles(df: DataFrame, column: str, probs=QUANTILES) -> DataFrame:
    """``quantiles`` of one column as one row q0, q1, ... (NULL without values)."""
    names = [f"q{i}" for i in range(len(probs))]
    return quantiles(df, [column], probs).agg(*[F.max(c).alias(c) for c in names])


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """``describe()`` in long form: (column_name, stat, value).

    Stats: count, mean (exact decimal sum / count), std (sample), min,
    25%, 50%, 75% (exact, interpolated), max. The moments of every column
    come from one aggregate (one scan) and all quantiles from a second one.
    """
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        aggs += [F.count(v).cast("double").alias(f"count{i}"), money_mean(v).alias(f"mean{i}"),
                 F.stddev_samp(v.cast("double")).alias(f"std{i}"),
                 F.min(v).cast("double").alias(f"min{i}"), F.max(v).cast("double").alias(f"max{i}")]
    stats = ("count", "mean", "std", "min", "max")
    args = ", ".join(f"'{c}', '{st}', {st}{i}" for i, c in enumerate(columns) for st in stats)
    moments = df.agg(*aggs).selectExpr(
        f"stack({len(columns) * len(stats)}, {args}) AS (column_name, stat, value)")
    # Columns without values keep their rows, as NULL.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    found = names.join(quantiles(df, columns), "column_name", "left").selectExpr(
        "column_name", "stack(3, '25%', q0, '50%', q1, '75%', q2) AS (stat, value)")
    return moments.unionByName(found)


def date_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct count, most frequent value (+ frequency), first, last.

    Values are counted per distinct date first, so a date holding a third of
    all rows is one row of the frequency table.
    """
    cells = df.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("v")) for c in columns])).alias("c"))
    freq = cells.select("c.column_name", "c.v").groupBy("column_name", "v").agg(F.count("v").alias("cnt"))
    # NULL is a group without a count, so that a column without values keeps its row.
    top = F.min_by(F.struct("v", "cnt"), F.when(F.col("v").isNotNull(), F.struct(-F.col("cnt"), F.col("v"))))
    stats = freq.groupBy("column_name").agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("cnt"))).alias("count"), F.count("v").alias("unique"),
        top.alias("top"), F.min("v").alias("first"), F.max("v").alias("last"))
    return stats.select("column_name", "count", "unique", F.col("top.v").alias("top"),
                        F.col("top.cnt").alias("freq"), "first", "last")
