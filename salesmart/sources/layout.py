"""Clustered layout (O4, K2): rows near each other in several columns lie in the same row groups.

Files sorted by day let a filter on a day skip row groups; a filter on a customer or
a product still reads all of them. Here each column's value becomes a rank among
``2^bits`` ranges of about equal size, the ranks' bits are interleaved into one key,
and rows are dealt to tasks by ranges of it and sorted by it. Every column then has a narrow
minimum and maximum in each row group, and a filter on any of them skips most.

The ranges come from ``SAMPLE`` random rows, or ``TASK_SAMPLE`` a task (one scan; they
are what reaches the driver). They only place rows: any ranges give the same table. A value that a third
of the rows hold has one rank, and the other columns' bits still spread it over tasks.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, SAMPLE, SEARCHED = 5, 10_000, 31
TASK_ROWS, TASK_SAMPLE, TABLE_BITS = 200_000, 50, 15


def ranges(df: DataFrame, columns: list[str], bits: int = BITS, sample: int = SAMPLE, seed: int = 1) -> dict[str, list]:
    """Up to ``2^bits`` - 1 rising bounds of each column, with about as many rows between any two."""
    return _bounds(_drawn(df, columns, sample, seed)[0], columns, bits)


def _drawn(df: DataFrame, columns: list[str], sample: int, seed: int = 1) -> tuple[list[tuple], float]:
    """``sample`` random rows (fewer: all), and about how many rows there are: of n, the k-th smallest draw is near k / n."""
    drawn = df.select(*[F.col(f"`{c}`") for c in columns], F.rand(seed)).toDF(*map(str, range(len(columns))), "draw")
    rows = drawn.orderBy("draw").limit(sample).collect()
    return [tuple(r)[:-1] for r in rows], len(rows) if len(rows) < sample else len(rows) / rows[-1].draw


def _bounds(rows: list[tuple], columns: list[str], bits: int) -> dict[str, list]:
    n = 1 << bits
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        out[c] = sorted({values[len(values) * k // n] for k in range(1, n)}) if values else []
    return out


def _bounds_up_to(v: Column, cuts: list[Column]) -> Column:
    """How many of the rising ``cuts`` are <= ``v``: a binary search in comparisons. More than ``SEARCHED``
    would be code too long to be compiled; those are counted in an array."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(v < cuts[middle], search(low, middle)).otherwise(search(middle + 1, high))
    return search(0, len(cuts)) if len(cuts) <= SEARCHED else F.size(F.filter(F.array(*cuts), lambda x: x <= v))


def interleaved(df: DataFrame, bounds: dict[str, list], bits: int = BITS) -> Column:
    """The key: highest bits of all columns' ranks first. NULL ranks lowest."""
    key = F.lit(0).cast("bigint")
    ranks = {}
    for c, cuts in bounds.items():
        v, kind = F.col(f"`{c}`"), df.schema[c].dataType
        ranks[c] = F.when(v.isNull(), 0).otherwise(_bounds_up_to(v, [F.lit(x).cast(kind) for x in cuts])).cast("bigint")
    for i in range(bits):
        for rank in ranks.values():
            key = F.shiftleft(key, 1) + F.shiftright(rank, bits - 1 - i).bitwiseAND(F.lit(1).cast("bigint"))
    return key


def _task(df: DataFrame, rows: list[tuple], bounds: dict[str, list], bits: int, files: int) -> Column:
    """The task of a row, from the sampled ``rows`` alone: how many of ``files`` - 1 cuts through them, in the order of
    the key and then of the columns, are not above it. So one cell of the grid may be split over tasks.

    A table gives the cuts below the key's first bits; only rows that share those with a cut are compared with cuts."""
    kinds = [df.schema[c].dataType for c in bounds]
    names = [f"v{i}" for i in range(len(kinds))]
    held = df.sparkSession.createDataFrame(rows, T.StructType([T.StructField(c, k) for c, k in zip(bounds, kinds)]))
    cells = held.select(interleaved(held, bounds, bits).alias("cell"), "*").toDF("cell", *names).orderBy("cell", *names).collect()
    cuts = [cells[len(cells) * k // files] for k in range(1, files)] if cells else []
    cuts = [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]
    if not cuts:
        return F.lit(0)
    low = max(0, len(kinds) * bits - TABLE_BITS)
    firsts = [c.cell >> low for c in cuts]
    below = _numbers([bisect_left(firsts, k) for k in range(firsts[-1] + 2)])
    inside = _numbers([bisect_right(firsts, k) - bisect_left(firsts, k) for k in range(firsts[-1] + 2)])
    first = F.least(F.shiftright("_cluster", low).cast("int"), F.lit(firsts[-1] + 1))
    at = F.struct(F.col("_cluster").alias("cell"), *[F.col(f"`{c}`").alias(n) for c, n in zip(bounds, names)])
    listed = F.array(*[F.struct(F.lit(c.cell).cast("bigint").alias("cell"), *[F.lit(v).cast(k).alias(n) for v, k, n in zip(c[1:], kinds, names)])
                       for c in cuts])
    within = F.size(F.filter(F.slice(listed, F.get(below, first) + 1, F.get(inside, first)), lambda x: x <= at))
    return F.get(below, first) + F.when(F.get(inside, first) > 0, within).otherwise(0)


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")  # one literal in the plan


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None, bits: int = BITS,
                    row_group_bytes: int | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` as parquet clustered on ``columns``; ``files`` tasks write it (default: one per ``TASK_ROWS`` rows,
    at least the cores and at most the shuffle partitions). The sample deals the rows out, so ``df`` is not read again for that."""
    spark = df.sparkSession
    most = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, count = _drawn(df, columns, max(SAMPLE, TASK_SAMPLE * most))
    files = files or min(most, max(spark.sparkContext.defaultParallelism, math.ceil(count / TASK_ROWS)))
    bounds = _bounds(rows, columns, bits)
    keyed = df.withColumn("_cluster", interleaved(df, bounds, bits))
    by = [F.col("_cluster"), *[F.col(f"`{c}`") for c in columns]]
    dealt = keyed.repartitionById(files, _task(df, rows, bounds, bits, files))
    out = dealt.sortWithinPartitions(*by).drop("_cluster").write.mode(mode)
    if row_group_bytes:
        out = out.option("parquet.block.size", row_group_bytes)
    out.parquet(path)
