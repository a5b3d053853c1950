"""Exact top-k of sums without shuffling every key (O2, A1-A9 over a table of lines).

``marts.top_n`` sends one row per key and task through a shuffle. With very many
keys almost all of those rows are in vain. Here each task sums its own lines, the
local sums stay where they are (a table, one part per task), and three rounds of
threshold bounds decide which keys have to meet:

1. every part shows its k greatest local sums. Adding them up gives each key a
   lower bound; the k-th greatest of these is ``tau``: k keys have at least that.
2. every part sends its local sums of at least ``T = tau / parts``. A key that no
   part sends is below T in every part, so below ``tau`` in all, and is out. The
   others get a lower and an upper bound (T for every part that sent nothing),
   and those whose upper bound is below the k-th greatest lower bound are out.
3. the few keys left fetch all their local sums.

Bounds with negative sums: a part that shows nothing for a key may hold less than
nothing of it. So a lower bound counts each silent part with the least local sum
it holds, if that is negative. The upper bounds only need "silent means less than
T", which a key that a part doesn't have at all (a sum of 0) meets only if T > 0.
Hence with ``tau`` <= 0, which takes negative sums or fewer than k keys with a
positive one, the bounds say nothing and every key is summed as in ``marts.top_n``.
Keys that tie with the k-th stay in at every step, since only strictly smaller
bounds are dropped; ties are broken by the key.

The driver gets at most k numbers a round. A part holds its distinct keys in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_FLOOR, Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators import marts
from salesmart.session import scratch_path

_SUM = "decimal(38,4)"


def local_sums(sales: DataFrame, keys: list[str], path: str, measure: str = "sales") -> DataFrame:
    """Write each task's exact sums per key to ``path``: part, the keys, total. NULL keys are left
    out, NULL measures count nothing (a key of which all are NULL sums to 0)."""
    rows = sales.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))).select(
        *keys, F.coalesce(F.col(measure).cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)")).cast(_SUM).alias("total"))
    kind = pa.decimal128(38, 4)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, waiting, size = None, [], 0

        def fold() -> pa.Table:
            # Spark's batches may say "not null" of a column, folded sums never do: one schema for both.
            lines = pa.Table.from_batches(waiting).select([*keys, "total"])
            lines = lines.cast(pa.schema([f.with_nullable(True) for f in lines.schema]))
            parts = pa.concat_tables(([held] if held is not None else []) + [lines])
            summed = parts.group_by(keys).aggregate([("total", "sum")])
            return summed.select(keys).append_column("total", summed.column("total_sum").cast(kind))

        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size > 500_000:
                held, waiting, size = fold(), [], 0
        if waiting:
            held = fold()
        if held is not None:
            part = pa.array([TaskContext.get().partitionId()] * len(held), pa.int32())
            yield from held.add_column(0, "part", part).to_batches(max_chunksize=10_000)

    schema = "part int, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows.mapInArrow(add_up, schema).write.parquet(path)
    return sales.sparkSession.read.schema(schema).parquet(path)


def _bounds(sent: DataFrame, least: DataFrame, keys: list[str], silent: Column) -> DataFrame:
    """Lower and upper bound per key from the local sums ``sent``; ``silent`` bounds what a part that sent
    nothing may hold. ``least`` has one row per part: the least that a key can have there, 0 at most."""
    every = least.select(F.sum("least")).scalar()
    parts = least.select(F.count(F.lit(1))).scalar()
    known = sent.join(least, "part").groupBy(*keys).agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("n"), F.sum("least").alias("own"))
    return known.select(*keys, (F.col("total") + every - F.col("own")).cast(_SUM).alias("low"),
                        (F.col("total") + silent * (parts - F.col("n"))).cast(_SUM).alias("high"))


def _kth(bounds: DataFrame, k: int) -> Decimal | None:
    """The k-th greatest lower bound (None: fewer keys)."""
    top = bounds.select("low").orderBy(F.desc("low")).limit(k).collect()
    return top[-1].low if len(top) == k else None


def candidates(local: DataFrame, keys: list[str], k: int) -> DataFrame | None:
    """The keys that may be among the k greatest sums, by rounds 1 and 2; None: any key may."""
    least = local.groupBy("part").agg(F.least(F.min("total"), F.lit(0)).cast(_SUM).alias("least"))
    greatest = Window.partitionBy("part").orderBy(F.desc("total"))
    shown = local.withColumn("n", F.row_number().over(greatest)).where(F.col("n") <= k).drop("n")
    tau = _kth(_bounds(shown, least, keys, F.lit(0)), k)
    if tau is None or tau <= 0:
        return None
    parts = least.count()
    level = (tau / parts).quantize(Decimal("0.0001"), rounding=ROUND_FLOOR)
    if level <= 0:
        return None
    bounds = _bounds(local.where(F.col("total") >= F.lit(level).cast(_SUM)), least, keys, F.lit(level).cast(_SUM))
    floor = _kth(bounds, k)  # round 1's k keys need not all be sent again
    floor = tau if floor is None else max(tau, floor)
    return bounds.where(F.col("high") >= F.lit(floor).cast(_SUM)).select(*keys)


def top_n(sales: DataFrame, keys: list[str], k: int, post: str = "none", measure: str = "sales") -> DataFrame:
    """The rows of ``marts.top_n`` with a cut-off ``k``, by threshold rounds."""
    local = local_sums(sales, keys, scratch_path(sales.sparkSession, "local-sums"), measure)
    few = candidates(local, keys, k)
    left = local if few is None else local.join(few, keys, "left_semi")
    return marts.top_n(left.select(*keys, F.col("total").alias(measure)), keys, k, post, measure)
