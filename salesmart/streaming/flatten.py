"""The star flatten as a stream (J2 on X1): an order feed and a line feed meet.

Every row says when it happened (``at``) and when it landed (``landed_at``). A
line belongs to the order of its key that happened at most ``within`` before it.
Both feeds have watermarks, so an order is held until no line in time can
follow, and a line until no order in time can: state is bounded by the interval
and the feed's delay, not by history. Dimensions are static tables, joined behind.

Nothing is lost silently. A line that landed more than ``delay`` after it
happened is refused on arrival, by its own two times (so the same lines on every
run, whatever the watermark was); a line whose order doesn't come in time leaves
the join without one. Both go to the reject table with the reason. A feed that
rests keeps the last lines waiting: ``heartbeat`` lands a row that only moves the
watermarks on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.schema import ODS_COLUMNS
from salesmart.sources.star import with_dimensions
from salesmart.sources.tables import Tables

AT, LANDED = "at", "landed_at"
REASON = "reason"
NO_ORDER = -(1 << 63)


def _late(delay: str) -> Column:
    return F.col(LANDED) > F.col(AT) + F.expr(f"INTERVAL {delay}")


def joined(orders: DataFrame, lines: DataFrame, within: str = "30 days", delay: str = "2 days") -> DataFrame:
    """Each line of ``lines`` with its order's columns, or with NULLs if none came in time. The feeds hold
    ``o_orderkey`` and ``l_orderkey``, and both times; lines that landed late, or have no key or time, are not here."""
    o = orders.withColumnRenamed(AT, "o_at").drop(LANDED).withWatermark("o_at", delay)
    li = lines.where(F.col(AT).isNotNull() & ~_late(delay)).withColumnRenamed(AT, "l_at").drop(LANDED).withWatermark("l_at", delay)
    near = F.expr(f"l_orderkey = o_orderkey AND l_at >= o_at AND l_at <= o_at + INTERVAL {within}")
    return li.join(o, near, "left_outer")


def refused(lines: DataFrame, delay: str = "2 days") -> DataFrame:
    """Lines that ``joined`` doesn't take in, with the reason; stateless."""
    why = F.when(F.col(AT).isNull() | F.col(LANDED).isNull(), "no time").when(_late(delay), "landed late")
    return lines.where("l_orderkey IS NOT NULL OR l_partkey IS NOT NULL").withColumn(REASON, why).where(F.col(REASON).isNotNull())


def run_flatten(orders: DataFrame, lines: DataFrame, tables: Tables, flat: str, rejects: str, checkpoint: str,
                within: str = "30 days", delay: str = "2 days"):
    """Run over everything available now: flat sales rows to ``flat``, lines without an order in time to
    ``rejects/no_order``, lines refused on arrival to ``rejects/refused``. A micro-batch that is run again
    writes its own folder again. Returns the finished join."""
    columns = [c for c in lines.columns if c not in (AT, LANDED)]

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # two writes: without it each runs the join, and writes its state, again
        found = batch.where("o_orderkey IS NOT NULL")
        with_dimensions(found, tables).write.mode("overwrite").parquet(f"{flat}/batch={number}")
        lost = batch.where("o_orderkey IS NULL AND (l_orderkey IS NOT NULL OR l_partkey IS NOT NULL)")  # a heartbeat is no line
        lost.select(*columns, F.lit("no order in time").alias(REASON)).write.mode("overwrite").parquet(f"{rejects}/no_order/batch={number}")
        batch.unpersist()

    def write_refused(batch: DataFrame, number: int) -> None:
        batch.select(*columns, REASON).write.mode("overwrite").parquet(f"{rejects}/refused/batch={number}")

    queries = [joined(orders, lines, within, delay).writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/join")
               .outputMode("append").trigger(availableNow=True).start(),
               refused(lines, delay).writeStream.foreachBatch(write_refused).option("checkpointLocation", f"{checkpoint}/refused")
               .trigger(availableNow=True).start()]
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return queries[0]


def heartbeat(feed: DataFrame, path: str, at: str) -> None:
    """Land a row in the feed at ``path`` (of the columns of ``feed``) that is nothing but its two times, ``at``.

    An order needs a key that no line has, since orders without one never reach the watermark.
    """
    row = {AT: F.lit(at), LANDED: F.lit(at), "o_orderkey": F.lit(NO_ORDER)}
    feed.sparkSession.range(1).select(*[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in feed.schema.fields]
                                      ).write.mode("append").parquet(path)


def flat_rows(tables: Tables, path: str) -> DataFrame:
    """What ``run_flatten`` has written so far, as the flat sales table."""
    return tables.spark.read.parquet(path).select(*ODS_COLUMNS)
