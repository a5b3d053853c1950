"""What a re-delivered day changed (U1, K2): the lines added, removed and kept.

Lines have no key and may repeat, so archive and delivery are compared as
multisets: a line that is there ``a`` times before and ``d`` times after is kept
min(a, d) times and added or removed for the rest. Rows are compared by value
over all columns, NULL equal to NULL.

The comparison is a full outer join of the two sides' counted lines, planned as
one aggregate over both: equal lines meet in one group, counted in every task
first, so a line repeated a million times is one row per task and a day with a
third of all lines spreads over its lines' hashes. One exchange, no fingerprints
that could collide, no sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED, KEPT = "added", "removed", "kept"


def _delivered_days(archive: DataFrame, delivery: DataFrame, key: str) -> DataFrame:
    """The archive's lines of the days that the delivery brings (those that it replaces)."""
    days = delivery.select(key).where(F.col(key).isNotNull()).distinct()
    return archive.join(days, key, "left_semi").select(*archive.columns)


def line_counts(archive: DataFrame, delivery: DataFrame, key: str = "order_date") -> DataFrame:
    """Every different line of the delivered days with its number ``before`` and ``after``.

    Lines without a day are no part of a delivery (as in ``replace_days``). Column order and
    types are the archive's; an empty delivery gives no rows.
    """
    cols = archive.columns
    sides = [(_delivered_days(archive, delivery, key), 1, 0),
             (delivery.where(F.col(key).isNotNull()).select(*[F.col(c).cast(archive.schema[c].dataType) for c in cols]), 0, 1)]
    both = [df.select(*cols, F.lit(b).cast("bigint").alias("before"), F.lit(a).cast("bigint").alias("after")) for df, b, a in sides]
    return both[0].unionByName(both[1]).groupBy(*cols).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))


def change_set(archive: DataFrame, delivery: DataFrame, key: str = "order_date", kept: bool = True) -> DataFrame:
    """The lines of the delivered days with ``change`` (added, removed, kept) and ``lines`` (how many).

    ``kept=False`` leaves the unchanged lines out, for a log of changes.
    """
    before, after = F.col("before"), F.col("after")
    found = F.array(*[F.struct(F.lit(name).alias("change"), n.alias("lines")) for name, n in (
        (ADDED, after - before), (REMOVED, before - after), *([(KEPT, F.least(before, after))] if kept else []))])
    rows = line_counts(archive, delivery, key).withColumn("c", F.explode(F.filter(found, lambda x: x["lines"] > 0)))
    return rows.select(*archive.columns, "c.change", "c.lines")


def change_counts(changes: DataFrame, key: str = "order_date", measure: str = "sales") -> DataFrame:
    """Per day: lines added, removed and kept, and what the change adds to the exact sum of ``measure``."""
    value = F.coalesce(F.col(measure).cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)")) * F.col("lines").cast("decimal(10,0)")
    n = lambda name: F.sum(F.when(F.col("change") == name, F.col("lines")).otherwise(0)).alias(name)
    signed = F.when(F.col("change") == ADDED, value).when(F.col("change") == REMOVED, -value)
    return changes.groupBy(key).agg(n(ADDED), n(REMOVED), n(KEPT),
                                    F.coalesce(F.sum(signed).cast("double"), F.lit(0.0)).alias(f"{measure}_change"))
