"""Marts kept up to date from signed daily partial sums (A1-A9, K4 after U1).

A full rebuild of the marts reads every line. Here each delivery adds a batch
of partial sums to a log, one row per day, key set and key, and a replaced day
subtracts what the log holds of it. Sums are exact decimals, so a subtraction
leaves nothing behind: totals over the log equal a rebuild from the lines.

    <root>/partials/batch=N   signed sums of delivery N, by day, sorted by day
    <root>/totals/batch=N     sums per key set and key after delivery N

``deliver`` reads the delivery's lines, the partials of the delivery's days
(other days' row groups are skipped by the files' own minima and maxima) and
the totals one batch back. It never reads lines of other days. Both folders
are written under the batch's number from batches before it: a delivery that
failed halfway, or is run twice, gives the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import marts
from salesmart.session import materialize

_DAY = "order_date"
_ZERO = "decimal(38,4)"


def key_sets() -> list[list[str]]:
    """The keys of the registered marts."""
    return list({tuple(spec["keys"]): spec["keys"] for spec in marts.MARTS.values()}.values())


def partials(lines: DataFrame, sets: list[list[str]] | None = None, measure: str = "sales") -> DataFrame:
    """Exact sums of ``lines`` per day, key set and key, from one scan, combined in every task first.

    Columns: order_date, key_set, the keys (NULL where the set has them not), the measure, n
    (lines with a measure) and lines. Lines without a day, or without one of a set's keys, are
    in no mart and left out of it.
    """
    sets = sets or key_sets()
    dated = lines.where(F.col(_DAY).isNotNull())
    grouped = marts.grouped_sums(dated, [[_DAY, *s] for s in sets], measure)
    names = {marts.set_name([_DAY, *s]): marts.set_name(s) for s in sets}
    keys = list(dict.fromkeys(c for s in sets for c in s))
    whole = F.lit(False)
    for s in sets:
        given = F.col("key_set") == marts.set_name([_DAY, *s])
        for c in s:
            given = given & F.col(c).isNotNull()
        whole = whole | given
    plain = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return grouped.where(whole).select(_DAY, plain[F.col("key_set")].alias("key_set"), *keys,
                                       F.coalesce(measure, F.lit(0)).cast(_ZERO).alias(measure), "n", "lines")


def _summed(rows: DataFrame, by: list[str], measure: str) -> DataFrame:
    out = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (measure, "n", "lines")])
    return out.withColumn(measure, F.col(measure).cast(_ZERO))


def _read(spark: SparkSession, root: str, name: str, batches: list[int], schema) -> DataFrame:
    """The folders of some batches (none: no rows)."""
    paths = [f"{root.rstrip('/')}/{name}/batch={b}" for b in batches]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def deliver(lines: DataFrame, root: str, batch: int, sets: list[list[str]] | None = None, measure: str = "sales") -> DataFrame:
    """Add delivery ``batch`` (0, 1, 2 ...): its days replace what batches before it held of them.

    A day is replaced whole, as in U1: lines of it that the delivery doesn't bring are gone.
    Returns the totals after the delivery.
    """
    spark = lines.sparkSession
    new = partials(lines, sets, measure)
    by = [c for c in new.columns if c not in (measure, "n", "lines")]
    before = _read(spark, root, "partials", list(range(batch)), new.schema)
    # Bounds go to the scan as literals, the exact days by a semi join.
    days = lines.select(_DAY).where(F.col(_DAY).isNotNull()).distinct()
    if batch:
        days = materialize(days)  # asked for twice
        span = days.agg(F.min(_DAY).alias("low"), F.max(_DAY).alias("high")).first()
    if batch and span.low is not None:
        old = before.where(F.col(_DAY).between(F.lit(span.low), F.lit(span.high))).join(days, _DAY, "left_semi")
        new = new.unionByName(old.select(*by, *[(-F.col(c)).alias(c) for c in (measure, "n", "lines")]))
    signed = _summed(new, by, measure).where(F.greatest(F.abs(F.col(measure)), F.abs("n"), F.abs("lines")) > 0)
    signed = signed.select(*[f.name for f in before.schema.fields])
    here = f"{root.rstrip('/')}/partials/batch={batch}"
    signed.repartitionByRange(_DAY, "key_set", *by[2:]).sortWithinPartitions(_DAY).write.mode("overwrite").parquet(here)
    change = spark.read.schema(before.schema).parquet(here).drop(_DAY)
    totals = _read(spark, root, "totals", [batch - 1] if batch else [], change.schema)
    keys = by[1:]
    merged = _summed(totals.unionByName(change), keys, measure).where(F.col("lines") > 0).select(*change.columns)
    merged.write.mode("overwrite").parquet(f"{root.rstrip('/')}/totals/batch={batch}")
    return spark.read.schema(change.schema).parquet(f"{root.rstrip('/')}/totals/batch={batch}")


def build(totals: DataFrame) -> dict[str, DataFrame]:
    """The registered marts from ``deliver``'s totals, by name."""
    return {name: marts.mart(marts.of_keys(totals, spec["keys"]), name) for name, spec in marts.MARTS.items()}
