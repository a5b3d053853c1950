"""Registered queries over deliveries of whole days: what they change, and marts kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators import changes, marts, rolling
from salesmart.plans.cleansing import INCREMENT_DAY, REDELIVERY_FROM, REDELIVERY_TO
from salesmart.plans.marts import _SUM
from salesmart.plans.registry import query, with_sales
from salesmart.schema import ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources.star import landed_sales, sales_view
from salesmart.sources.tables import Tables

_ODS_LIST = ", ".join(ODS_COLUMNS)
_IN_WEEK = f"order_date BETWEEN DATE '{REDELIVERY_FROM}' AND DATE '{REDELIVERY_TO}'"


def corrected(lines: DataFrame) -> DataFrame:
    """A delivery that isn't what came before: some orders are gone, some lines cost twice as
    much, and some come twice."""
    order = F.col("order_id").cast("bigint")
    kept = lines.where(order % 11 != 0).withColumn("sales", F.when(order % 7 == 0, F.col("sales") * 2).otherwise(F.col("sales")))
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(order % 13 == 0, 2).otherwise(1)))).drop("copy")


_CORRECTED = f"""
, week AS (SELECT {_ODS_LIST} FROM sales WHERE {_IN_WEEK})
, kept_ AS (SELECT {", ".join("CASE WHEN CAST(order_id AS BIGINT) % 7 = 0 THEN sales * 2 ELSE sales END AS sales" if c == "sales" else c
                              for c in ODS_COLUMNS)} FROM week WHERE CAST(order_id AS BIGINT) % 11 <> 0)
, delivery AS (SELECT * FROM kept_ UNION ALL SELECT * FROM kept_ WHERE CAST(order_id AS BIGINT) % 13 = 0)
, added AS (SELECT * FROM delivery EXCEPT ALL SELECT * FROM week)
, removed AS (SELECT * FROM week EXCEPT ALL SELECT * FROM delivery)
, same AS (SELECT * FROM week INTERSECT ALL SELECT * FROM delivery)
, changes AS (SELECT *, 'added' AS change FROM added UNION ALL SELECT *, 'removed' FROM removed UNION ALL SELECT *, 'kept' FROM same)
"""


def _changes(t: Tables) -> DataFrame:
    s = sales_view(t)
    landed = scratch_path(t.spark, "delivery")
    corrected(s.where(F.expr(_IN_WEEK))).write.parquet(landed)
    return changes.change_set(s, t.spark.read.schema(s.schema).parquet(landed))


@query("ods_change_set", with_sales(_CORRECTED + f"SELECT {_ODS_LIST}, change, COUNT(*) AS lines FROM changes GROUP BY ALL"))
def ods_change_set(t: Tables) -> DataFrame:
    """The lines that a corrected week adds to the archive, takes from it and leaves."""
    return _changes(t)


@query("ods_change_counts", with_sales(_CORRECTED + """
SELECT order_date, CAST(COUNT(*) FILTER (change = 'added') AS BIGINT) AS added, CAST(COUNT(*) FILTER (change = 'removed') AS BIGINT) AS removed,
       CAST(COUNT(*) FILTER (change = 'kept') AS BIGINT) AS kept,
       CAST(coalesce(SUM(CASE change WHEN 'added' THEN CAST(sales AS DECIMAL(18,4)) WHEN 'removed' THEN -CAST(sales AS DECIMAL(18,4)) END), 0) AS DOUBLE) AS sales_change
FROM changes GROUP BY order_date"""))
def ods_change_counts(t: Tables) -> DataFrame:
    """Per re-delivered day, how many lines changed and by how much sales did."""
    return changes.change_counts(_changes(t))


def _marts_sql() -> str:
    parts = []
    for name, spec in marts.MARTS.items():
        keys = ", ".join(spec["keys"])
        value = {"round2": "round_even(s * 100, 0) / 100", "int": "trunc(s)", "none": "s"}[spec["post"]]
        limit = f" LIMIT {spec['k']}" if spec["k"] else ""
        parts.append(f"""SELECT '{name}' AS mart, {" || ' / ' || ".join(spec["keys"])} AS key, CAST({value} AS DOUBLE) AS sales FROM (
  SELECT {keys}, {_SUM} AS s FROM sales WHERE {" AND ".join(f"{c} IS NOT NULL" for c in spec["keys"])}
  GROUP BY {keys} ORDER BY s DESC, {keys}{limit}) {name}_""")
    return with_sales("\nUNION ALL\n".join(parts))


def in_one(built: dict[str, DataFrame]) -> DataFrame:
    """All marts as one frame: mart, key, sales."""
    out = None
    for name, df in built.items():
        part = df.select(F.lit(name).alias("mart"), F.concat_ws(" / ", *marts.MARTS[name]["keys"]).alias("key"),
                         F.col("sales").cast("double").alias("sales"))
        out = part if out is None else out.unionByName(part)
    return out


@query("marts_after_deliveries", _marts_sql())
def marts_after_deliveries(t: Tables) -> DataFrame:
    """A1-A9 from partial sums: the archive, a faulty week, the days after it, and the week again, as it should be."""
    keys = list(dict.fromkeys(c for s in rolling.key_sets() for c in s))
    lines = landed_sales(t, ["order_id", "order_date", *keys, "sales"])
    s = lines.drop("order_id")
    day, low, high = F.col("order_date"), F.lit(REDELIVERY_FROM).cast("date"), F.lit(REDELIVERY_TO).cast("date")
    week = day.between(low, high)
    faulty = lines.where(week & (day != F.lit(INCREMENT_DAY).cast("date")))
    root, totals = scratch_path(t.spark, "mart-log"), None
    for batch, sent in enumerate((s.where(day < low), corrected(faulty).drop("order_id"), s.where(day > high), s.where(week))):
        totals = rolling.deliver(sent, root, batch)
    return in_one(rolling.build(totals))
