"""Profiles from sketches that are kept per day and merged (A14, A15 over any span of days).

The exact profile (``quality``) reads every line again for every question. Here one
scan leaves, per day, a row of small sketches; any days' rows merge into the
profile of those days, and a day that is replaced just replaces its row. All are Spark's
own aggregates, combined in every task first, so a day holding a third of the lines
is a few kilobytes per task before the shuffle.

Counts, NULLs, least and greatest are exact. The rest has stated errors:

* quantiles (KLL with ``k``): the rank of an answer is within ``rank_error(k)`` of the one
  asked for, with 99 % confidence - 0.7 % of the values for the default of 400;
* distinct values (HLL with 2^``lg`` registers): relative standard error
  ``distinct_error(lg)`` - 1.6 % for the default of 12;
* frequent values (``tracked`` items): a count is too high or an item too low by at most
  ``count_error(tracked)`` of the values, so an item above that share is never missed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUANTILES = (0.25, 0.5, 0.75)
K, LG, TRACKED = 400, 12, 1000


def rank_error(k: int = K) -> float:
    """Published bound of a KLL sketch: normalised rank error at 99 % confidence."""
    return 2.296 / k ** 0.9723


def distinct_error(lg: int = LG) -> float:
    """Published relative standard error of an HLL sketch."""
    return 1.04 / math.sqrt(1 << lg)


def count_error(tracked: int = TRACKED) -> float:
    """Published bound of a frequent-items sketch whose table has a power of two of slots, three quarters used."""
    return 3.5 / (1 << math.ceil(math.log2(tracked / 0.75)))


def _number(df: DataFrame, c: str) -> str:
    """SQL of a numeric or date column as a double (dates: days since 1970)."""
    return f"CAST(unix_date(`{c}`) AS DOUBLE)" if isinstance(df.schema[c].dataType, T.DateType) else f"CAST(`{c}` AS DOUBLE)"


def day_sketches(df: DataFrame, numbers: list[str], items: list[str], day: str = "order_date",
                 k: int = K, lg: int = LG, tracked: int = TRACKED) -> DataFrame:
    """One row per day (NULL is one): lines and, per column, a struct of counts, ends and sketches.

    ``numbers`` (numeric or date columns) get quantiles, ``items`` distinct counts and frequent
    values. NULLs are counted and left out of the sketches, as is NaN.
    """
    aggs = ["COUNT(1) AS lines"]
    for c in numbers:
        v = _number(df, c)
        there = f"`{c}` IS NOT NULL AND NOT isnan({v})"
        aggs.append(f"struct(COUNT_IF({there}) AS n, MIN({v}) FILTER (WHERE {there}) AS low, MAX({v}) FILTER (WHERE {there}) AS high, "
                    f"kll_sketch_agg_double({v}, {k}) FILTER (WHERE {there}) AS quantiles) AS `{c}`")
    for c in items:
        v = f"CAST(`{c}` AS STRING)"
        aggs.append(f"struct(COUNT(`{c}`) AS n, hll_sketch_agg({v}, {lg}) AS different, "
                    f"approx_top_k_accumulate({v}, {tracked}) AS frequent) AS `{c}`")
    return df.groupBy(F.col(day).alias("day")).agg(*[F.expr(a) for a in aggs])


def number_profile(sketches: DataFrame, numbers: list[str], probs=QUANTILES) -> DataFrame:
    """Per column of ``numbers``, over all rows of ``sketches``: column_name, lines, n (values), low, high and
    the quantiles q0, q1 ... (NULL without values). One scan."""
    asked = f"array({', '.join(f'{p}D' for p in probs)})"
    aggs = [F.sum("lines").alias("lines")]
    for i, c in enumerate(numbers):
        aggs += [F.sum(f"`{c}`.n").alias(f"n{i}"), F.min(f"`{c}`.low").alias(f"low{i}"), F.max(f"`{c}`.high").alias(f"high{i}"),
                 F.expr(f"kll_merge_agg_double(`{c}`.quantiles) FILTER (WHERE `{c}`.n > 0)").alias(f"s{i}")]
    row = sketches.agg(*aggs)
    out = row.select("lines", F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"low{i}").alias("low"), F.col(f"high{i}").alias("high"),
        F.when(F.col(f"n{i}") > 0, F.expr(f"kll_sketch_get_quantile_double(s{i}, {asked})")).alias("q"))
        for i, c in enumerate(numbers)])).alias("c"))
    return out.select("c.column_name", "lines", "c.n", "c.low", "c.high", *[F.col("c.q")[i].alias(f"q{i}") for i in range(len(probs))])


def item_profile(sketches: DataFrame, items: list[str], top: int = 5, tracked: int = TRACKED) -> DataFrame:
    """Per column of ``items``, over all rows of ``sketches``: column_name, lines, n (values), different (estimate)
    and frequent, an array of the ``top`` most frequent values with their estimated counts. No days: no rows."""
    aggs = [F.sum("lines").alias("lines")]
    for i, c in enumerate(items):
        aggs += [F.sum(f"`{c}`.n").alias(f"n{i}"), F.expr(f"hll_union_agg(`{c}`.different)").alias(f"h{i}"),
                 F.expr(f"approx_top_k_combine(`{c}`.frequent, {tracked})").alias(f"t{i}")]
    # One group, not none: this aggregate can't be merged over a task that has no rows at all.
    row = sketches.groupBy(F.lit(0).alias("all")).agg(*aggs)
    out = row.select("lines", F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.expr(f"hll_sketch_estimate(h{i})").alias("different"),
        F.expr(f"filter(approx_top_k_estimate(t{i}, {top + 1}), x -> x.item IS NOT NULL)").alias("frequent"))
        for i, c in enumerate(items)])).alias("c"))
    return out.select("c.column_name", "lines", "c.n", "c.different", F.slice("c.frequent", 1, top).alias("frequent"))
