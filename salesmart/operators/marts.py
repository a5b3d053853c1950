"""Aggregations and top-N marts.

Plan shape for every mart: scan (key, sales) -> partial HashAggregate per
task -> shuffle of at most (#keys x #tasks) rows -> final HashAggregate ->
TakeOrderedAndProject for a top-k, so only k rows per task reach the final
merge. Nothing is collected to the driver.

Shared semantics (from the reference's pandas group-bys):
1. rows with a NULL key are dropped;
2. NULL sales are skipped and a group whose sales are all NULL sums to 0.0;
3. ties at the cut-off are broken by the key, ascending;
4. sorting uses the unrounded value; rounding / int casts come after the cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.numeric import (
    currency_label, money, money_sum, round4, round_even, trunc_bigint,
)

# Mart registry (K4): name -> grouping keys, top-k (None = all), post-step.
# The nine marts and their cut-offs.
MARTS: dict[str, dict] = {
    "top_customers": {"keys": ["customer_name"], "k": 20, "post": "round2"},
    "top_cities": {"keys": ["city"], "k": 20, "post": "round2"},
    "top_categories": {"keys": ["category"], "k": None, "post": "none"},
    "top_products": {"keys": ["product_name"], "k": 8, "post": "round2"},
    "top_sub_categories": {"keys": ["category", "sub_category"], "k": 10, "post": "int"},
    "top_segments": {"keys": ["segment"], "k": None, "post": "none"},
    "top_regions": {"keys": ["region"], "k": None, "post": "int"},
    "top_shippings": {"keys": ["ship_mode"], "k": None, "post": "none"},
}


def _exact_sum(df: DataFrame, measure: str):
    """Decimal sum: money values are cast to decimal(18,4); decimal inputs
    (already-exact partial sums) are summed as they are, without narrowing."""
    if isinstance(df.schema[measure].dataType, T.DecimalType):
        return F.sum(measure).cast("double")
    return money_sum(measure)


def group_sum(sales: DataFrame, keys: list[str], measure: str = "sales") -> DataFrame:
    """Exact money sum of ``measure`` per key; null keys dropped, all-null -> 0.0.

    ``measure`` may hold line values (double) or exact partial sums
    (decimal, e.g. from ``star_sum``); the result is the same.
    """
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    src = sales.where(cond) if cond is not None else sales
    return src.groupBy(*keys).agg(
        F.coalesce(_exact_sum(src, measure), F.lit(0.0)).alias(measure))


def grouped_sums(sales: DataFrame, key_sets: list[list[str]], measure: str = "sales") -> DataFrame:
    """Sums for several marts from one scan (GROUPING SETS, combined map-side).

    One row per key set and key: ``key_set`` (its name, see ``of_keys``), the
    keys (NULL where the set has them not), the exact sum, ``n`` (rows with a
    measure), ``lines`` (rows) and ``sales_sq`` (exact sum of squares).
    """
    keys = list(dict.fromkeys(c for s in key_sets for c in s))
    y = money(F.col(measure).cast("double"))
    name = F.lit(None).cast("string")
    for s in key_sets:
        # grouping_id: a bit per key, the first key highest, set where the key is summed over.
        absent = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in s)
        name = F.when(F.grouping_id() == absent, set_name(s)).otherwise(name)
    return sales.groupingSets(key_sets, *keys).agg(
        name.alias("key_set"), F.sum(y).alias(measure), F.count(measure).alias("n"),
        F.count(F.lit(1)).alias("lines"), F.sum(y * y).alias("sales_sq"))


def set_name(keys: list[str]) -> str:
    return "-".join(keys)


def of_keys(grouped: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of one key set of ``grouped_sums``: a mart's input like the lines themselves."""
    return grouped.where(F.col("key_set") == set_name(keys)).drop("key_set", *[
        c for c in grouped.columns if c not in (*keys, "sales", "n", "lines", "sales_sq")])


def _post(df: DataFrame, post: str, measure: str) -> DataFrame:
    if post == "round2":
        return df.withColumn(measure, round_even(measure, 2))
    if post == "int":
        return df.withColumn(measure, trunc_bigint(measure))
    if post == "none":
        return df
    raise ValueError(f"unknown post step {post!r}")


def top_n(sales: DataFrame, keys: list[str], k: int | None = None,
          post: str = "none", measure: str = "sales") -> DataFrame:
    """Generic mart: group, sum, sort descending (key ascending on ties), cut, post."""
    g = group_sum(sales, keys, measure)
    order = [F.col(measure).desc()] + [F.col(c).asc() for c in keys]
    out = g.orderBy(*order)
    if k is not None:
        out = out.limit(k)
    return _post(out, post, measure)


def mart(sales: DataFrame, name: str) -> DataFrame:
    """One of the registered marts by name."""
    spec = MARTS[name]
    out = top_n(sales, spec["keys"], spec["k"], spec["post"])
    if name == "top_sub_categories":
        # Re-sorted by category after the cut (A5).
        out = out.orderBy("category", F.col("sales").desc(), "sub_category")
    return out


def top_sub_categories_all(sales: DataFrame) -> DataFrame:
    """Per category, the sum of A5's truncated top-10 rows (a partial total)."""
    a5 = mart(sales, "top_sub_categories")
    return (a5.groupBy("category").agg(F.sum("sales").cast("bigint").alias("sales"))
            .orderBy("category"))


def mart_totals(sales: DataFrame, key: str = "category") -> DataFrame:
    """Rows per key plus the grand total in one pass (ROLLUP).

    ``is_total`` marks the grand-total row (its key is NULL); ``label`` is the
    '$' + integer text the reference puts in chart captions.
    """
    src = sales.where(F.col(key).isNotNull())
    g = src.rollup(key).agg(F.coalesce(_exact_sum(src, "sales"), F.lit(0.0)).alias("sales"),
                            F.grouping(key).cast("boolean").alias("is_total"))
    return g.withColumn("label", currency_label("sales"))


def share_of_total(sales: DataFrame, key: str = "category") -> DataFrame:
    """Each key's sales and share of the total.

    The total is a one-row subquery over the aggregated keys: any number of
    keys stays spread over tasks. The share is NULL where the total is 0.
    """
    g = group_sum(sales, [key])
    total = g.select(F.sum(money("sales")).cast("double")).scalar()
    return (g.withColumn("share", round4(F.try_divide("sales", total)))
             .withColumn("label", F.concat(F.lit("$"), F.rint("sales").cast("bigint").cast("string"))))


def top_n_per_group(sales: DataFrame, group: list[str], keys: list[str], k: int,
                    post: str = "round2", measure: str = "sales") -> DataFrame:
    """Top-k keys inside each group.

    ``row_number() <= k`` lets Spark plan a partial WindowGroupLimit before
    the shuffle, so each task ships at most k rows per group; a group as big
    as a third of the data never reaches one task whole.
    """
    g = group_sum(sales, group + keys, measure)
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc(), *[F.col(c).asc() for c in keys])
    out = (g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("bigint")))
    return _post(out, post, measure)


CAPTIONED_MARTS = ("top_categories", "top_products", "top_segments", "top_shippings")


def grand_totals(built: dict[str, DataFrame]) -> DataFrame:
    """A11 for the reference's captioned marts: one row per mart with its
    total and the '$' + integer caption. ``built`` maps mart name -> mart
    frame; the top-products total adds the mart's rounded top-8 values, as
    the caption under that chart does."""
    parts = [built[name].agg(F.sum("sales").alias("total")).select(
                 F.lit(name).alias("mart"), round_even("total", 2).alias("total"),
                 currency_label("total").alias("label"))
             for name in CAPTIONED_MARTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
