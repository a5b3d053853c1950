"""Registered mart queries (A1-A12, O5, J1) over the fixture star schema.

Marts read ``star_sum``: sales are summed by foreign key before the
dimension joins, then summed again per mart key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators import geo, marts, topk
from salesmart.plans.registry import ORACLES, query, with_sales
from salesmart.sources.star import sales_view, star_sum
from salesmart.sources.tables import Tables

_SUM = "COALESCE(CAST(SUM(CAST(sales AS DECIMAL(18,4))) AS DOUBLE), 0.0)"


def _top_sql(keys: list[str], k: int | None, post: str) -> str:
    key_list = ", ".join(keys)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    order = f"ORDER BY s DESC, {key_list}" + (f" LIMIT {k}" if k else "")
    value = {"round2": "round_even(s * 100, 0) / 100",
             "int": "CAST(trunc(s) AS BIGINT)",
             "none": "s"}[post]
    return with_sales(f"""
SELECT {key_list}, {value} AS sales FROM (
  SELECT {key_list}, {_SUM} AS s FROM sales WHERE {not_null}
  GROUP BY {key_list} {order}
) t""")


def _register_mart(name: str) -> None:
    spec = marts.MARTS[name]

    def build(t: Tables) -> DataFrame:
        return marts.mart(star_sum(t, spec["keys"]), name)

    build.__doc__ = f"{name}: top marts over {spec['keys']}"
    query(name, _top_sql(spec["keys"], spec["k"], spec["post"]))(build)


for _name in marts.MARTS:
    _register_mart(_name)


@query("top_customers_threshold")
def top_customers_threshold(t: Tables) -> DataFrame:
    """O2 + A1: the top-20 customers of the flat lines, by threshold rounds."""
    spec = marts.MARTS["top_customers"]
    return topk.top_n(sales_view(t, [*spec["keys"], "sales"]), spec["keys"], spec["k"], spec["post"])


ORACLES["top_customers_threshold"] = ORACLES["top_customers"]


@query("top_sub_categories_all", with_sales(f"""
SELECT category, CAST(SUM(v) AS BIGINT) AS sales FROM (
  SELECT category, CAST(trunc(s) AS BIGINT) AS v FROM (
    SELECT category, sub_category, {_SUM} AS s FROM sales
    WHERE category IS NOT NULL AND sub_category IS NOT NULL
    GROUP BY category, sub_category ORDER BY s DESC, category, sub_category LIMIT 10) a
) b GROUP BY category"""))
def top_sub_categories_all(t: Tables) -> DataFrame:
    """Category sums of the truncated top-10 sub-categories."""
    return marts.top_sub_categories_all(star_sum(t, ["category", "sub_category"]))


def nation_code_lookup(t: Tables) -> DataFrame:
    """Fixture stand-in for the state-code table: one code per nation name,
    derived from the nation table, with one nation left out on purpose so the
    unmatched-state path is exercised."""
    n = t.nation
    return (n.where(F.col("n_nationkey") != 7)
             .select(F.col("n_name").alias("state"),
                     F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                     .alias("state_code")))


@query("sales_by_state", with_sales(f"""
SELECT g.state, l.state_code, g.sales FROM (
  SELECT state, {_SUM} AS sales FROM sales WHERE state IS NOT NULL GROUP BY state) g
LEFT JOIN (SELECT n_name AS state, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code
           FROM nation WHERE n_nationkey <> 7) l ON g.state = l.state"""))
def sales_by_state(t: Tables) -> DataFrame:
    """A10 + J1: per-state sales, code attached by name."""
    return geo.sales_by_state(star_sum(t, ["state"]), nation_code_lookup(t))


@query("mart_totals", with_sales(f"""
SELECT category, {_SUM} AS sales, GROUPING(category) = 1 AS is_total,
       '$' || CAST(CAST(trunc({_SUM}) AS BIGINT) AS VARCHAR) AS label
FROM sales WHERE category IS NOT NULL GROUP BY ROLLUP (category)"""))
def mart_totals(t: Tables) -> DataFrame:
    """Category rows plus the grand total (ROLLUP)."""
    return marts.mart_totals(star_sum(t, ["category"]), "category")


@query("category_share", with_sales(f"""
SELECT category, sales,
       round_even(sales / CAST(SUM(CAST(sales AS DECIMAL(18,4))) OVER () AS DOUBLE) * 10000, 0) / 10000 AS share,
       '$' || CAST(CAST(round_even(sales, 0) AS BIGINT) AS VARCHAR) AS label
FROM (SELECT category, {_SUM} AS sales FROM sales WHERE category IS NOT NULL GROUP BY category) g"""))
def category_share(t: Tables) -> DataFrame:
    """Share of total per category."""
    return marts.share_of_total(star_sum(t, ["category"]), "category")


@query("top_products_per_region", with_sales(f"""
SELECT region, product_name, round_even(sales * 100, 0) / 100 AS sales, rank FROM (
  SELECT region, product_name, sales,
         row_number() OVER (PARTITION BY region ORDER BY sales DESC, product_name) AS rank
  FROM (SELECT region, product_name, {_SUM} AS sales FROM sales
        WHERE region IS NOT NULL AND product_name IS NOT NULL
        GROUP BY region, product_name) g
) r WHERE rank <= 3"""))
def top_products_per_region(t: Tables) -> DataFrame:
    """Top-3 products inside each region."""
    return marts.top_n_per_group(star_sum(t, ["region", "product_name"]),
                                 ["region"], ["product_name"], 3)


def _grand_sql() -> str:
    parts = []
    for name, key, k, rounded in (("top_categories", "category", None, False),
                                   ("top_products", "product_name", 8, True),
                                   ("top_segments", "segment", None, False),
                                   ("top_shippings", "ship_mode", None, False)):
        v = "round_even(s * 100, 0) / 100" if rounded else "s"
        lim = f" ORDER BY s DESC, {key} LIMIT {k}" if k else ""
        parts.append(f"""SELECT '{name}' AS mart, round_even(SUM(v) * 100, 0) / 100 AS total,
       '$' || CAST(CAST(trunc(SUM(v)) AS BIGINT) AS VARCHAR) AS label
FROM (SELECT {v} AS v FROM (SELECT {key}, {_SUM} AS s FROM sales WHERE {key} IS NOT NULL
      GROUP BY {key}{lim}) a) b""")
    return with_sales("\nUNION ALL\n".join(parts))


@query("mart_grand_totals", _grand_sql())
def mart_grand_totals(t: Tables) -> DataFrame:
    """A11 + P18: totals and '$' captions of the category, top-8 product,
    segment and ship-mode marts."""
    built = {name: marts.mart(star_sum(t, marts.MARTS[name]["keys"]), name)
             for name in marts.CAPTIONED_MARTS}
    return marts.grand_totals(built)
