"""Registered correlation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.correlate import corr_matrix, one_hot
from salesmart.plans.registry import query, with_sales
from salesmart.sources.star import sales_view, star_sum
from salesmart.sources.tables import Tables


def _corr_sql(dim: str) -> str:
    r = "round_even(corr(a.x, b.x) * 10000, 0) / 10000"
    return with_sales(f"""
, base AS (SELECT row_number() OVER () AS rid, {dim} AS v, sales AS y FROM sales)
, vals AS (SELECT v, row_number() OVER (ORDER BY v) AS pos
           FROM (SELECT DISTINCT v FROM base WHERE v IS NOT NULL) d)
, feat AS (SELECT CAST(0 AS BIGINT) AS pos, 'sales' AS feature
           UNION ALL SELECT pos, '{dim}_' || v FROM vals)
, cells AS (SELECT rid, CAST(0 AS BIGINT) AS pos, CAST(y AS DOUBLE) AS x FROM base
            UNION ALL
            SELECT b.rid, vals.pos, CASE WHEN coalesce(b.v = vals.v, false) THEN 1.0 ELSE 0.0 END
            FROM base b CROSS JOIN vals)
SELECT fx.feature AS feature_x, fy.feature AS feature_y, a.pos AS pos_x, b.pos AS pos_y,
       {r} AS r,
       CASE WHEN a.pos < b.pos THEN {r} ELSE 0.0 END AS r_upper
FROM cells a JOIN cells b ON a.rid = b.rid
JOIN feat fx ON fx.pos = a.pos JOIN feat fy ON fy.pos = b.pos
GROUP BY fx.feature, fy.feature, a.pos, b.pos""")


def _register(dim: str) -> None:
    def build(t: Tables) -> DataFrame:
        # The moments are summed per part or order key below the joins: one scan of the lines.
        groups = star_sum(t, [dim], counts=True, squares=True).groupBy(F.col(dim).alias("v")).agg(
            F.sum("lines").alias("n_v"), F.sum("n").alias("m_v"), F.sum("sales").alias("s_v"), F.sum("sales_sq").alias("q_v"))
        return corr_matrix(groups, dim, "sales")

    build.__doc__ = f"C1-C3: one-hot correlation of sales with {dim}"
    query(f"corr_{dim}", _corr_sql(dim))(build)


for _dim in ("segment", "category", "ship_mode"):
    _register(_dim)


# The segments of the fixture's customers.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot_segment", with_sales("SELECT order_id, sales, " + ", ".join(
    f"CAST(coalesce(segment = '{v}', false) AS INTEGER) AS segment_{v}" for v in SEGMENTS) + " FROM sales"))
def one_hot_segment(t: Tables) -> DataFrame:
    """Every line with its segment as indicator columns."""
    return one_hot(sales_view(t, ["order_id", "sales", "segment"]), "segment", SEGMENTS)
