"""Eager aggregation (star_sum) equals grouping the flat view, for every key shape."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators.marts import group_sum
from salesmart.sources.star import sales_view, star_sum
from salesmart.sources.tables import Tables

KEY_SETS = [
    ["customer_name"], ["city"], ["segment", "region"], ["state"], ["postal_code"],
    ["order_date"], ["ship_mode", "segment"], ["category"], ["sub_category", "product_name"],
    ["product_id"], ["region", "product_name"], ["order_date", "category"], ["ship_date"],
]


@pytest.mark.parametrize("keys", KEY_SETS, ids=lambda k: "+".join(k))
def test_star_sum_matches_flat_view(spark, data_dir, keys):
    t = Tables(spark, data_dir)
    eager = {tuple(r[k] for k in keys): r.sales for r in group_sum(star_sum(t, keys), keys).collect()}
    flat = {tuple(r[k] for k in keys): r.sales
            for r in group_sum(sales_view(t, keys + ["sales"]), keys).collect()}
    assert eager == flat


def test_star_sum_counts(spark, data_dir):
    t = Tables(spark, data_dir)
    got = star_sum(t, ["order_date"], counts=True).agg(F.sum("n")).first()[0]
    assert got == t.lineitem.count()
