"""Star flatten (J2): the 17-column ``sales`` view over normalised tables.

lineitem -> orders -> customer -> nation -> region, lineitem -> part.

Only the dimensions that the requested columns need are joined, so a mart
over (customer_name, sales) never touches part, nation or region. This relies
on referential integrity of the star (every line has its order, every order
its customer, ...), which the inputs guarantee; ``full_join=True`` joins
every dimension regardless.

Join strategy is left to Spark: lineitem/orders/customer/part are fact-sized
and go through sort-merge (hash-partitioned) joins; nation and region are a
few hundred bytes on disk, under ``autoBroadcastJoinThreshold``, so the
planner broadcasts them from their measured file size, and AQE re-checks the
choice with runtime sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.schema import ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources.tables import Tables

# Column of the sales view -> (dimensions it needs, expression).
# The fixture mapping of the sales contract.
_EXPR: dict[str, tuple[frozenset, Callable[[], Column]]] = {
    "order_id": (frozenset(), lambda: F.col("l_orderkey").cast("string").alias("order_id")),
    "order_date": (frozenset({"orders"}), lambda: F.col("o_orderdate").cast("date").alias("order_date")),
    "ship_date": (frozenset(), lambda: F.col("l_shipdate").cast("date").alias("ship_date")),
    "ship_mode": (frozenset({"orders"}), lambda: F.col("o_orderpriority").alias("ship_mode")),
    "customer_id": (frozenset({"orders", "customer"}), lambda: F.col("c_custkey").cast("string").alias("customer_id")),
    "customer_name": (frozenset({"orders", "customer"}), lambda: F.col("c_name").alias("customer_name")),
    "segment": (frozenset({"orders", "customer"}), lambda: F.col("c_mktsegment").alias("segment")),
    "country": (frozenset(), lambda: F.lit("N/A").alias("country")),
    "city": (frozenset({"orders", "customer"}), lambda: F.concat(F.lit("City_"), (F.col("c_custkey") % 40).cast("string")).alias("city")),
    "state": (frozenset({"orders", "customer", "nation"}), lambda: F.col("n_name").alias("state")),
    "postal_code": (frozenset({"orders", "customer"}), lambda: F.when(F.col("c_custkey") % 50 == 0, F.lit(None))
                    .otherwise(F.lit(10000) + F.col("c_custkey") % 900)
                    .cast("int").alias("postal_code")),
    "region": (frozenset({"orders", "customer", "nation", "region"}), lambda: F.col("r_name").alias("region")),
    "product_id": (frozenset(), lambda: F.col("l_partkey").cast("string").alias("product_id")),
    "category": (frozenset({"part"}), lambda: F.col("p_type").alias("category")),
    "sub_category": (frozenset({"part"}), lambda: F.col("p_brand").alias("sub_category")),
    "product_name": (frozenset({"part"}), lambda: F.col("p_name").alias("product_name")),
    "sales": (frozenset(), lambda: F.col("l_extendedprice").alias("sales")),
}


def sales_view(tables: Tables, columns: list[str] | None = None,
               full_join: bool = False) -> DataFrame:
    """The flat sales table, restricted to ``columns`` (default: all 17)."""
    columns = list(columns or ODS_COLUMNS)
    unknown = [c for c in columns if c not in _EXPR]
    if unknown:
        raise ValueError(f"not sales columns: {unknown}")
    need = set().union(*(_EXPR[c][0] for c in columns))
    if full_join:
        need = {"orders", "customer", "nation", "region", "part"}

    df = tables.lineitem
    if "orders" in need:
        df = df.join(_order_dimension(tables, need), F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in need:
        df = df.join(tables.part, F.col("l_partkey") == F.col("p_partkey"))
    return df.select(*[_EXPR[c][1]() for c in columns])


def landed_sales(tables: Tables, columns: list[str] | None = None) -> DataFrame:
    """``sales_view`` written once as parquet and read back, for jobs that go over the lines several
    times: they read the joined lines, not the join again."""
    view = sales_view(tables, columns)
    path = scratch_path(tables.spark, "flat")
    view.write.parquet(path)
    return tables.spark.read.schema(view.schema).parquet(path)


def with_dimensions(lines: DataFrame, tables: Tables, keep: tuple[str, ...] = ()) -> DataFrame:
    """The flat sales columns of lines that already carry their order's columns (batch or stream),
    and those to ``keep``. Lines without an order keep their row."""
    customers = (tables.customer.join(tables.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .join(tables.region, F.col("n_regionkey") == F.col("r_regionkey")))
    df = lines.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        tables.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return df.select(*[_EXPR[c][1]() for c in ODS_COLUMNS], *keep)


def _order_dimension(tables: Tables, need: set) -> DataFrame:
    """orders with the customer / nation / region attributes ``need`` asks for.

    Customer attributes are attached at order grain (one row per order),
    before the lines join: the customer join then shuffles orders, not the
    four-times-larger lines, and the lines are shuffled once, by order key.
    """
    od = tables.orders
    if "customer" not in need:
        return od  # a plain scan: Spark sizes it from the files
    od = od.join(tables.customer, F.col("o_custkey") == F.col("c_custkey"))
    if "nation" in need:
        od = od.join(tables.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if "region" in need:
        od = od.join(tables.region, F.col("n_regionkey") == F.col("r_regionkey"))
    # No hint and no count: file statistics and AQE choose the join from sizes
    # they have, and no job runs while the plan is built.
    return od


# SQL text of the same view, for the DuckDB oracle (tables registered as views).
SALES_SQL = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(l.l_shipdate AS DATE) AS ship_date,
       o.o_orderpriority AS ship_mode,
       CAST(c.c_custkey AS VARCHAR) AS customer_id,
       c.c_name AS customer_name,
       c.c_mktsegment AS segment,
       'N/A' AS country,
       'City_' || CAST(c.c_custkey % 40 AS VARCHAR) AS city,
       n.n_name AS state,
       CAST(CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE 10000 + c.c_custkey % 900 END AS INTEGER) AS postal_code,
       r.r_name AS region,
       CAST(p.p_partkey AS VARCHAR) AS product_id,
       p.p_type AS category,
       p.p_brand AS sub_category,
       p.p_name AS product_name,
       l.l_extendedprice AS sales
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
"""


# Attribute groups of the sales view by the table that holds them.
_LINE_KEYS = {"order_id", "ship_date", "product_id", "country"}
_ORDER_KEYS = {"order_date", "ship_mode"}
_CUSTOMER_KEYS = {"customer_id", "customer_name", "segment", "city", "state", "postal_code", "region"}
_PART_KEYS = {"category", "sub_category", "product_name"}


def star_sum(tables: Tables, keys: list[str], counts: bool = False, squares: bool = False) -> DataFrame:
    """``keys`` + ``sales`` (exact decimal partial sums) with the aggregation
    pushed below the dimension joins - eager aggregation by foreign key.
    With ``counts`` an ``n`` column carries the partial count of non-null
    sales, so means can be finished exactly (sum of sums / sum of counts).
    With ``squares`` the columns ``lines`` (row count) and ``sales_sq`` (exact
    sum of squares) follow, from which variances and correlations are finished.

    * part attributes only: lines -> sum per part key -> join part;
    * order / customer attributes only: lines -> sum per order -> join
      orders, and when no order attribute is needed -> sum per customer ->
      join customer (-> nation -> region);
    * order-side and part-side keys together: lines joined to the order
      side, summed per (order-side keys, part key), then joined to part;
    * keys of the line itself (order id, ship date, product id): line grain.

    Every partial aggregate runs map-side first, so a key holding a third of
    all lines (a hot customer, a best-selling part) collapses to one row per
    task before any shuffle, and the large joins see order-, customer- or
    part-grain rows instead of lines. The result is summed again by
    ``marts.group_sum``, so NULL keys and all-NULL groups behave exactly as
    on the flat view.
    """
    k = set(keys)
    unknown = k - (_LINE_KEYS | _ORDER_KEYS | _CUSTOMER_KEYS | _PART_KEYS)
    if unknown:
        raise ValueError(f"not sales columns: {sorted(unknown)}")
    price = F.col("l_extendedprice").cast("decimal(18,4)")
    measures = {"sales": F.sum(price)} | ({"n": F.count(price)} if counts else {})
    if squares:
        measures |= {"lines": F.count(F.lit(1)), "sales_sq": F.sum(price * price)}
    partial = [m.alias(c) for c, m in measures.items()]
    regroup = [F.sum(c).alias(c) for c in measures]
    out = list(measures)
    li = tables.lineitem
    if k <= _PART_KEYS | {"product_id"}:
        by_part = li.groupBy("l_partkey").agg(*partial)
        if k - {"product_id"}:
            by_part = by_part.join(tables.part, F.col("l_partkey") == F.col("p_partkey"))
        return by_part.select(*[_EXPR[c][1]() for c in keys], *out)
    if k <= _ORDER_KEYS | _CUSTOMER_KEYS:
        by_order = li.groupBy("l_orderkey").agg(*partial)
        df = by_order.join(tables.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if not k & _ORDER_KEYS:
            df = df.groupBy("o_custkey").agg(*regroup)
        if k & _CUSTOMER_KEYS:
            df = df.join(tables.customer, F.col("o_custkey") == F.col("c_custkey"))
        if k & {"state", "region"}:
            df = df.join(tables.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        if "region" in k:
            df = df.join(tables.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return df.select(*[_EXPR[c][1]() for c in keys], *out)
    if not k & _LINE_KEYS:
        # Order-side and part-side keys: resolve the order-side keys on the
        # lines, sum per (order-side keys, part key) - map-side first - and
        # join part at that grain instead of line grain.
        order_keys = [c for c in keys if c not in _PART_KEYS]
        need = set().union(*(_EXPR[c][0] for c in order_keys))
        lines = li.join(_order_dimension(tables, need), F.col("l_orderkey") == F.col("o_orderkey"))
        lines = lines.select(*[_EXPR[c][1]() for c in order_keys], "l_partkey", "l_extendedprice")
        by_part = lines.groupBy(*order_keys, "l_partkey").agg(*partial)
        by_part = by_part.join(tables.part, F.col("l_partkey") == F.col("p_partkey"))
        return by_part.select(*[F.col(c) if c in order_keys else _EXPR[c][1]() for c in keys], *out)
    sales = F.col("sales").cast("decimal(18,4)")
    at_line = {"sales": sales, "n": sales.isNotNull().cast("bigint"), "lines": F.lit(1).cast("bigint"), "sales_sq": sales * sales}
    return sales_view(tables, list(keys) + ["sales"]).select(*keys, *[at_line[c].alias(c) for c in out])
