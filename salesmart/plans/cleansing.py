"""Registered cleansing and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import money_sum, round4
from salesmart.operators import cleanse, quality, sketches
from salesmart.plans.registry import query, with_sales
from salesmart.schema import ODS_COLUMNS, ODS_SCHEMA
from salesmart.session import scratch_path
from salesmart.sources.star import sales_view
from salesmart.sources.tables import Tables

_ODS_LIST = ", ".join(ODS_COLUMNS)

# Fixed parameters of the fixture queries (dates inside the fixture span).
INCREMENT_DAY = "1998-03-02"
REDELIVERY_FROM, REDELIVERY_TO = "1998-02-25", "1998-03-09"
ARCHIVE_CUTOFF = "2001-02-01"
SHIFT_YEARS = 5


@query("ods_clean", with_sales(
    "SELECT " + ", ".join("COALESCE(postal_code, 5401) AS postal_code" if c == "postal_code" else c
                          for c in ODS_COLUMNS) + " FROM sales"))
def ods_clean(t: Tables) -> DataFrame:
    """Dd.MM.yyyy text dates -> typed ODS with the constant postal fill."""
    raw = cleanse.to_raw_text(sales_view(t))
    return cleanse.stg_to_ods(raw)


@query("postal_fill_by_city", with_sales("""
SELECT s.order_id, s.product_id, s.state, s.city, COALESCE(s.postal_code, k.known) AS postal_code
FROM sales s LEFT JOIN (
  SELECT state, city, MIN(postal_code) AS known FROM sales
  WHERE postal_code IS NOT NULL GROUP BY state, city) k
ON s.state = k.state AND s.city = k.city"""))
def postal_fill_by_city(t: Tables) -> DataFrame:
    """P5: missing postal code filled from the same (state, city)."""
    df = sales_view(t, ["order_id", "product_id", "state", "city", "postal_code"])
    return cleanse.fill_postal_by_city(df)


@query("daily_increment", with_sales(
    f"SELECT {_ODS_LIST} FROM sales WHERE order_date = DATE '{INCREMENT_DAY}'"))
def daily_increment(t: Tables) -> DataFrame:
    """P8+P9: JSON records of the feed -> one day's typed ODS rows."""
    return cleanse.increment_from_text(cleanse.to_api_records(sales_view(t)), INCREMENT_DAY)


def not_yet_delivered():
    """Days that only the delivery has."""
    day = F.col("order_date")
    return (day > F.lit(INCREMENT_DAY).cast("date")) & (day <= F.lit(REDELIVERY_TO).cast("date"))


@query("ods_replace_days", with_sales(f"""
SELECT {_ODS_LIST} FROM sales a
WHERE NOT (a.order_date > DATE '{INCREMENT_DAY}' AND a.order_date <= DATE '{REDELIVERY_TO}')
  AND NOT EXISTS (SELECT 1 FROM sales i WHERE i.order_date = a.order_date
                  AND i.order_date BETWEEN DATE '{REDELIVERY_FROM}' AND DATE '{REDELIVERY_TO}')
UNION ALL
SELECT {_ODS_LIST} FROM sales WHERE order_date BETWEEN DATE '{REDELIVERY_FROM}' AND DATE '{REDELIVERY_TO}'"""))
def ods_replace_days(t: Tables) -> DataFrame:
    """The whole archive but a week not delivered yet; the delivery brings that week and
    replaces the days before it."""
    s = sales_view(t)
    archive = s.where(~not_yet_delivered())
    increment = s.where(F.col("order_date").between(F.lit(REDELIVERY_FROM).cast("date"),
                                                    F.lit(REDELIVERY_TO).cast("date")))
    # The delivery lands as a table, as it would in a load: its days come from it, not from the lines again,
    # and its size is known, so the archive isn't shuffled by day to meet a few days.
    landed = scratch_path(t.spark, "delivery")
    increment.write.parquet(landed)
    return cleanse.replace_days(archive, t.spark.read.schema(increment.schema).parquet(landed))


@query("date_shift", with_sales(f"""
SELECT order_id, order_date,
       CAST(order_date + INTERVAL {12 * SHIFT_YEARS} MONTH AS DATE) AS shifted_order_date,
       CAST(ship_date + INTERVAL {12 * SHIFT_YEARS} MONTH AS DATE) AS shifted_ship_date
FROM sales"""))
def date_shift(t: Tables) -> DataFrame:
    """P20: dates moved by whole years."""
    s = sales_view(t, ["order_id", "order_date", "ship_date"])
    shifted = cleanse.shift_dates(
        s.withColumn("shifted_order_date", F.col("order_date"))
         .withColumn("shifted_ship_date", F.col("ship_date")),
        SHIFT_YEARS, cols=("shifted_order_date", "shifted_ship_date"))
    return shifted.select("order_id", "order_date", "shifted_order_date", "shifted_ship_date")


@query("archive_split", with_sales(f"""
SELECT CASE WHEN order_date < DATE '{ARCHIVE_CUTOFF}' THEN 'archive' ELSE 'future' END AS part,
       COUNT(*) AS lines, CAST(SUM(CAST(sales AS DECIMAL(18,4))) AS DOUBLE) AS sales
FROM sales WHERE order_date IS NOT NULL GROUP BY 1"""))
def archive_split(t: Tables) -> DataFrame:
    """Archive / future split at a cut-off date, with line counts and totals."""
    s = cleanse.label_split(sales_view(t, ["order_date", "sales"]), ARCHIVE_CUTOFF)
    return (s.where(F.col("part").isNotNull())
             .groupBy("part").agg(F.count(F.lit(1)).alias("lines"), money_sum("sales").alias("sales")))


@query("null_profile", with_sales(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM sales"
    for c in ODS_COLUMNS)))
def null_profile(t: Tables) -> DataFrame:
    """NULL count per ODS column."""
    return quality.null_profile(sales_view(t))


_NUMERIC = ["postal_code", "sales"]


def _numeric_sql(c: str) -> str:
    stats = [("count", f"CAST(COUNT({c}) AS DOUBLE)"),
             ("mean", f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / COUNT({c})"),
             ("std", f"stddev_samp(CAST({c} AS DOUBLE))"),
             ("min", f"CAST(MIN({c}) AS DOUBLE)"),
             ("max", f"CAST(MAX({c}) AS DOUBLE)"),
             ("25%", f"quantile_cont({c}, 0.25)"),
             ("50%", f"quantile_cont({c}, 0.5)"),
             ("75%", f"quantile_cont({c}, 0.75)")]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{name}' AS stat, "
        f"round_even(CAST({expr} AS DOUBLE) * 10000, 0) / 10000 AS value FROM sales"
        for name, expr in stats)


@query("numeric_profile", with_sales(" UNION ALL ".join(_numeric_sql(c) for c in _NUMERIC)))
def numeric_profile(t: Tables) -> DataFrame:
    """describe() of the numeric ODS columns, exact quantiles."""
    out = quality.numeric_profile(sales_view(t, _NUMERIC), _NUMERIC)
    return out.withColumn("value", round4("value"))


_DATES = ["order_date", "ship_date"]


def _date_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, CAST(SUM(cnt) AS BIGINT) AS count,
       CAST(COUNT(*) AS BIGINT) AS "unique",
       (SELECT {c} FROM sales WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS top,
       MAX(cnt) AS freq, MIN(v) AS first, MAX(v) AS last
FROM (SELECT {c} AS v, COUNT(*) AS cnt FROM sales WHERE {c} IS NOT NULL GROUP BY {c}) f"""


@query("date_profile", with_sales(" UNION ALL ".join(_date_sql(c) for c in _DATES)))
def date_profile(t: Tables) -> DataFrame:
    """Date describe(): count, unique, top, freq, first, last."""
    return quality.date_profile(sales_view(t, _DATES), _DATES)


@query("frame_info", with_sales(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS column_name, "
    f"'{f.dataType.simpleString()}' AS dtype, COUNT({f.name}) AS non_null FROM sales"
    for i, f in enumerate(ODS_SCHEMA.fields))))
def frame_info(t: Tables) -> DataFrame:
    """info(): position, name, type and non-null count of each ODS column."""
    return quality.frame_info(sales_view(t))


@query("postal_gaps", with_sales(
    "SELECT order_id, customer_id, city, state, postal_code FROM sales WHERE postal_code IS NULL"))
def postal_gaps(t: Tables) -> DataFrame:
    """Lines whose postal code is missing."""
    cols = ["order_id", "customer_id", "city", "state", "postal_code"]
    return quality.rows_missing(sales_view(t, cols), "postal_code")


@query("postal_filled_rows", with_sales(
    "SELECT order_id, customer_id, city, state, COALESCE(postal_code, 5401) AS postal_code "
    "FROM sales WHERE COALESCE(postal_code, 5401) = 5401"))
def postal_filled_rows(t: Tables) -> DataFrame:
    """P7 after P4: lines carrying the fill value."""
    cols = ["order_id", "customer_id", "city", "state", "postal_code"]
    filled = cleanse.fill_postal_code(sales_view(t, cols))
    return quality.rows_with(filled, "postal_code", cleanse.DEFAULT_POSTAL_CODE)


_SKETCHED, _COUNTED = ["sales", "ship_date"], ["city", "product_name"]


def _sketch_sql() -> str:
    number = {"sales": "sales", "ship_date": "date_diff('day', DATE '1970-01-01', ship_date)"}
    parts = [f"SELECT '{c}' AS column_name, COUNT({c}) AS n, CAST(MIN({v}) AS DOUBLE) AS low, CAST(MAX({v}) AS DOUBLE) AS high, TRUE AS within FROM sales"
             for c, v in number.items()]
    return with_sales(" UNION ALL ".join(parts + [
        f"SELECT '{c}', COUNT({c}), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), TRUE FROM sales" for c in _COUNTED]))


@query("sketch_profile", _sketch_sql())
def sketch_profile(t: Tables) -> DataFrame:
    """A14/A15 from day sketches, stored and merged: exact counts and ends, and whether every estimate is
    within its stated error of the exact answer over all lines."""
    s = sales_view(t, ["order_date", *_SKETCHED, *_COUNTED])
    path = scratch_path(t.spark, "day-sketches")
    sketches.day_sketches(s, _SKETCHED, _COUNTED).write.parquet(path)
    days = t.spark.read.parquet(path)
    found = sketches.number_profile(days, _SKETCHED)
    # The ranks that the estimates really have; twice the bound, since it holds with 99 % confidence.
    value = {"sales": F.col("sales"), "ship_date": F.unix_date("ship_date")}
    cells = s.select(F.explode(F.array(*[F.struct(F.lit(c).alias("of"), v.cast("double").alias("v")) for c, v in value.items()])).alias("c"))
    ranks = cells.select("c.of", "c.v").where("v IS NOT NULL").join(found, F.col("of") == F.col("column_name")).groupBy("column_name").agg(
        F.max("n").alias("n"), F.max("low").alias("low"), F.max("high").alias("high"),
        *[F.avg((F.col("v") < F.col(f"q{i}")).cast("double")).alias(f"under{i}") for i in range(3)],
        *[F.avg((F.col("v") <= F.col(f"q{i}")).cast("double")).alias(f"upto{i}") for i in range(3)])
    slack = 2 * sketches.rank_error()
    near = F.lit(True)
    for i, p in enumerate(sketches.QUANTILES):
        near = near & (F.col(f"under{i}") <= p + slack) & (F.col(f"upto{i}") >= p - slack)
    numbers = ranks.select("column_name", "n", "low", "high", near.alias("within"))
    items = sketches.item_profile(days, _COUNTED, 3)
    counts = s.select(F.explode(F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).alias("item")) for c in _COUNTED])).alias("c")).select("c.*").where(
        "item IS NOT NULL").groupBy("of", "item").agg(F.count(F.lit(1)).alias("m"))
    truth = counts.groupBy("of").agg(F.count(F.lit(1)).alias("really"), F.max("m").alias("most"))
    first = F.col("frequent")[0]
    ok = (F.abs(F.col("different") - F.col("really")) <= 4 * sketches.distinct_error() * F.col("really")) & (
        F.abs(first["count"] - F.col("most")) <= sketches.count_error() * F.col("n") + 1)
    items = items.join(truth, F.col("column_name") == F.col("of")).select(
        "column_name", "n", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), ok.alias("within"))
    return numbers.unionByName(items)
