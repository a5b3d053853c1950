"""Registered source/sink round trips and streaming queries.

Each query writes what Spark derives from the given tables into a fresh
folder under the session's shared checkpoint folder, then returns a lazy
read of what was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators import cleanse
from salesmart.plans.cleansing import INCREMENT_DAY, REDELIVERY_FROM, REDELIVERY_TO, not_yet_delivered
from salesmart.plans.deliveries import corrected
from salesmart.plans.registry import ORACLES, query, with_sales
from salesmart.schema import HEADER_NAMES, ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources import files, inference, landing, layout
from salesmart.sources.star import landed_sales, sales_view
from salesmart.sources.tables import Tables
from salesmart.streaming import deliveries, ingest

_ODS_LIST = ", ".join(ODS_COLUMNS)
STREAM_DAY = "2024-01-05"


@query("csv_roundtrip", with_sales(f"SELECT {_ODS_LIST} FROM sales"))
def csv_roundtrip(t: Tables) -> DataFrame:
    """K3 + S1: sales exported as ';'-separated text with dd.MM.yyyy dates, read back
    with the explicit raw schema and typed again (no fill, so it equals the source)."""
    path = scratch_path(t.spark, "csv")
    files.write_raw_csv(cleanse.to_raw_text(sales_view(t)), path)
    raw = files.read_raw_csv(t.spark, path, with_row_id=False)
    return cleanse.stg_to_ods(raw, postal_fill=None)


@query("json_roundtrip", with_sales(f"SELECT {_ODS_LIST} FROM sales"))
def json_roundtrip(t: Tables) -> DataFrame:
    """S3: sales as header-keyed JSON records, read with the API record schema."""
    path = scratch_path(t.spark, "json")
    files.write_api_json(sales_view(t), path)
    return cleanse.records_to_ods(files.read_api_json(t.spark, path, multi_line=False))


@query("ods_clustered_load", with_sales(f"SELECT {_ODS_LIST} FROM sales"))
def ods_clustered_load(t: Tables) -> DataFrame:
    """The sales clustered on day, customer and product, read back."""
    path = scratch_path(t.spark, "clustered")
    layout.write_clustered(landed_sales(t), path, ["order_date", "customer_name", "product_name"])
    return t.spark.read.parquet(path)


# The types that the fixture's columns have as text.
_TEXT_TYPES = {"order_id": "bigint", "order_date": "date_text", "ship_date": "date_text", "customer_id": "bigint", "postal_code": "bigint",
               "product_id": "bigint", "sales": "decimal"}


@query("csv_types", with_sales(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{HEADER_NAMES[c]}' AS column_name, '{_TEXT_TYPES.get(c, 'string')}' AS type, "
    f"COUNT({c}) AS \"values\", CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulls FROM sales" for i, c in enumerate(ODS_COLUMNS))))
def csv_types(t: Tables) -> DataFrame:
    """Types of the sales as CSV text, found in one scan of the files."""
    path = scratch_path(t.spark, "csv-types")
    files.write_raw_csv(cleanse.to_raw_text(sales_view(t)), path)
    return inference.column_types(t.spark, path).select("position", "column_name", "type", "values", "nulls")


@query("landed_day")
def landed_day(t: Tables) -> DataFrame:
    """S3 + P8 by the landing ledger: the feed's older files are entered when they land; the day's load
    opens the files that landed since."""
    folder, ledger = scratch_path(t.spark, "landed"), scratch_path(t.spark, "landed-ledger")
    s = landed_sales(t)
    old = F.col("order_date") < F.lit(INCREMENT_DAY).cast("date")
    files.write_api_json(s.where(old), folder)
    landing.record_new(t.spark, folder, ledger, REDELIVERY_FROM, multi_line=False)
    files.write_api_json(s.where(~old), folder, mode="append")
    records = landing.read_day(t.spark, folder, ledger, INCREMENT_DAY, multi_line=False)
    return cleanse.daily_increment(records.where(~cleanse.is_bad(files.CORRUPT)), INCREMENT_DAY)


ORACLES["landed_day"] = ORACLES["daily_increment"]


@query("ods_partitioned_load")
def ods_partitioned_load(t: Tables) -> DataFrame:
    """K2 + U1 on files: archive loaded into day partitions, then a re-delivered
    week written with dynamic partition overwrite replaces exactly its days."""
    path = scratch_path(t.spark, "ods")
    s = sales_view(t)
    files.write_ods(s.where(~not_yet_delivered()), path)
    week = s.where(F.col("order_date").between(F.lit(REDELIVERY_FROM).cast("date"),
                                               F.lit(REDELIVERY_TO).cast("date")))
    files.write_ods(week, path, days_only=True)
    return files.read_ods(t.spark, path).select(*ODS_COLUMNS)


ORACLES["ods_partitioned_load"] = ORACLES["ods_replace_days"]


def _events_stream(t: Tables) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of part files."""
    return ingest.table_stream(t.spark, t.path("events"), t.events.schema)


@query("stream_ingest", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{STREAM_DAY}' AND ts < TIMESTAMP '{STREAM_DAY}' + INTERVAL 1 DAY""")
def stream_ingest(t: Tables) -> DataFrame:
    """One day's events ingested by an availableNow file stream into parquet."""
    out, ckpt = scratch_path(t.spark, "stream-ingest"), scratch_path(t.spark, "stream-ingest-ckpt")
    day = ingest.ingest_day(_events_stream(t), STREAM_DAY)
    ingest.run_to_parquet(day, out, ckpt)
    return t.spark.read.schema(day.schema).parquet(out)


@query("stream_sales_ods", with_sales(f"SELECT {_ODS_LIST} FROM sales WHERE order_date = DATE '{INCREMENT_DAY}'"))
def stream_sales_ods(t: Tables) -> DataFrame:
    """X1 + P8/P9: the sales feed (JSON files of all lines) through a stream into day folders of typed ODS rows."""
    feed = scratch_path(t.spark, "sales-feed")
    files.write_api_json(sales_view(t), feed)
    out, ckpt = scratch_path(t.spark, "stream-sales"), scratch_path(t.spark, "stream-sales-ckpt")
    day = ingest.sales_day(ingest.sales_records(t.spark, feed), INCREMENT_DAY)
    ingest.run_to_parquet(day, out, ckpt, partition_by=["order_date"])
    return t.spark.read.schema(day.schema).parquet(out).select(*ODS_COLUMNS)


@query("stream_last_delivery")
def stream_last_delivery(t: Tables) -> DataFrame:
    """X1 + U1 as a stream: a week delivered five times, out of order and with a restart in between,
    replaces its days of the archive as its last delivery has them."""
    s = sales_view(t)
    week = s.where(F.col("order_date").between(F.lit(REDELIVERY_FROM).cast("date"), F.lit(REDELIVERY_TO).cast("date")))
    feed, lines, ledger, ckpt = (scratch_path(t.spark, f"last-delivery-{x}") for x in ("feed", "lines", "ledger", "ckpt"))
    landed = scratch_path(t.spark, "delivery")
    week.write.parquet(landed)
    week = t.spark.read.schema(week.schema).parquet(landed)
    # The faulty weeks are 1 and 2; 2 lands behind 3, and 4 brings some days of it again.
    some = week.where(F.col("order_date") > F.lit(INCREMENT_DAY).cast("date"))
    for wave in (((1, corrected(week)), (3, week)), ((2, corrected(week)), (4, some), (5, some))):
        for number, sent in wave:
            deliveries.write_delivery(sent, feed, number, f"1998-03-1{number} 06:00:00")
        typed = deliveries.delivery_lines(deliveries.delivery_feed(t.spark, feed))
        ingest.run_to_parquet(typed.drop(deliveries.DELIVERED), lines, f"{ckpt}/lines", partition_by=["order_date", deliveries.DELIVERY])
        deliveries.run_ledger(deliveries.latest_deliveries(typed), ledger, f"{ckpt}/ledger")
    archive = s.where(~not_yet_delivered())
    return cleanse.replace_days(archive, deliveries.current_lines(t.spark, lines, ledger))


ORACLES["stream_last_delivery"] = ORACLES["ods_replace_days"]


@query("stream_dedupe", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    """Every event delivered twice; the watermark-bounded dedupe keeps one."""
    twice = _events_stream(t).unionByName(_events_stream(t))
    deduped = ingest.dedupe(ingest.with_event_time(twice), ["event_id"])
    out, ckpt = scratch_path(t.spark, "stream-dedupe"), scratch_path(t.spark, "stream-dedupe-ckpt")
    ingest.run_to_parquet(deduped, out, ckpt)
    # Back to the table's own type (lossless under the UTC session zone).
    return t.spark.read.schema(deduped.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_daily", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1""")
def stream_daily(t: Tables) -> DataFrame:
    """Tumbling daily windows over the event stream (complete mode)."""
    totals = ingest.daily_totals(ingest.with_event_time(_events_stream(t)))
    out, ckpt = scratch_path(t.spark, "stream-daily"), scratch_path(t.spark, "stream-daily-ckpt")
    ingest.run_to_parquet(totals, out, ckpt, output_mode="complete")
    return t.spark.read.schema(totals.schema).parquet(out)
