"""Table contracts: the sales fact table (ODS) and its raw text variant."""

from __future__ import annotations

from pyspark.sql import types as T

# The 17 ODS columns in contract order (snake_case of the reference headers).
ODS_COLUMNS = [
    "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
    "customer_name", "segment", "country", "city", "state", "postal_code",
    "region", "product_id", "category", "sub_category", "product_name", "sales",
]

# Reference header text for each ODS column, used when reading files that
# carry the original headers (CSV exports, API JSON records).
HEADER_NAMES = {
    "row_id": "Row ID",
    "order_id": "Order ID",
    "order_date": "Order Date",
    "ship_date": "Ship Date",
    "ship_mode": "Ship Mode",
    "customer_id": "Customer ID",
    "customer_name": "Customer Name",
    "segment": "Segment",
    "country": "Country",
    "city": "City",
    "state": "State",
    "postal_code": "Postal Code",
    "region": "Region",
    "product_id": "Product ID",
    "category": "Category",
    "sub_category": "Sub-Category",
    "product_name": "Product Name",
    "sales": "Sales",
}

ODS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("ship_date", T.DateType()),
    T.StructField("ship_mode", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.IntegerType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales", T.DoubleType()),
])

# Raw (STG) layout: a leading row id and both dates as dd.MM.yyyy text.
RAW_SCHEMA = T.StructType(
    [T.StructField("row_id", T.IntegerType())]
    + [T.StructField(f.name, T.StringType() if f.name in ("order_date", "ship_date")
                     else f.dataType) for f in ODS_SCHEMA.fields]
)

# Schema of one record of the daily API feed (JSON), keyed by the headers.
# Any field may arrive as text or as a number, so all are read as text and typed later.
API_RECORD_SCHEMA = T.StructType([T.StructField(HEADER_NAMES[f.name], T.StringType()) for f in ODS_SCHEMA.fields])


def with_headers(schema: T.StructType) -> T.StructType:
    """Rename snake_case fields to the reference's header text."""
    return T.StructType([T.StructField(HEADER_NAMES.get(f.name, f.name), f.dataType, f.nullable)
                         for f in schema.fields])


def to_snake(df):
    """Rename header-text columns (``Order ID``) to snake_case (``order_id``)."""
    back = {v: k for k, v in HEADER_NAMES.items()}
    return df.toDF(*[back.get(c, c) for c in df.columns])
