"""Cleansing, increments, day replacement, file sources."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from salesmart.operators import cleanse
from salesmart.schema import ODS_COLUMNS, ODS_SCHEMA
from salesmart.sources import files


def _ods_row(**kw):
    base = dict(order_id="1", order_date=dt.date(2020, 1, 1), ship_date=dt.date(2020, 1, 3),
                ship_mode="Standard Class", customer_id="7", customer_name="Ann", segment="Consumer",
                country="United States", city="Burlington", state="Vermont", postal_code=None,
                region="East", product_id="9", category="Technology", sub_category="Phones",
                product_name="Phone", sales=10.5)
    base.update(kw)
    return tuple(base[c] for c in ODS_COLUMNS)


def test_parse_dates_bad_text_is_null(spark):
    df = spark.createDataFrame([("31.12.2020", "01.01.2021"), ("2020-12-31", "1.1.2020"), (None, None)],
                               "order_date string, ship_date string")
    out = cleanse.parse_dates(df).collect()
    assert out[0].order_date == dt.date(2020, 12, 31) and out[0].ship_date == dt.date(2021, 1, 1)
    assert out[1].order_date is None and out[1].ship_date is None
    assert out[2].order_date is None


def test_constant_postal_fill_keeps_int(spark):
    df = spark.createDataFrame([_ods_row(), _ods_row(postal_code=5035)], ODS_SCHEMA)
    out = cleanse.fill_postal_code(df)
    assert dict(out.dtypes)["postal_code"] == "int"
    assert sorted(r.postal_code for r in out.collect()) == [5035, 5401]


def test_fill_postal_by_city(spark):
    df = spark.createDataFrame([_ods_row(postal_code=5408), _ods_row(postal_code=5401),
                                _ods_row(), _ods_row(city="Nowhere")], ODS_SCHEMA)
    out = cleanse.fill_postal_by_city(df).collect()
    assert sorted((r.city, r.postal_code) for r in out if r.city == "Burlington") == [
        ("Burlington", 5401), ("Burlington", 5401), ("Burlington", 5408)]
    assert [r.postal_code for r in out if r.city == "Nowhere"] == [None]


def test_daily_increment_handles_apostrophes_and_empty_days(spark):
    rows = [_ods_row(customer_name="O'Brien"), _ods_row(order_date=dt.date(2020, 1, 2))]
    text = cleanse.to_api_records(spark.createDataFrame(rows, ODS_SCHEMA))
    day = cleanse.increment_from_text(text, "2020-01-01").collect()
    assert [r.customer_name for r in day] == ["O'Brien"]
    assert cleanse.increment_from_text(text, "2021-05-05").count() == 0
    parsed = cleanse.daily_increment(cleanse.parse_record_text(text), dt.date(2020, 1, 2))
    assert parsed.count() == 1


def test_replace_days_is_idempotent(spark):
    archive = spark.createDataFrame([_ods_row(order_id=str(i), order_date=dt.date(2020, 1, 1 + i % 3))
                                     for i in range(9)], ODS_SCHEMA)
    # A day re-delivered with a corrected line, plus two identical legitimate lines.
    inc = spark.createDataFrame([_ods_row(order_id="100", order_date=dt.date(2020, 1, 2)),
                                 _ods_row(order_id="101", order_date=dt.date(2020, 1, 4)),
                                 _ods_row(order_id="101", order_date=dt.date(2020, 1, 4))], ODS_SCHEMA)
    once = cleanse.replace_days(archive, inc)
    twice = cleanse.replace_days(once, inc)
    ids = sorted(int(r.order_id) for r in once.collect())
    assert ids == sorted(int(r.order_id) for r in twice.collect())
    assert ids == [0, 2, 3, 5, 6, 8, 100, 101, 101]


def test_shift_years_clamps_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2016, 2, 29), dt.date(2016, 3, 1))], "order_date date, ship_date date")
    r = cleanse.shift_dates(df, 5).collect()[0]
    assert r.order_date == dt.date(2021, 2, 28) and r.ship_date == dt.date(2021, 3, 1)


def test_label_split(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 7, 1),), (None,)], "order_date date")
    parts = [r.part for r in cleanse.label_split(df, "2020-06-01").collect()]
    assert parts == ["archive", "future", None]


def test_raw_csv_decimal_comma_and_corrupt_line(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    header = ("Row ID;Order ID;Order Date;Ship Date;Ship Mode;Customer ID;Customer Name;Segment;"
              "Country;City;State;Postal Code;Region;Product ID;Category;Sub-Category;Product Name;Sales")
    lines = [header,
             "1;10;08.11.2020;11.11.2020;Second Class;5;Ann Example;Consumer;United States;"
             "Springfield;Ohio;42420;South;3;Furniture;Shelves;Oak Shelf;261,96",
             "2;11;08.11.2020;11.11.2020;Second Class;5;Ann Example;Consumer;United States;"
             "Burlington;Vermont;;East;4;Furniture;Chairs;Desk Chair;731,94",
             "3;12;oops"]
    with open(os.path.join(d, "part.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = files.read_raw_csv(spark, d, decimal_comma=True)
    rows = raw.orderBy("row_id").collect()
    assert rows[0].sales == 261.96 and rows[1].postal_code is None
    assert rows[2][files.CORRUPT] is not None
    ods = cleanse.stg_to_ods(raw.where(F.col(files.CORRUPT).isNull())).orderBy("order_id").collect()
    assert ods[0].order_date == dt.date(2020, 11, 8) and ods[1].postal_code == 5401


def test_api_json_array_file(spark):
    d = tempfile.mkdtemp(prefix="api-", dir="/tmp")
    rec = {"Order ID": "CA-1", "Order Date": "2023-06-01", "Ship Date": "2023-06-03",
           "Ship Mode": "First Class", "Customer ID": 77, "Customer Name": "D'Arcy", "Segment": "Consumer",
           "Country": "United States", "City": "Burlington", "State": "Vermont", "Postal Code": 5401,
           "Region": "East", "Product ID": 5, "Category": "Technology", "Sub-Category": "Phones",
           "Product Name": "Phone", "Sales": 99.99}
    other = dict(rec, **{"Order Date": "2023-06-02"})
    broken = dict(rec, **{"Order Date": "02/06/2023"})      # malformed date: NULL, not a failure
    with open(os.path.join(d, "resp.json"), "w") as fh:
        json.dump([rec, other, broken], fh)
    recs = files.read_api_json(spark, d)
    assert recs.count() == 3
    assert cleanse.records_to_ods(recs).where(F.col("order_date").isNull()).count() == 1
    day = cleanse.daily_increment(recs, "2023-06-01").collect()
    assert len(day) == 1 and day[0].customer_name == "D'Arcy" and day[0].customer_id == "77"
    assert day[0].order_id == "CA-1" and day[0].sales == 99.99 and day[0].postal_code == 5401
