"""The layer jobs end to end: CSV -> STG -> ODS -> marts / forecast, then a daily load."""

import json
import os

from pyspark.sql import functions as F

from salesmart import jobs
from salesmart.operators import cleanse, marts
from salesmart.schema import HEADER_NAMES, ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources import files
from salesmart.sources.star import sales_view
from salesmart.sources.tables import Tables


def test_layer_jobs(spark, data_dir):
    sales = sales_view(Tables(spark, data_dir))
    csv_dir = scratch_path(spark, "t-csv")
    raw = cleanse.to_raw_text(sales).withColumn("row_id", F.monotonically_increasing_id().cast("int"))
    files.write_raw_csv(raw.select("row_id", *ODS_COLUMNS), csv_dir)

    stg = jobs.run_stg(spark, csv_dir, scratch_path(spark, "t-stg"))
    assert stg.count() == sales.count()
    ods_path = scratch_path(spark, "t-ods")
    ods = jobs.run_ods(spark, stg.inputFiles()[0].rsplit("/", 1)[0], ods_path)
    assert ods.where(F.col("postal_code").isNull()).count() == 0

    out_root = scratch_path(spark, "t-marts")
    written = jobs.run_datamart(spark, ods_path, out_root)
    assert "top_customers" in written and "corr_segment" in written
    for name in marts.MARTS:  # from the sums of all key sets, as from the lines themselves
        got = spark.read.parquet(f"{out_root}/{name}").collect()
        assert sorted(got) == sorted(marts.mart(sales, name).collect()), name
    from salesmart.operators import correlate
    for dim in jobs.CORR_DIMENSIONS:
        got = spark.read.parquet(f"{out_root}/corr_{dim}").orderBy("pos_x", "pos_y").collect()
        assert got == correlate.one_hot_corr(sales, dim).orderBy("pos_x", "pos_y").collect(), dim

    csv_out = scratch_path(spark, "t-fc-csv")
    fc = jobs.run_forecast(spark, ods_path, scratch_path(spark, "t-fc"), csv_path=csv_out)
    assert fc.count() == 7
    exported = spark.read.option("header", True).csv(csv_out)
    assert exported.columns == ["series_id", "prediction_date", "predicted_sales"]
    assert exported.count() == 7

    # Daily load: a landed API response for one day replaces that day only.
    day = sales.agg(F.max("order_date")).first()[0]
    before = ods.where(F.col("order_date") != F.lit(day)).count()
    landing = scratch_path(spark, "t-landing")
    os.makedirs(landing)
    rec = {"Order ID": "1", "Order Date": day.isoformat(), "Ship Date": day.isoformat(),
           "Ship Mode": "1-URGENT", "Customer ID": "3", "Customer Name": "O'Hara",
           "Segment": "BUILDING", "Country": "N/A", "City": "City_3", "State": "NATION_1",
           "Postal Code": 10003, "Region": "REGION_1", "Product ID": "5", "Category": "ECONOMY",
           "Sub-Category": "Brand#1", "Product Name": "red widget", "Sales": 12.5}
    text = dict(rec, **{"Order ID": "CA-2017-152156", "Customer ID": "CG-12520", "Product ID": "FUR-BO-10001798",
                        "Postal Code": "42420", "Sales": "1.5"})  # text ids, numbers as text
    bad = dict(rec, Sales="a lot")
    with open(os.path.join(landing, "resp.json"), "w") as fh:
        json.dump([rec, text, bad], fh)
    n = jobs.run_daily(spark, landing, ods_path, day.isoformat())
    assert n == 2
    assert jobs.run_daily(spark, landing, ods_path, day.isoformat()) == 2  # idempotent
    after = files.read_ods(spark, ods_path)
    assert after.where(F.col("order_date") != F.lit(day)).count() == before
    got = after.where("order_id = 'CA-2017-152156'").collect()
    assert [(r.customer_id, r.product_id, r.postal_code, r.sales) for r in got] == [("CG-12520", "FUR-BO-10001798", 42420, 1.5)]
    refused = spark.read.parquet(jobs.rejects_path(ods_path) + "_api")
    assert refused.count() == 1 and "a lot" in refused.first()["record"]


def test_text_ids_survive_and_bad_lines_are_counted(spark):
    csv_dir = scratch_path(spark, "t-ids")
    os.makedirs(csv_dir)
    head = ";".join(["Row ID", *(HEADER_NAMES[c] for c in ODS_COLUMNS)])
    line = "{};{};08.11.2020;{};Second Class;CG-12520;Ann;Consumer;US;Henderson;Kentucky;42420;South;FUR-1;Furniture;Shelves;Shelf;2.5"
    with open(os.path.join(csv_dir, "a.csv"), "w") as fh:
        fh.write("\n".join([head, line.format(1, "CA-1", "11.11.2020"), line.format(2, "7", "11.11.2020"),
                            line.format(3, "CA-3", "2020-11-11"), "4;short"]) + "\n")
    stg, ods = scratch_path(spark, "t-ids-stg"), scratch_path(spark, "t-ids-ods")
    jobs.run_stg(spark, csv_dir, stg)
    rows = jobs.run_ods(spark, stg, ods).orderBy("order_id").collect()
    assert [(r.order_id, r.customer_id, r.product_id) for r in rows] == [("7", "CG-12520", "FUR-1"), ("CA-1", "CG-12520", "FUR-1")]
    assert sorted(r.row_id for r in jobs.rejects(spark, ods).collect()) == [3, 4]


def test_full_load_drops_stale_days_and_daily_load_keeps_them(spark):
    path = scratch_path(spark, "t-modes")
    row = "SELECT '1' AS order_id, DATE '{}' AS order_date, 1.0D AS sales"
    two = spark.sql(row.format("2020-01-01") + " UNION ALL " + row.format("2020-01-02"))
    files.write_ods(two, path)
    files.write_ods(spark.sql(row.format("2020-01-02") + " UNION ALL SELECT '2', CAST(NULL AS DATE), 1.0D"), path, days_only=True)
    assert files.read_ods(spark, path).count() == 2
    files.write_ods(spark.sql(row.format("2020-01-02")), path)
    assert [r.order_date.isoformat() for r in files.read_ods(spark, path).collect()] == ["2020-01-02"]
