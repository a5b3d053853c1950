"""The landing ledger: a day's load opens new files and those that hold its day, and rejects say where they were."""

import json
import os
import time

from pyspark.sql import functions as F

from salesmart import jobs
from salesmart.schema import HEADER_NAMES, ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.sources import files, landing


def _rec(day, sales=1.5, **more):
    return {HEADER_NAMES[c]: "x" for c in ODS_COLUMNS} | {"Order Date": day, "Ship Date": day, "Postal Code": 1, "Sales": sales} | more


def _land(folder, name, records, lines=False):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(json.dumps(r) if isinstance(r, dict) else r for r in records) if lines else json.dumps(records))


def _names(paths):
    return sorted(p.rsplit("/", 1)[-1].replace("%20", " ") for p in paths)


def test_a_day_opens_new_files_and_those_that_hold_it(spark):
    folder, ledger = scratch_path(spark, "t-land"), scratch_path(spark, "t-land-ledger")
    _land(folder, "a.json", [_rec("2020-01-01"), _rec("2020-01-03")])
    _land(folder, "b c+d.json", [_rec("2020-01-01")])
    _land(folder, "none.json", [])
    opened = lambda df: _names({r._file for r in df.select("_file").distinct().collect()})
    assert opened(landing.read_day(spark, folder, ledger, "2020-01-01")) == ["a.json", "b c+d.json"]
    _land(folder, "e.json", [_rec("2020-01-02")])
    second = landing.read_day(spark, folder, ledger, "2020-01-02")
    assert _names(second.inputFiles()) == ["e.json"] == opened(second)  # the plan's files: only the new one
    third = landing.read_day(spark, folder, ledger, "2020-01-03")
    assert _names(third.inputFiles()) == ["a.json"]  # nothing new; the file that is known to hold the day
    assert landing.record_new(spark, folder, ledger, "2020-01-03") == []
    assert landing.read_day(spark, folder, ledger, "2021-01-01").count() == 0
    days = {(_names([r.path])[0], str(r.order_date), r.records) for r in landing.ledger_of(spark, ledger).collect()}
    assert days == {("a.json", "2020-01-01", 1), ("a.json", "2020-01-03", 1), ("b c+d.json", "2020-01-01", 1), ("none.json", "None", 0),
                    ("e.json", "2020-01-02", 1)}
    time.sleep(0.05)
    _land(folder, "a.json", [_rec("2020-01-02"), _rec("2020-01-02")])  # written again: new, and its old days are gone
    assert _names(landing.read_day(spark, folder, ledger, "2020-01-02").inputFiles()) == ["a.json", "e.json"]
    assert landing.files_of_day(spark, folder, ledger, "2020-01-03") == []


def test_daily_loads_and_their_rejects(spark):
    folder, ods = scratch_path(spark, "t-land-api"), scratch_path(spark, "t-land-ods")
    _land(folder, "one.json", [_rec("2020-01-01", 2.0), _rec("2020-01-01", "a lot"), _rec("2020-01-02", 3.0), "{broken"], lines=True)
    assert jobs.run_daily(spark, folder, ods, "2020-01-01", multi_line=False) == 1
    _land(folder, "two.json", [_rec("2020-01-02", 4.0), _rec("2020-01-02", None), _rec("not a day")], lines=True)
    for _ in range(2):  # running a day again changes nothing
        assert jobs.run_daily(spark, folder, ods, "2020-01-02", multi_line=False) == 3
    assert files.read_ods(spark, ods).count() == 4
    bad = spark.read.parquet(jobs.rejects_path(ods) + "_api").select("api_day", "file", "block", "place").collect()
    assert sorted((str(r.api_day), r.file.rsplit("/", 1)[-1], r.block, r.place) for r in bad) == [
        ("2020-01-01", "one.json", 0, 1), ("2020-01-01", "one.json", 0, 3), ("2020-01-02", "one.json", 0, 1), ("2020-01-02", "one.json", 0, 3),
        ("2020-01-02", "two.json", 0, 2)]


def test_an_empty_landing_folder(spark):
    folder, ods = scratch_path(spark, "t-land-empty"), scratch_path(spark, "t-land-empty-ods")
    os.makedirs(folder)
    assert jobs.run_daily(spark, folder, ods, "2020-01-01") == 0


def test_landed_json_is_compressed_and_no_file_is_large(spark, monkeypatch):
    """The feed's text is mostly headers: landed as gzip, in files of bounded length, and read back whole."""
    monkeypatch.setattr(files, "FILE_RECORDS", 100, raising=False)
    rows = spark.range(0, 1000, 1, 2).selectExpr("cast(id as string) AS order_id", "cast('2024-01-01' as date) AS order_date", "id * 0.25D AS sales")
    folder = scratch_path(spark, "t-gzip")
    files.write_api_json(rows, folder)
    parts = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(parts) >= 10 and all(f.endswith(".json.gz") for f in parts)
    back = files.read_api_json(spark, folder, multi_line=False)
    assert sorted(map(tuple, back.select(HEADER_NAMES["order_id"], HEADER_NAMES["sales"]).collect())) == sorted((str(i), str(i * 0.25)) for i in range(1000))


def _joins(spark, data_dir, monkeypatch, name):
    """How often a query lands the joined lines, and how often it asks for the join."""
    from salesmart.plans import QUERIES, deliveries, io
    from salesmart.sources import star

    asked, view = [], star.sales_view

    def counted(*args, **kwargs):
        asked.append(args)
        return view(*args, **kwargs)

    for module in (star, io, deliveries):
        monkeypatch.setattr(module, "sales_view", counted)
    writes = []
    landed = getattr(star, "landed_sales", None)
    for module in (io, deliveries):
        if landed:
            monkeypatch.setattr(module, "landed_sales", lambda *a, **k: writes.append(1) or landed(*a, **k))
    QUERIES[name](spark, data_dir)
    return len(writes), len(asked)


def test_the_lines_are_joined_once(spark, data_dir, monkeypatch):
    for name in ("landed_day", "marts_after_deliveries"):
        assert _joins(spark, data_dir, monkeypatch, name) == (1, 1)
        monkeypatch.undo()
