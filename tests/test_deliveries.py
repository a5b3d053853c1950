"""Change sets of re-delivered days and marts from signed partial sums, against plain loops and full rebuilds."""

import collections
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from salesmart import jobs
from salesmart.operators import changes, marts, rolling
from salesmart.plans.deliveries import in_one
from salesmart.schema import HEADER_NAMES, ODS_COLUMNS, ODS_SCHEMA
from salesmart.session import scratch_path

DAY = dt.date(2020, 1, 1)
COLS = "order_date date, product string, sales double"


def _lines(seed, n, days=6):
    """Few values, so that lines repeat; NULLs in every column; one line holds a third of all."""
    r = random.Random(seed)
    hot = (DAY + dt.timedelta(2), "hot", 1.5)
    return [hot if r.random() < 0.33 else
            (r.choice([None, *(DAY + dt.timedelta(i) for i in range(days))]), r.choice([None, "a", "b"]), r.choice([None, 0.5, 1.0])) for _ in range(n)]


def _plain(archive, delivery):
    days = {x[0] for x in delivery} - {None}
    a, d = (collections.Counter(x for x in rows if x[0] in days) for rows in (archive, delivery))
    out = {}
    for x in a.keys() | d.keys():
        for name, n in (("added", d[x] - a[x]), ("removed", a[x] - d[x]), ("kept", min(a[x], d[x]))):
            if n > 0:
                out[(*x, name)] = n
    return out


@pytest.mark.parametrize("seed", range(4))
def test_change_set_is_the_multiset_difference(spark, seed):
    archive, delivery = _lines(seed, 300), [x for x in _lines(seed + 50, 120) if x[0] is None or x[0] > DAY]
    df = changes.change_set(spark.createDataFrame(archive, COLS).repartition(5), spark.createDataFrame(delivery, COLS).repartition(3))
    got = {tuple(r[:4]): r["lines"] for r in df.collect()}
    assert got == _plain(archive, delivery)
    assert {k for k in got if k[3] != "kept"} == {tuple(r[:4]) for r in changes.change_set(
        spark.createDataFrame(archive, COLS), spark.createDataFrame(delivery, COLS), kept=False).collect()}
    counts = {r.order_date: (r.added, r.removed, r.kept) for r in changes.change_counts(df).collect()}
    want = collections.defaultdict(lambda: [0, 0, 0])
    for (day, _, _, name), n in got.items():
        want[day][("added", "removed", "kept").index(name)] += n
    assert counts == {k: tuple(v) for k, v in want.items()}


def test_change_set_of_nothing(spark):
    some, none = spark.createDataFrame(_lines(1, 40), COLS), spark.createDataFrame([], COLS)
    assert changes.change_set(some, none).count() == changes.change_set(none, none).count() == 0
    assert {r.change for r in changes.change_set(none, some).collect()} == {"added"}
    assert {r.change for r in changes.change_set(some, some).collect()} == {"kept"}


def test_change_set_never_meets_in_one_task(spark, data_dir):
    from salesmart.plans import QUERIES
    plan = QUERIES["ods_change_set"](spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert "partial_sum(before" in plan  # equal lines are one row a task before the shuffle


MART_COLS = "order_date date, customer_name string, city string, category string, sub_category string, product_name string, " \
            "segment string, region string, ship_mode string, sales double"


def _sales(seed, n):
    r = random.Random(seed)
    pick = lambda *v: r.choice([None, *v, *v, *v])
    return [(pick(*(DAY + dt.timedelta(i) for i in range(8))), "hot" if r.random() < 0.33 else pick("ann", "bob"), pick("x", "y"), pick("c1", "c2"),
             pick("s1", "s2"), pick("p1", "p2"), pick("g"), pick("r1", "r2"), pick("m"), pick(0.1, 2.25, -3.0, 1e9)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_marts_after_deliveries_equal_a_rebuild(spark, seed):
    """Three deliveries and a re-delivery, one of them run twice and one of an empty day."""
    root = scratch_path(spark, "t-rolling")
    held = _sales(seed, 300)
    held = [x for x in held if x[0] is not None]
    deliveries = [held, [x for x in _sales(seed + 10, 90) if x[0] and x[0] > DAY + dt.timedelta(4)], [],
                  [x for x in _sales(seed + 20, 60) if x[0] and x[0] < DAY + dt.timedelta(2)]]
    for batch, lines in enumerate(deliveries):
        days = {x[0] for x in lines}
        held = [x for x in held if x[0] not in days or not batch] + (lines if batch else [])
        for _ in range(2 if batch == 1 else 1):
            totals = rolling.deliver(spark.createDataFrame(lines, MART_COLS), root, batch)
    lines = spark.createDataFrame(held, MART_COLS)
    want = in_one({name: marts.mart(lines, name) for name in marts.MARTS})
    assert sorted(map(tuple, in_one(rolling.build(totals)).collect())) == sorted(map(tuple, want.collect()))
    # Keys that lost all their lines are gone, not zero.
    assert totals.where("lines <= 0").count() == 0


def test_a_delivery_needs_its_own_days_only(spark):
    """The second delivery is given one day's lines and nothing else of the table."""
    root = scratch_path(spark, "t-rolling-day")
    rows, day = [x for x in _sales(5, 400) if x[0]], DAY + dt.timedelta(3)
    rolling.deliver(spark.createDataFrame(rows, MART_COLS), root, 0)
    new = [(*x[:9], 7.5) for x in rows if x[0] == day][:20]
    one = spark.createDataFrame(new, MART_COLS)
    assert "SinglePartition" not in rolling.partials(one)._jdf.queryExecution().executedPlan().toString()
    totals = rolling.deliver(one, root, 1)
    assert all("/totals/batch=1/" in f for f in totals.inputFiles())
    assert {r.order_date for r in spark.read.parquet(f"{root}/partials/batch=1").select("order_date").distinct().collect()} == {day}
    whole = spark.createDataFrame([x for x in rows if x[0] != day] + new, MART_COLS)
    rebuilt = {name: marts.mart(whole, name) for name in marts.MARTS}
    assert sorted(map(tuple, in_one(rolling.build(totals)).collect())) == sorted(map(tuple, in_one(rebuilt).collect()))


def test_daily_load_logs_what_it_changed_and_marts_follow(spark):
    ods, landing, root = (scratch_path(spark, f"t-log-{x}") for x in ("ods", "landing", "marts"))
    os.makedirs(landing)
    rec = {HEADER_NAMES[c]: "x" for c in ODS_COLUMNS} | {"Order Date": "2020-11-08", "Ship Date": "2020-11-09", "Postal Code": 1, "Sales": 2.5}

    def load(*records):
        with open(os.path.join(landing, "a.json"), "w") as fh:
            json.dump(records, fh)
        return jobs.run_daily(spark, landing, ods, "2020-11-08")

    assert load(rec, rec, dict(rec, **{"Postal Code": "123456789012"})) == 2  # creates the table; a code that is no int is refused
    assert load(rec, dict(rec, Sales=3)) == 2
    assert load(rec, dict(rec, Sales=3)) == 2
    log = spark.read.parquet(jobs.changes_path(ods)).orderBy("loaded_at", "change", "sales").collect()
    assert [(r.change, r.lines, r.sales) for r in log] == [("added", 2, 2.5), ("added", 1, 3.0), ("removed", 1, 2.5)]
    assert spark.read.schema(ODS_SCHEMA).parquet(ods).count() == 2
    assert spark.read.parquet(jobs.rejects_path(ods) + "_api").count() == 0  # the last load's: it replaces its day's rejects
    jobs.run_delivery(spark, ods, root, 0)
    load(dict(rec, Sales=10))
    built = jobs.run_delivery(spark, ods, root, 1, ["2020-11-08"], scratch_path(spark, "t-log-out"))
    assert [tuple(r) for r in built["top_customers"].collect()] == [("x", 10.0)]


def test_decimal_comma_sales_that_are_no_number_are_refused(spark):
    csv_dir, stg, ods = (scratch_path(spark, f"t-comma-{x}") for x in ("csv", "stg", "ods"))
    os.makedirs(csv_dir)
    head = ";".join(["Row ID", *(HEADER_NAMES[c] for c in ODS_COLUMNS)])
    line = "{};CA-1;08.11.2020;09.11.2020;Second Class;C;Ann;Consumer;US;Henderson;Kentucky;42420;South;F;Furniture;Shelves;Shelf;{}"
    with open(os.path.join(csv_dir, "a.csv"), "w") as fh:
        fh.write("\n".join([head, line.format(1, "12,5"), line.format(2, "a lot"), line.format(3, ""), line.format(4, "1.234,5"), line.format(5, "7")]) + "\n")
    jobs.run_stg(spark, csv_dir, stg, decimal_comma=True)
    assert sorted((r.sales is not None, r.sales or 0) for r in jobs.run_ods(spark, stg, ods).collect()) == [(False, 0), (True, 7.0), (True, 12.5)]
    assert sorted((r.row_id, r._corrupt_record) for r in jobs.rejects(spark, ods).collect()) == [(2, "Sales: a lot"), (4, "Sales: 1.234,5")]
