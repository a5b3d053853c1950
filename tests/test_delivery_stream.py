"""The stream in which the last delivery of a day wins, against a plain loop over the deliveries."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from salesmart.schema import HEADER_NAMES, ODS_COLUMNS
from salesmart.session import scratch_path
from salesmart.streaming import deliveries, ingest

DAY = dt.date(2020, 1, 1)


def _record(day, delivery, at, **more):
    r = {HEADER_NAMES[c]: "x" for c in ODS_COLUMNS} | {"Order Date": day and day.isoformat(), "Ship Date": None, "Postal Code": 7, "Sales": 1.5}
    return r | {"delivery_id": delivery, "delivered_at": at} | more


def _land(feed, name, records):
    os.makedirs(feed, exist_ok=True)
    with open(os.path.join(feed, f"{name}.json"), "w") as fh:
        fh.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def _run(spark, paths, **options):
    feed, lines, ledger, ckpt = paths
    typed = deliveries.delivery_lines(deliveries.delivery_feed(spark, feed))
    ingest.run_to_parquet(typed.drop(deliveries.DELIVERED), lines, f"{ckpt}/lines", partition_by=["order_date", deliveries.DELIVERY])
    return deliveries.run_ledger(deliveries.latest_deliveries(typed, **options), ledger, f"{ckpt}/ledger")


def _paths(spark, name):
    return [scratch_path(spark, f"t-{name}-{x}") for x in ("feed", "lines", "ledger", "ckpt")]


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_and_repeated_deliveries_over_restarts(spark, seed):
    r, paths = random.Random(seed), _paths(spark, f"shuffle{seed}")
    sent = [(number, DAY + dt.timedelta(r.randrange(4)), r.randrange(1, 6) * (100 if number == 3 else 1)) for number in range(10)]
    r.shuffle(sent)
    won = {}
    for wave in (sent[:4], sent[4:7], [], sent[7:]):
        for number, day, n in wave:
            at = f"2020-02-01T0{number % 10}:00:00Z"
            _land(paths[0], f"d{number}", [_record(day, number, at, **{"Order ID": f"{number}-{i % 3}"}) for i in range(n)])
            if number >= won.get(day, (-1,))[0]:
                won[day] = (number, n)
        _run(spark, paths)
        got = {w.order_date: (w.delivery_id, w.lines) for w in deliveries.winners(spark, paths[2]).collect()}
        assert got == won
        rows = deliveries.current_lines(spark, paths[1], paths[2])
        assert {x.order_date: x["count"] for x in rows.groupBy("order_date").count().collect()} == {d: n for d, (_, n) in won.items()}
        assert rows.where(F.split("order_id", "-")[0].cast("long") != -1).count() == sum(n for _, n in won.values())
    replaced = spark.read.schema(deliveries.LEDGER).parquet(paths[2]).where("replaces is not null").collect()
    assert all(x.replaces < x.delivery_id and x.replaced_lines > 0 for x in replaced)


def test_state_goes_with_the_watermark_and_late_deliveries_are_refused(spark):
    paths = _paths(spark, "timer")
    _land(paths[0], "a", [_record(DAY, 1, "2020-02-01T00:00:00Z"), _record(DAY + dt.timedelta(1), 2, "2020-02-01T00:00:00Z")])
    _run(spark, paths, delay="1 day", keep_days=3)
    _land(paths[0], "b", [_record(DAY + dt.timedelta(1), 3, "2020-03-01T00:00:00Z")])
    _run(spark, paths, delay="1 day", keep_days=3)
    _land(paths[0], "c", [_record(DAY, 9, "2020-02-02T00:00:00Z"), _record(DAY + dt.timedelta(2), 4, "2020-03-01T00:00:00Z")])
    q = _run(spark, paths, delay="1 day", keep_days=3)
    # Day one's state timed out; its late delivery is behind the watermark.
    assert [w.delivery_id for w in deliveries.winners(spark, paths[2]).orderBy("order_date").collect()] == [1, 3, 4]
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal == 2


def test_records_without_day_or_delivery_go_to_the_rejects(spark):
    paths = _paths(spark, "rejects")
    _land(paths[0], "a", [_record(DAY, 1, "2020-02-01T00:00:00Z"), _record(None, 1, "2020-02-01T00:00:00Z"), _record(DAY, None, "2020-02-01T00:00:00Z"),
                          _record(DAY, 1, None), _record(DAY, 1, "2020-02-01T00:00:00Z", Sales="a lot"), "{broken"])
    _run(spark, paths)
    assert deliveries.current_lines(spark, paths[1], paths[2]).count() == 1
    bad = scratch_path(spark, "t-delivery-bad")
    ingest.run_to_parquet(deliveries.delivery_rejects(deliveries.delivery_feed(spark, paths[0])), bad, bad + "-ckpt")
    assert spark.read.parquet(bad).count() == 5


def test_an_empty_feed(spark):
    paths = _paths(spark, "empty")
    _land(paths[0], "a", [""])
    _run(spark, paths)
    assert deliveries.current_lines(spark, paths[1], paths[2]).count() == 0 == deliveries.winners(spark, paths[2]).count()
