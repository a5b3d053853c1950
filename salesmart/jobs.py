"""Layer jobs: the reference's batch steps and its daily load as Spark jobs.

    stg       raw ';' CSV            -> STG parquet (explicit schema, bad lines kept)
    ods       STG parquet            -> ODS parquet, partitioned by order day
    datamart  ODS                    -> nine marts, sales by state, correlations
    forecast  ODS                    -> 7-day forecast mart, one model per series
    daily     landed API JSON (day)  -> that day replaced in the ODS, and what that changed
    delivery  some days of the ODS   -> marts, kept up to date from partial sums

Every step reads and writes tables in storage, so a step that fails is
re-run on its own and a lost executor only costs recomputing its tasks.
Run: ``python -m salesmart.jobs <step> ...`` (see ``--help``).
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import parse_text_date
from salesmart.operators import changes, cleanse, correlate, forecast, geo, marts, rolling
from salesmart.operators import series as ts
from salesmart.schema import ODS_SCHEMA
from salesmart.session import materialize, scratch_path
from salesmart.sources import files, landing, sinks

CORR_DIMENSIONS = ("segment", "category", "ship_mode")


def run_stg(spark: SparkSession, csv_path: str, stg_path: str, sep: str = ";",
            decimal_comma: bool = False) -> DataFrame:
    """CSV -> STG. Corrupt lines stay in ``_corrupt_record`` for inspection."""
    raw = files.read_raw_csv(spark, csv_path, sep=sep, decimal_comma=decimal_comma)
    raw.write.mode("overwrite").parquet(stg_path)
    return spark.read.parquet(stg_path)


def rejects_path(ods_path: str) -> str:
    """Where the rows that a load refused are kept (daily loads: with ``_api``, by day)."""
    return ods_path.rstrip("/") + "_rejects"


def changes_path(ods_path: str) -> str:
    """What the daily loads changed: lines added and removed, one folder per day and load of it
    (a load that is run again finds nothing changed)."""
    return ods_path.rstrip("/") + "_changes"


def landing_ledger_path(ods_path: str) -> str:
    """The ledger of the API files that daily loads have read."""
    return ods_path.rstrip("/") + "_landing"


def run_delivery(spark: SparkSession, ods_path: str, marts_root: str, batch: int,
                 days: list[str] | None = None, out_root: str | None = None) -> dict[str, DataFrame]:
    """Marts after a delivery, from partial sums: ``days`` (None: all, for batch 0) of the ODS are
    summed as delivery ``batch`` and replace what earlier batches held of them. With ``out_root``
    the marts are written there."""
    lines = files.read_ods(spark, ods_path)
    if days is not None:
        lines = lines.where(F.col("order_date").isin([_dt.date.fromisoformat(d) for d in days]))
    built = rolling.build(rolling.deliver(lines, marts_root, batch))
    if out_root:
        sink = sinks.parquet_sink(out_root)
        for name, df in built.items():
            sink(name, df)
    return built


def rejects(spark: SparkSession, ods_path: str) -> DataFrame:
    """The lines that the last full load refused; a count of them says how many."""
    return spark.read.parquet(rejects_path(ods_path))


def run_ods(spark: SparkSession, stg_path: str, ods_path: str,
            postal_fill: int | None = cleanse.DEFAULT_POSTAL_CODE) -> DataFrame:
    """STG -> ODS: typed, projected, postal codes filled, day-partitioned.

    Rebuilds the whole table (days that STG no longer holds go; daily loads
    are run again after it). Lines that don't fit the contract, or whose dates
    don't parse, go to the reject table beside it (``rejects_path``).
    """
    stg = spark.read.parquet(stg_path)
    bad = F.lit(False)
    if files.CORRUPT in stg.columns:
        bad = F.col(files.CORRUPT).isNotNull()
    for c in ("order_date", "ship_date"):
        bad = bad | (F.col(c).isNotNull() & parse_text_date(c).isNull())
    stg.where(bad).write.mode("overwrite").parquet(rejects_path(ods_path))
    stg = stg.where(~bad)
    files.write_ods(cleanse.stg_to_ods(stg, postal_fill=postal_fill), ods_path)
    return files.read_ods(spark, ods_path)


def run_datamart(spark: SparkSession, ods_path: str, out_root: str,
                 state_lookup: DataFrame | None = None) -> list[str]:
    """ODS -> marts as parquet folders under ``out_root``.

    The ODS is read once: sums for all key sets are written to the shared
    scratch folder, and marts, states and correlations follow from them.
    """
    ods = files.read_ods(spark, ods_path)
    sums = sinks.write_sums(ods, scratch_path(spark, "mart-sums"), [["state"], *([dim] for dim in CORR_DIMENSIONS)])
    sink = sinks.parquet_sink(out_root)
    written = sinks.write_marts(sums, sink)
    lookup = state_lookup if state_lookup is not None else geo.us_state_lookup(spark)
    sink("sales_by_state", geo.sales_by_state(marts.of_keys(sums, ["state"]), lookup))
    written.append("sales_by_state")
    for dim in CORR_DIMENSIONS:
        moments = marts.of_keys(sums, [dim]).select(
            F.col(dim).alias("v"), F.col("lines").alias("n_v"), F.col("n").alias("m_v"),
            F.col("sales").alias("s_v"), F.col("sales_sq").alias("q_v"))
        sink(f"corr_{dim}", correlate.corr_matrix(moments, dim, "sales"))
        written.append(f"corr_{dim}")
    return written


def run_forecast(spark: SparkSession, ods_path: str, out_path: str, steps: int = 7,
                 series_cols: list[str] | None = None,
                 order=forecast.DEFAULT_ORDER, seasonal=forecast.DEFAULT_SEASONAL,
                 csv_path: str | None = None) -> DataFrame:
    """ODS -> forecast mart: daily series per ``series_cols`` (one overall
    series by default), one SARIMA fit per series in parallel; optionally
    also exported as headed CSV (K3)."""
    ods = files.read_ods(spark, ods_path)
    daily = materialize(ts.daily_series(ods, series_cols=series_cols))
    out = forecast.sarima_forecast(daily, steps, order, seasonal)
    out.write.mode("overwrite").parquet(out_path)
    result = spark.read.parquet(out_path)
    if csv_path:
        files.write_csv(result.where(F.col("error").isNull()).select("series_id", "prediction_date", "predicted_sales"), csv_path)
    return result


def run_daily(spark: SparkSession, landing_path: str, ods_path: str,
              as_of: _dt.date | str | None = None, multi_line: bool = True) -> int:
    """Landed API responses -> the day ``as_of`` (default today) replaces
    that day's partition in the ODS. Re-running the same day is idempotent.
    Only files that landed since the last load are opened, and those known to hold the day
    (``sources.landing``). Records that don't parse whole go to ``<ods_path>_rejects_api/api_day=...``,
    with file and place;
    the lines that the delivery adds to the day or takes from it, to ``changes_path``."""
    bad = cleanse.is_bad(files.CORRUPT)
    on = as_of.isoformat() if isinstance(as_of, _dt.date) else (as_of or _dt.date.today().isoformat())
    records = landing.read_day(spark, landing_path, landing_ledger_path(ods_path), on, multi_line)
    fields = [c for c in records.columns if c not in ("_file", "_block", "_row")]
    landing.placed(records, bad, fields).write.mode("overwrite").parquet(f"{rejects_path(ods_path)}_api/api_day={on}")
    landed = materialize(cleanse.daily_increment(records.where(~bad), as_of))
    files.create_ods(spark, ods_path)
    archive = spark.read.schema(ODS_SCHEMA).parquet(ods_path).where(F.col("order_date") == F.lit(on).cast("date"))
    at = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    changes.change_set(archive, landed, kept=False).write.parquet(f"{changes_path(ods_path)}/api_day={on}/loaded_at={at}")
    files.write_ods(landed, ods_path, days_only=True)
    return landed.count()


def main(argv: list[str] | None = None) -> None:
    from salesmart.session import build_session

    p = argparse.ArgumentParser(prog="salesmart.jobs", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="step", required=True)
    a = sub.add_parser("stg")
    a.add_argument("csv_path")
    a.add_argument("stg_path")
    a.add_argument("--sep", default=";")
    a.add_argument("--decimal-comma", action="store_true")
    a = sub.add_parser("ods")
    a.add_argument("stg_path")
    a.add_argument("ods_path")
    a = sub.add_parser("datamart")
    a.add_argument("ods_path")
    a.add_argument("out_root")
    a = sub.add_parser("forecast")
    a.add_argument("ods_path")
    a.add_argument("out_path")
    a.add_argument("--steps", type=int, default=7)
    a.add_argument("--series", nargs="*", default=None)
    a.add_argument("--csv", default=None)
    a = sub.add_parser("daily")
    a.add_argument("landing_path")
    a.add_argument("ods_path")
    a.add_argument("--as-of", default=None)
    a = sub.add_parser("delivery")
    a.add_argument("ods_path")
    a.add_argument("marts_root")
    a.add_argument("batch", type=int)
    a.add_argument("--days", nargs="*", default=None)
    a.add_argument("--out", default=None)
    args = p.parse_args(argv)

    spark = build_session(app_name=f"salesmart-{args.step}")
    if args.step == "stg":
        run_stg(spark, args.csv_path, args.stg_path, args.sep, args.decimal_comma)
    elif args.step == "ods":
        run_ods(spark, args.stg_path, args.ods_path)
    elif args.step == "datamart":
        run_datamart(spark, args.ods_path, args.out_root)
    elif args.step == "forecast":
        run_forecast(spark, args.ods_path, args.out_path, args.steps, args.series,
                     csv_path=args.csv)
    elif args.step == "daily":
        run_daily(spark, args.landing_path, args.ods_path, args.as_of)
    elif args.step == "delivery":
        run_delivery(spark, args.ods_path, args.marts_root, args.batch, args.days, args.out)


if __name__ == "__main__":
    main()
