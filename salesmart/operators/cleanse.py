"""Cleansing and layer moves: STG text -> typed ODS, daily increments.

All operators are narrow (no shuffle) except the keyed postal-code fill and
the whole-day replacement, whose right sides are small aggregates that AQE
broadcasts from their runtime size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import RAW_DATE_FORMAT, parse_text_date, shift_years
from salesmart.schema import API_RECORD_SCHEMA, HEADER_NAMES, ODS_COLUMNS, ODS_SCHEMA

# The constant postal code the reference writes into every gap.
DEFAULT_POSTAL_CODE = 5401


def parse_dates(raw: DataFrame, cols=("order_date", "ship_date"),
                fmt: str = RAW_DATE_FORMAT) -> DataFrame:
    """P1+P2: text dates -> DateType; unparseable text becomes NULL."""
    for c in cols:
        raw = raw.withColumn(c, parse_text_date(c, fmt))
    return raw


def project_ods(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 17 ODS columns in contract order, cast to contract types (and those to ``keep``).

    Ids are text. ``try_cast``: a malformed number becomes NULL instead of
    failing the whole load under ANSI mode; the jobs send such rows to a
    reject table.
    """
    types = {f.name: f.dataType for f in ODS_SCHEMA.fields}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) for c in ODS_COLUMNS], *keep)


def fill_postal_code(df: DataFrame, value: int = DEFAULT_POSTAL_CODE) -> DataFrame:
    """Every NULL postal code becomes ``value`` (the column stays int)."""
    return df.na.fill({"postal_code": int(value)})


def stg_to_ods(raw: DataFrame, fmt: str = RAW_DATE_FORMAT,
               postal_fill: int | None = DEFAULT_POSTAL_CODE) -> DataFrame:
    """STG -> ODS: parse dates, project, fill postal codes.

    The reference sorts by order date before writing; a table sink has no
    order, so the global sort (a range shuffle of the whole table) is omitted.
    """
    out = project_ods(parse_dates(raw, fmt=fmt))
    return fill_postal_code(out, postal_fill) if postal_fill is not None else out


def postal_lookup(df: DataFrame) -> DataFrame:
    """Known postal code per (state, city): the lowest one seen in the data."""
    return (df.where(F.col("postal_code").isNotNull())
              .groupBy("state", "city").agg(F.min("postal_code").alias("known_postal_code")))


def fill_postal_by_city(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """P5: fill a missing postal code from the same (state, city).

    The lookup has one row per (state, city) - a dimension-sized aggregate of
    the same data - so its size is only known once it is computed: AQE sees
    the aggregate's runtime size and turns the join into a broadcast when it
    is small (no extra pass to count it first); otherwise the join stays
    shuffled and AQE splits a hot city's partition.
    """
    lookup = postal_lookup(df) if lookup is None else lookup
    return (df.join(lookup, ["state", "city"], "left")
              .withColumn("postal_code", F.coalesce("postal_code", "known_postal_code"))
              .select(*df.columns))


def records_to_ods(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """API records (header-named fields) -> typed ODS columns, and those to ``keep`` as they are."""
    back = {v: k for k, v in HEADER_NAMES.items()}
    cols = [F.col(f"`{f.name}`").alias(back[f.name]) for f in API_RECORD_SCHEMA.fields]
    df = records.select(*cols, *keep)
    # ISO dates; malformed text becomes NULL instead of failing the load.
    df = df.withColumn("order_date", parse_text_date("order_date", "yyyy-MM-dd")) \
           .withColumn("ship_date", parse_text_date("ship_date", "yyyy-MM-dd")) \
           .withColumn("postal_code", F.col("postal_code").try_cast("double").try_cast("int"))
    return project_ods(df, keep)


def is_bad(corrupt: str) -> Column:
    """Whether a record can't be loaded whole: not JSON, or with a date, postal code or
    sales value that is there but doesn't parse."""
    date = lambda c: parse_text_date(f"`{HEADER_NAMES[c]}`", "yyyy-MM-dd")
    number = lambda c: F.col(f"`{HEADER_NAMES[c]}`").try_cast("double").try_cast(ODS_SCHEMA[c].dataType)
    bad = F.col(corrupt).isNotNull()
    for c, typed in [(c, date(c)) for c in ("order_date", "ship_date")] + [(c, number(c)) for c in ("postal_code", "sales")]:
        bad = bad | (F.col(f"`{HEADER_NAMES[c]}`").isNotNull() & typed.isNull())
    return bad


def parse_record_text(text: DataFrame, column: str = "value") -> DataFrame:
    """JSON text per row -> record struct fields (``from_json``)."""
    parsed = text.select(F.from_json(F.col(column), API_RECORD_SCHEMA).alias("r"))
    return parsed.select("r.*")


def day_of_text(text: DataFrame, as_of: _dt.date | str | None = None,
                column: str = "value") -> DataFrame:
    """P8 on raw JSON text: keep the records of one order day before parsing.

    Only the date field is extracted (``get_json_object``), so the full
    17-field parse runs on the day's records only, not on the whole feed.
    """
    day = as_of or _dt.date.today()
    day = day.isoformat() if isinstance(day, _dt.date) else day
    order_date = F.get_json_object(F.col(column), f"$['{HEADER_NAMES['order_date']}']")
    return text.where(order_date == F.lit(day))


def increment_from_text(text: DataFrame, as_of: _dt.date | str | None = None,
                        column: str = "value") -> DataFrame:
    """P8+P9 on JSON text: one day's records, parsed and typed as ODS."""
    return records_to_ods(parse_record_text(day_of_text(text, as_of, column), column))


def daily_increment(records: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """P8+P9: keep the records of one order day (default: today), typed as ODS.

    The day is an argument so re-runs and back-fills are reproducible.
    """
    day = as_of or _dt.date.today()
    day = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    return records_to_ods(records).where(F.col("order_date") == F.lit(day))


def replace_days(archive: DataFrame, increment: DataFrame, key: str = "order_date") -> DataFrame:
    """Archive with every day present in ``increment`` replaced by it.

    Idempotent without a row key: re-delivering a day replaces that day
    instead of duplicating it, and two identical lines inside a delivery are
    both kept. The set of delivered days is tiny; AQE broadcasts it from its
    runtime size, so the increment is not computed twice to count it.
    """
    days = increment.select(key).where(F.col(key).isNotNull()).distinct()
    kept = archive.join(days, key, "left_anti")
    return kept.unionByName(increment.select(*archive.columns))


def shift_dates(df: DataFrame, years: int, cols=("order_date", "ship_date")) -> DataFrame:
    """P20: move date columns by whole years (29 Feb clamps to 28 Feb)."""
    for c in cols:
        df = df.withColumn(c, shift_years(c, years))
    return df


def label_split(df: DataFrame, cutoff: _dt.date | str, key: str = "order_date") -> DataFrame:
    """P21 as one column: 'archive' before ``cutoff``, 'future' from it on."""
    day = _dt.date.fromisoformat(cutoff) if isinstance(cutoff, str) else cutoff
    return df.withColumn("part", F.when(F.col(key) < F.lit(day), "archive")
                         .when(F.col(key).isNotNull(), "future"))


def to_raw_text(ods: DataFrame, fmt: str = RAW_DATE_FORMAT) -> DataFrame:
    """ODS -> STG-like frame with dates as text (inverse of P1/P2)."""
    return (ods.withColumn("order_date", F.date_format("order_date", fmt))
               .withColumn("ship_date", F.date_format("ship_date", fmt)))


def to_api_records(ods: DataFrame) -> DataFrame:
    """ODS -> one JSON text per line with the API's header-named fields."""
    cols = [F.col(c).cast("string").alias(HEADER_NAMES[c]) if c in ("order_date", "ship_date")
            else F.col(c).alias(HEADER_NAMES[c]) for c in ODS_COLUMNS]
    return ods.select(F.to_json(F.struct(*cols)).alias("value"))
