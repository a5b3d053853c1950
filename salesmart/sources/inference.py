"""Types of CSV columns from one scan, and where a column drifts.

Every value falls into a class, and classes form a lattice: nothing is below all;
whole numbers are decimals, decimals are doubles; two kinds of dates; text is above
all. A column's type is the join of its values' classes. The scan counts (file,
column, class), combined in every task, and keeps the first place of each: a join
of counts is order-free, so the type doesn't depend on which file is read first, and
a class that only a few values have is reported with its first file and line
instead of quietly turning the column into text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.dates import RAW_DATE_FORMAT, parse_text_date
from salesmart.schema import to_snake

#: Classes of values with the type of a column that holds nothing else; numbers in rising order.
NUMBERS = ("bigint", "decimal", "double")
DATES = ("date", "date_text")  # yyyy-MM-dd, dd.MM.yyyy
TEXT, NOTHING = "string", "nothing"


def value_class(v: Column) -> Column:
    """The class of one text value (NULL and empty: nothing)."""
    t = F.trim(v)
    return (F.when(t.isNull() | (t == ""), NOTHING)
             # Most text is told by its first letter, before any pattern.
             .when(~F.substring(t, 1, 1).isin(*"+-.0123456789"), TEXT)
             .when(t.rlike(r"^[+-]?[0-9]{1,18}$"), "bigint")
             .when(t.rlike(r"^[+-]?([0-9]{1,30}\.[0-9]{0,8}|\.[0-9]{1,8}|[0-9]{19,30})$"), "decimal")
             .when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "double")
             .when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & parse_text_date(t, "yyyy-MM-dd").isNotNull(), "date")
             .when(t.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$") & parse_text_date(t, RAW_DATE_FORMAT).isNotNull(), "date_text")
             .otherwise(TEXT))


def joined_type(classes: Column) -> Column:
    """Least type above an array of classes."""
    some = F.array_remove(classes, NOTHING)
    has = lambda *names: F.arrays_overlap(some, F.array(*map(F.lit, names)))
    number, date = has(*NUMBERS), has(*DATES)
    return (F.when(F.size(some) == 0, NOTHING)
             .when(has(TEXT) | (number & date) | (has(DATES[0]) & has(DATES[1])), TEXT)
             .when(date, F.when(has(DATES[0]), DATES[0]).otherwise(DATES[1]))
             .when(has("double"), "double").when(has("decimal"), "decimal").otherwise("bigint"))


def _text(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """The files' columns as text under the first file's header, with ``_file`` and ``_row``."""
    reader = spark.read.option("sep", sep).option("header", True)
    # Without inference Spark reads one file's first line for the names, nothing more.
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return reader.schema(schema).csv(path).select("*", F.col("_metadata.file_path").alias("_file"),
                                                  F.col("_metadata.file_block_start").alias("_block"),
                                                  F.monotonically_increasing_id().alias("_row"))


def column_types(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """Per column: position, column_name, type, values, nulls, and classes: its classes of values by falling
    count as (class, n, file, block, line), the first place that has it (line: of the values in the block, from 0)."""
    df = _text(spark, path, sep)
    names = [c for c in df.columns if c not in ("_file", "_block", "_row")]
    cells = df.select("_file", "_block", "_row", F.posexplode(F.array(*[F.col(f"`{c}`") for c in names])).alias("position", "v"))
    counts = cells.groupBy("_file", "_block", "position", value_class(F.col("v")).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("row"))
    # Rows from here on: files x columns x classes. A block's first row is the least of any class in it.
    first = F.min("row").over(Window.partitionBy("_file", "_block"))
    places = counts.withColumn("place", F.struct("_file", "_block", (F.col("row") - first).alias("line")))
    classes = places.groupBy("position", "class").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
    entry = F.struct((-F.col("n")).alias("order"), F.col("class"), F.col("n"), F.col("place._file").alias("file"),
                     F.col("place._block").alias("block"), F.col("place.line").alias("line"))
    found = classes.groupBy("position").agg(
        F.sort_array(F.collect_list(F.when(F.col("class") != NOTHING, entry))).alias("held"),
        F.sum(F.when(F.col("class") == NOTHING, F.col("n")).otherwise(0)).alias("nulls"))
    every = spark.createDataFrame([(i, c) for i, c in enumerate(names)], "position int, column_name string")
    held = F.coalesce("held", F.array().cast(found.schema["held"].dataType))
    return every.join(found, "position", "left").select(
        "position", "column_name", joined_type(F.transform(held, lambda h: h["class"])).alias("type"),
        F.aggregate(held, F.lit(0).cast("bigint"), lambda a, h: a + h["n"]).alias("values"), F.coalesce("nulls", F.lit(0)).alias("nulls"),
        F.transform(held, lambda h: F.struct(h["class"].alias("class"), h["n"].alias("n"), h["file"].alias("file"),
                                             h["block"].alias("block"), h["line"].alias("line"))).alias("classes"))


def drifts(types: DataFrame, share: float = 0.05) -> DataFrame:
    """Columns whose type is above that of their most frequent class: column_name, usual, type, and each
    class with at most ``share`` of the values that does it, with its first place."""
    usual = F.col("classes")[0]["class"]
    rows = types.where((F.size("classes") > 0) & (F.col("type") != usual))
    return rows.select("column_name", usual.alias("usual"), "type", "values", F.explode("classes").alias("c")).where(
        (F.col("c.class") != F.col("usual")) & (F.col("c.n") <= share * F.col("values"))).select(
        "column_name", "usual", "type", "c.class", "c.n", "c.file", "c.block", "c.line")


_CAST = {"bigint": "bigint", "decimal": "decimal(38,8)", "double": "double", "date": "date", TEXT: "string", NOTHING: "string"}


def read_inferred(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """The files with the types of ``column_types`` and snake_case names; both kinds of dates are dates."""
    types = {r.position: r.type for r in column_types(spark, path, sep).select("position", "type").collect()}
    df = _text(spark, path, sep).drop("_file", "_block", "_row")
    typed = lambda c, kind: (parse_text_date(F.trim(F.col(f"`{c}`")), RAW_DATE_FORMAT) if kind == "date_text"
                             else F.col(f"`{c}`") if kind in (TEXT, NOTHING) else F.trim(F.col(f"`{c}`")).try_cast(_CAST[kind]))
    return to_snake(df.select(*[typed(c, types[i]).alias(c) for i, c in enumerate(df.columns)]))
