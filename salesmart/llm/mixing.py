"""Mixing sources to target weights (operator 5), in DataFrame functions only.

The documents of a source get a fixed 60-bit hash. Taking those with a hash
under a threshold takes a nested, random-like share of the source, so a budget
needs only its threshold:

1. sum sizes by (source, hash bucket) - partial sums first, so a source that
   holds a third of all rows is a few thousand rows per task after them;
2. running sums over a source's buckets (at most ``2 ** BITS``) find the bucket
   in which the budget ends; only that bucket is split by the next hash bits,
   and so on until the hash is used up;
3. a filter on hash < threshold selects the rows. Nothing is sorted.

Sources that weigh more than their size are repeated: every document
``copies`` whole times, and those under the threshold once more.

Null sources are one source, last in order; null text has size 0; an empty
table gives an empty mix. Rows equal in id and text share a hash and are taken
alike; the last such group is taken if that comes nearer to the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BITS, ROUNDS = 12, 5
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(id_: Column, text: Column) -> Column:
    """60 bits that depend on the id and the text alone, so reruns agree."""
    digest = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target per source: weights repeat in code-point order, null last;
    targets sum to the whole size, and stop at ``most`` times the source's size, the excess
    being reshared by weight.

    Resharing raises one water level: sources are capped in the order of their
    cap per weight, and the level is what the others share. The window is over one row per source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = total.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("n", F.row_number().over(order)).withColumn(
        "level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # The first source whose cap is not under its level ends the capping: its level holds from there on.
    s = s.withColumn("end", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("n", "level"))).over(everything))
    return s.select("source", "source_size", F.when(
        F.col("n") >= F.col("end.n"), F.col("weight") * F.col("end.level")).otherwise(F.col("cap")).alias("target"))


def thresholds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, hash) of every document, and per source: of, source_size, target,
    copies and threshold."""
    base = written(docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                               size_of(docs[text_col]).alias("size"),
                               hash_of(docs[id_col], docs[text_col]).alias("hash")), "mix-sizes")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets(base, weights, most).select(
        F.col("source").alias("of"), "source_size", "target", copies.alias("copies"),
        (F.col("target") - copies * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("prefix"))
    state = written(state.withColumn("open", F.col("rest") > 0), "mix-state")
    for round_ in range(1, ROUNDS + 1):
        shift = BITS * (ROUNDS - round_)
        inside = base.join(state.where("open"), base["source"].eqNullSafe(F.col("of"))).where(
            F.shiftright("hash", shift + BITS) == F.col("prefix"))
        held = inside.groupBy("of", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("sum"))
        held = held.withColumnRenamed("of", "at")
        upto = Window.partitionBy("at").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        running = held.withColumn("upto", F.sum("sum").over(upto)).join(
            state.where("open").select("of", "rest"), F.col("at").eqNullSafe(F.col("of")))
        # The bucket in which the running sum passes the budget, and what is left of the budget for it.
        cut = running.where("upto > rest").groupBy("at").agg(
            F.min_by(F.struct("bucket", (F.col("rest") - (F.col("upto") - F.col("sum"))).alias("left"),
                              F.col("sum").alias("last")), "bucket").alias("cut"))
        state = written(state.join(cut, state["of"].eqNullSafe(F.col("at")), "left").select(
            "of", "source_size", "target", "copies",
            F.coalesce("cut.left", "rest").alias("rest"),
            # Not passed at all: every remaining hash is under the threshold.
            F.when(F.col("cut").isNotNull(), F.col("cut.bucket"))
            .when(F.col("open"), F.lit(1 << (BITS * round_)).cast("long"))
            .otherwise(F.shiftleft("prefix", BITS)).alias("prefix"),
            F.col("cut").isNotNull().alias("open"),
            F.coalesce("cut.last", F.lit(0)).alias("last")), "mix-state")
    # One hash is left at the threshold: taken if that comes nearer to the budget.
    threshold = F.when(F.col("open") & (F.col("last") - F.col("rest") < F.col("rest")), F.col("prefix") + 1).otherwise(F.col("prefix"))
    ends = state.select("of", "source_size", "target", "copies", threshold.alias("threshold"))
    return base, ends


def _times() -> Column:
    return (F.col("copies") + (F.col("hash") < F.col("threshold")).cast("long")).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, hash, times (how often the mix takes
    it) and taken (= size * times)."""
    base, ends = thresholds(docs, id_col, text_col, source_col, **options)
    return base.join(ends, base["source"].eqNullSafe(F.col("of"))).withColumn("times", _times()).select(
        "doc_id", "source", "size", "source_size", "target", "hash", "times", (F.col("size") * F.col("times")).alias("taken"))


ORACLE_SQL = r"""
WITH base AS (
  SELECT doc_id, source,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
              CAST(source_size * 3 AS DOUBLE) AS cap FROM s0),
s2 AS (SELECT *, cap / weight AS ratio FROM s1),
s3 AS (SELECT *, row_number() OVER (ORDER BY ratio, source ASC NULLS LAST) AS n,
              (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
       FROM s2 WINDOW w AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT min(n) AS n FROM s3 WHERE ratio >= level),
s5 AS (SELECT source, source_size, CASE WHEN s3.n >= s4.n THEN weight * (SELECT level FROM s3 x, s4 y WHERE x.n = y.n) ELSE cap END AS target FROM s3, s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM s5),
run AS (SELECT b.*, s.source_size, s.target, s.copies, s.target - s.copies * s.source_size AS rest,
               sum(b.size) OVER (PARTITION BY b.source ORDER BY b.hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
               sum(b.size) OVER (PARTITION BY b.source, b.hash) AS here
        FROM base b JOIN s6 s ON b.source IS NOT DISTINCT FROM s.source),
edge AS (SELECT source, min(hash) AS hash FROM run WHERE upto > rest GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(r.size * (r.copies + CASE WHEN r.rest <= 0 THEN 0
            WHEN e.hash IS NULL OR r.hash < e.hash THEN 1
            WHEN r.hash = e.hash AND r.here - (r.rest - (r.upto - r.here)) < r.rest - (r.upto - r.here) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run r LEFT JOIN edge e ON r.source IS NOT DISTINCT FROM e.source
"""


def resampled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as it is taken.

    ``times`` depends on a row's source and hash alone, so the rows meet the sources' thresholds, a small table,
    and no join by document is needed.
    """
    ends = thresholds(docs, id_col, text_col, source_col, **options)[1]
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[source_col].alias("source_"),
                       hash_of(docs[id_col], docs[text_col]).alias("hash"))
    taken = rows.join(ends, rows["source_"].eqNullSafe(F.col("of"))).withColumn("times", _times())
    again = F.when(F.col("times") > 0, F.sequence(F.lit(1), F.col("times"))).otherwise(F.array().cast("array<int>"))
    return taken.select("row", F.explode(again)).select(
        *[F.col("row")[c].alias(c) for c in names])
