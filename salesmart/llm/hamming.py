"""Exact top-k search over binary codes by incremental multi-index hashing (operator 4).

A code of any width is words of 64 bits, and each word is cut into segments. Codes
at Hamming distance r differ in at most r / m (rounded down) bits in one of the m
segments, so looking up every value within radius s of each of a query's segments
finds all codes up to distance m * (s + 1) - 1; with radius s in the first a
segments and s - 1 in the others, up to m * s + a - 1. The radii grow step by
step, and a query is done when its kth verified distance is covered: its result is
exact. The last steps cover every distance, so no query is left over.

An open query carries how many rows it has found at each distance, and with them
its bound, the kth verified distance so far: the lookup keeps a row only within
it, so what a step finds follows the answers, not the table. Segments are as
long as makes the lookups cheapest for the number of codes (``segment_cuts``):
they grow with its logarithm, so that a value has few codes.

Equal codes are one entry with a count; only the k + 1 smallest ids of a code can
be wanted. A pair is kept at the first step that finds it (its closest, then
first, segment), which a bit count tells, so nothing is de-duplicated by a
shuffle. Queries are dealt over tasks by the number of values they look up, and
both sides of a lookup are shuffled by value: neither is broadcast. All in
DataFrame functions; each step is a table and only counts reach the driver.

Null vectors and ids take no part; a null component counts as not positive, as do
those that a shorter vector lacks. Ties go to the smaller id; rows with the query's
id are its own. With at most k other rows, all are returned. Empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import written

K = 10
#: Up to this radius a step takes all segments at once: they have few values.
WHOLE_STEPS = 2
LONGEST = 22  # bits of a segment: its values are listed to choose those at a distance
PROBES = 200_000  # values looked up by one task


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and code, a struct of words w0, w1 ...: bit i of word j says whether component 64 j + i is positive."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("vector"))
    rows = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    word = """aggregate(transform(slice(vector, {first} + 1, 64), (x, i) -> CASE WHEN x > 0 THEN shiftleft(1L, i) ELSE 0L END), 0L, (a, b) -> a | b)"""
    return rows.select("vec_id", F.struct(*[F.expr(word.format(first=64 * j)).alias(f"w{j}") for j in range(max(1, -(-width // 64)))]).alias("code"))


def segment_cuts(n: int, words: int, k: int = K) -> list[tuple[int, int, int]]:
    """(word, first bit, bits) of each segment, for ``n`` different codes.

    Of all numbers of segments a word, the one whose expected work is least: values to look up
    until the expected kth distance of random codes is covered, each with its share of the codes.
    """
    bits, reach, below = 64 * words, 0, 0.0
    while reach < bits and n * below < k:
        below += math.exp(math.lgamma(bits + 1) - math.lgamma(reach + 1) - math.lgamma(bits - reach + 1) - bits * math.log(2))
        reach += 1
    def work(per_word: int) -> float:
        wide, m = 64 / per_word, per_word * words
        return m * sum(math.comb(math.ceil(wide), s) for s in range(reach // m + 1)) * (1 + n / 2 ** wide)

    best = min(range(-(-64 // LONGEST), 65), key=work)
    ends = [round(64 * j / best) for j in range(best + 1)]
    return [(w, a, b - a) for w in range(words) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _segment(code: str, cut: tuple[int, int, int]) -> str:
    return f"(shiftrightunsigned({code.format(f'.w{cut[0]}')}, {cut[1]}) & {(1 << cut[2]) - 1}L)"


def _distance(a: str, b: str, words: int) -> str:
    return "(" + " + ".join(f"bit_count({a}.w{j} ^ {b}.w{j})" for j in range(words)) + ")"


def _probes(j: int, cut: tuple[int, int, int], s: int) -> Column:
    """array<struct<j, value>>: the values at distance ``s`` from the query's segment (the masks are a folded literal)."""
    return F.expr(f"""transform(filter(sequence(0L, {(1 << cut[2]) - 1}L), x -> bit_count(x) = {s}),
                                x -> named_struct('j', {j}, 'value', {_segment("query{}", cut)} ^ x))""")


def _steps(cuts: list[tuple[int, int, int]]):
    """(radius, segments to look up, distance covered afterwards), in order."""
    m = len(cuts)
    for s in range(max(bits for *_, bits in cuts) + 1):
        if s <= WHOLE_STEPS:
            yield s, list(range(m)), m * (s + 1) - 1
        else:
            for a in range(m):
                yield s, [a], m * s + a


def nearest(codes: DataFrame, asked: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, distance: the ``k`` nearest other rows of each row of ``codes`` that ``asked`` selects."""
    rows = written(codes.select("vec_id", "code", asked.alias("asked")), "codes")
    words = len(rows.schema["code"].dataType.fields)
    width = 64 * words
    distinct = written(rows.groupBy("code").agg(F.count(F.lit(1)).alias("copies")), "codes-distinct")
    cuts = segment_cuts(distinct.count(), words, k)

    entries = written(distinct.select("code", "copies", F.posexplode(F.array(*[
        F.expr(_segment("code{}", cut)) for cut in cuts])).alias("j", "value")), "codes-segments")
    # Per open query: how many rows were found at each distance so far, and the distance beyond which none matters.
    none = F.array_repeat(F.lit(0).cast("long"), width + 1)
    pending = written(rows.where("asked").select(F.col("code").alias("query")).distinct().select(
        "query", none.alias("seen"), F.lit(width).alias("bound")), "codes-pending")
    found = None
    apart = [f"bit_count({_segment('query{0} ^ code{0}', cut)})" for cut in cuts]
    for s, segments, covered in _steps(cuts):
        open_ = pending.count()
        if not open_:
            break
        probes = [_probes(j, cuts[j], s) for j in segments if cuts[j][2] >= s]
        if probes:
            many = open_ * sum(math.comb(cuts[j][2], s) for j in segments)
            dealt = pending.select("query", "bound").repartition(max(1, -(-many // PROBES)), F.xxhash64("query"))
            looked = dealt.select("query", "bound", F.explode(F.concat(*probes)).alias("p")).select("query", "bound", "p.j", "p.value")
            own = F.lit(False)
            for j in segments:
                own = own | ((F.col("j") == j) & F.expr(" AND ".join(
                    [f"{apart[j]} = {s}", *(f"{d} {'>' if i < j else '>='} {s}" for i, d in enumerate(apart) if i != j)])))
            distance = F.expr(_distance("query", "code", words)).cast("int")
            hits = looked.hint("merge").join(entries.withColumnRenamed("j", "of_j").withColumnRenamed("value", "of_value").hint("merge"),
                                             (F.col("j") == F.col("of_j")) & (F.col("value") == F.col("of_value")) & (distance <= F.col("bound")) & own)
            hits = written(hits.select("query", "code", "copies", distance.alias("distance")), "codes-found")
            found = hits if found is None else found.unionByName(hits)
            near = hits.groupBy("query").agg(F.array(*[
                F.sum(F.when(F.col("distance") == d, F.col("copies")).otherwise(0)) for d in range(width + 1)]).alias("new"))
            seen = F.when(F.col("new").isNull(), F.col("seen")).otherwise(F.zip_with("seen", "new", lambda a, b: a + b))
            pending = pending.join(near, "query", "left").select("query", seen.alias("seen"))
        # The least distance within which the query has its own row and k others (the width, if it hasn't).
        reached = F.expr(f"""aggregate(seen, named_struct('n', 0L, 'd', 0), (a, x) -> named_struct(
            'n', a.n + x, 'd', CASE WHEN a.n > {k} THEN a.d ELSE a.d + 1 END), a -> least(a.d - 1, {width}))""")
        pending = written(pending.select("query", "seen", reached.alias("bound")).where(F.col("bound") > covered), "codes-pending")
    if found is None:
        found = distinct.select(F.col("code").alias("query"), "code", "copies", F.lit(0).alias("distance")).limit(0)

    by_id = Window.partitionBy("code").orderBy("vec_id")
    few = rows.select("vec_id", "code").withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1).drop("n")
    order = (F.col("distance"), F.col("vec_id"))
    # Codes beyond the query's (k + 1)-th by distance can't matter; neither can their rows.
    nearest_codes = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "code")))
    reach = nearest_codes.where(F.col("n") <= k + 1).groupBy("query").agg(F.max("distance").alias("most"))
    close = found.join(reach, "query").where("distance <= most").select("query", "code", "distance")
    best = close.join(few, "code").withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("n") <= k + 1)
    queries = rows.where("asked").select(F.col("vec_id").alias("query_id"), F.col("code").alias("query")).distinct()
    answers = queries.join(best.select("query", "vec_id", "distance"), "query").where("query_id <> vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "distance")


ORACLE_SQL = """
WITH rows_ AS (SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS bits FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS INTEGER) AS distance
  FROM rows_ q JOIN rows_ r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS n FROM pairs) WHERE n <= 10
"""
