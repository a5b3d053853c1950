"""Importance resampling towards a target distribution (operator 13).

Features are all runs of one and two words, hashed by CRC-32 into ``buckets``
counts, so a corpus is one array of fixed length whatever its size. A bucket's
gain is the scaled log ratio of its smoothed share in the target to that in the
corpus; a document weighs the floored mean of its features' gains, read from
the array, and gets a Gumbel number from its id's SHA-256, so that the highest
scores are a sample without replacement in proportion to exp(weight).

The draw takes the ``percent`` % highest scores of the eligible documents
without sorting the rest: in each round every partition reports the median of
its keys still in question and their number; the median of these medians,
weighted by the numbers, splits the rest. At least half of the partitions (by
weight) have half of their keys on its far side, so a quarter of the rest is
settled each round, on either side, until one key is the exact cutoff. The
driver sees one row per partition and round. Only the winners are sorted, by
range, and numbered.

A key is (score, id), ties to the smaller id, null ids last. Null text: no
words. Rows that share score and id are equal; the numbers of the draw run
through them in any order. An empty table, or too few eligible documents, draws
nothing. An empty target gives every bucket the gain that follows from t = T = 0.
Long texts: a slice holds one text at least, with about 60 bytes per word.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, slices, written

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
_LAST = (1 << 63) - 1
_BYTES = np.arange(256)
_IS_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = np.where(_IS_UPPER, _BYTES + 0x20, _BYTES).astype(np.uint8)
_IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: What one more byte does to the sum: read off the sums of single bytes, without their start and end masks.
_STEP = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)
_LONG = 64  # letters; longer words go through zlib one by one


def _crc_on(crc: np.ndarray, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte strings at once, each carried on from the sum in ``crc``."""
    out = crc.copy()
    short = np.flatnonzero(lengths <= _LONG)
    order = short[np.argsort(-lengths[short], kind="stable")]
    state, at = out[order] ^ np.uint32(0xFFFFFFFF), starts[order]
    left = np.searchsorted(-lengths[order], -np.arange(_LONG), side="left")  # strings longer than j
    for j in range(_LONG):
        if not (m := int(left[j])):
            break
        state[:m] = _STEP[(state[:m] ^ raw[at[:m] + j]) & np.uint32(0xFF)] ^ (state[:m] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > _LONG).tolist():
        out[i] = zlib.crc32(raw[starts[i]:starts[i] + lengths[i]], int(crc[i]))
    return out


def features(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each feature, its bucket) and the number of words of each text."""
    parts = [t.encode() for t in texts]
    raw = _LOWER[np.frombuffer(b" ".join([b"", *parts, b""]), np.uint8)]
    begin = np.cumsum([1, *(len(p) + 1 for p in parts)])
    word = _IS_WORD[raw]
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    lengths = np.flatnonzero(word[:-1] & ~word[1:]) + 1 - starts
    of = np.searchsorted(begin, starts, side="right") - 1
    one = _crc_on(np.zeros(len(starts), np.uint32), raw, starts, lengths)
    pairs = np.flatnonzero(of[1:] == of[:-1])
    gap = np.zeros(len(pairs), np.int64)  # the leading blank: what joins two words
    two = _crc_on(_crc_on(one[pairs], raw, gap, gap + 1), raw, starts[pairs + 1], lengths[pairs + 1])
    return (np.concatenate([of, of[pairs]]), np.concatenate([one, two]).astype(np.int64) % buckets,
            np.bincount(of, minlength=len(texts)))


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features in each bucket, summed in every task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for rows in slices(batches, "text"):
            total += np.bincount(features(rows.column("text").to_pylist(), buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = texts.select(F.coalesce(texts[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: two arrays of ``buckets`` counts are all the driver gets."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for held, texts in ((s, corpus), (t, target)):
        for r in bucket_counts(texts, text_col, buckets).collect():
            held[r.bucket] = r.n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
           seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            of, bucket, words = features(rows.column("text").to_pylist(), len(gain))
            n = np.bincount(of, minlength=len(words))
            # Sums of whole numbers below 2^53 are exact in doubles.
            total = np.bincount(of, weights=gain[bucket], minlength=len(words)).astype(np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            luck = np.array([gumbel(i, seed) for i in rows.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight),
                 pa.array(weight + luck)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        score, "doc_id long, n_words long, n_features long, weight long, score long")


def _before(a: Column, b: Column, key: tuple[int, int]) -> Column:
    """Whether (a, b) sorts before ``key``."""
    return (a < key[0]) | ((a == key[0]) & (b < key[1]))


_ROUND = "side int, a long, b long, n long"


def kth_key(keys: DataFrame, k: int) -> tuple[int, int]:
    """The ``k``-th key (from 1) of the frame's two long columns in ascending order, by weighted
    median of medians; there must be ``k`` rows. ``keys`` is read once a round."""
    first, second = keys.columns

    def medians(low, pivot, high):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
            a, b = (np.concatenate([h[i] for h in held] or [np.zeros(0, np.int64)]) for i in (0, 1))
            before = lambda k: (a < k[0]) | ((a == k[0]) & (b < k[1]))
            inside = np.ones(len(a), bool)
            if low is not None:
                inside &= ~before(low) & ~((a == low[0]) & (b == low[1]))
            if high is not None:
                inside &= before(high)
            sides = np.zeros(len(a), np.int8)
            if pivot is not None:
                sides = np.where(before(pivot), -1, np.where((a == pivot[0]) & (b == pivot[1]), 0, 1))
            rows = []
            for side in np.unique(sides[inside]).tolist():
                x, y = a[inside & (sides == side)], b[inside & (sides == side)]
                mid = np.lexsort((y, x))[(len(x) - 1) // 2]
                rows.append((side, int(x[mid]), int(y[mid]), len(x)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["side", "a", "b", "n"])
        return [(r.side, (r.a, r.b), r.n) for r in keys.select(first, second).mapInArrow(run, _ROUND).collect()]

    low = high = pivot = None
    found = medians(low, pivot, high)
    while True:
        if pivot is not None:
            less, equal = (sum(n for s, _, n in found if s == side) for side in (-1, 0))
            if less < k <= less + equal:
                return pivot
            if k <= less:
                side, high = -1, pivot
            else:
                side, low, k = 1, pivot, k - less - equal
            found = [f for f in found if f[0] == side]
        # The rest is what lies on the side kept; its partitions' medians are known already.
        half, passed = (sum(n for _, _, n in found) + 1) // 2, 0
        for _, median, n in sorted(found, key=lambda f: f[1]):
            passed += n
            if passed >= half:
                pivot = median
                break
        found = medians(low, pivot, high)


def draw(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` (as from ``scored``) with rank: 1, 2, 3 ... for the documents drawn, highest score
    first, null for the others. ``scores`` is read once a round: give a written table."""
    tie = F.coalesce("doc_id", F.lit(_LAST))
    rows = scores.withColumn("a", -F.col("score")).withColumn("b", tie)
    eligible = F.col("n_words") >= least_words
    n = rows.where(eligible).count()
    k = n * percent // 100
    none = rows.withColumn("rank", F.lit(None).cast("long"))
    if not k:
        return none.drop("a", "b")
    cutoff = kth_key(rows.where(eligible).select("a", "b"), k)
    wins = eligible & (_before(F.col("a"), F.col("b"), cutoff) | ((F.col("a") == cutoff[0]) & (F.col("b") == cutoff[1])))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            here = np.arange(at + 1, at + b.num_rows + 1)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part)), pa.array(here)],
                                             names=[*b.schema.names, "part", "at"])

    sorted_ = rows.where(wins).repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    places = written(sorted_.mapInArrow(number, f"{_ddl(rows)}, part long, at long"), "draw")
    # One row per written part.
    offsets = places.groupBy("part").agg(F.max("at").alias("held")).select(F.col("part").alias("of_part"), F.coalesce(
        F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    rank = F.col("at") + F.col("offset")
    drawn = places.join(offsets, places["part"] == offsets["of_part"]).withColumn(
        "rank", F.when(rank <= k, rank)).select(*none.columns)
    return none.where(~wins).unionByName(drawn).drop("a", "b")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score and rank in the draw (null: not drawn)."""
    target = target.select(target[target_col].alias("text"))
    corpus = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    gain = gains(corpus, target, "text", buckets)
    return draw(written(scored(corpus, gain, seed=seed), "scored"), percent, least_words)
