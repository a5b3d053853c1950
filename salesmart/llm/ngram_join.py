"""N-gram Jaccard join by MinHash banding (operator 2).

1. Every text becomes its set of word n-grams (``shingles``), a digest of that
   set and one hash per MinHash band. Equal sets are one class, found by a
   map-side combined aggregate, so copies, however many, are one row from here.
2. Classes shuffle on their band hashes; each bucket links its members to its
   least one (a star, never pairs), and the stars' connected components hold
   every candidate pair.
3. A component is split into blocks bounded in n-grams and members. Each block,
   and each pair of blocks of a component, is one group that counts common
   n-grams of all its pairs on the full sets and returns, per class, the number
   of documents linked and an edge to its linked group's least class: sums and
   spanning edges, no rows of pairs.
4. Components of the verified edges are the classes of near copies.

Bands and rows are chosen for ``recall`` at the similarity itself (higher above
it). Null and empty texts, and texts without a word, link to nothing: each row
is a class of its own under its id. A text of fewer than n words is one n-gram.
Ids may be null or repeated: rows are told apart by id and text, and a class is
named by its least id (null if none has one). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, slices, vacate, written
from salesmart.llm.graphs import components
from salesmart.llm.shingles import band_hashes, choose_bands, ngram_sets

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9999
BLOCK_NGRAMS, BLOCK_MEMBERS = 400_000, 1500


def _linked(a: list[np.ndarray], b: list[np.ndarray] | None, similarity: float) -> np.ndarray:
    """Which pairs of sets (of ``a``, or of ``a`` and ``b``) are similar enough, by their common n-grams.

    An n-gram that only one set has is in no intersection; the others are
    counted by products of incidence matrices, a few thousand columns at a time.
    """
    every = a if b is None else a + b
    sizes = np.array([len(s) for s in every], np.int64)
    grams, where, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    who = np.repeat(np.arange(len(every)), sizes)
    shared = counts[where] > 1
    column = (np.cumsum(counts > 1) - 1)[where[shared]]
    who, order = who[shared], np.argsort(column, kind="stable")
    column, who = column[order], who[order]
    n, width = len(a), 2048
    common = np.zeros((n, n if b is None else len(b)), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else -1) + 1 + width, width))
    for k, (first, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        has = np.zeros((len(every), width), np.float32)
        has[who[first:end], column[first:end] - k * width] = 1
        common += has[:n] @ (has if b is None else has[n:]).T
    total = sizes[:n, None] + (sizes if b is None else sizes[n:])[None, :]
    linked = common.astype(np.float64) * (1 + similarity) >= similarity * total - 1e-9
    if b is None:
        np.fill_diagonal(linked, False)
    return linked


def _verified(group: list[tuple], p: int, q: int, similarity: float) -> Iterator[tuple]:
    """(class, documents linked, least class reached) of one group's members."""
    members = list({m[0]: m for m in group}.values())  # a repeated row gives its class twice
    if p == q:
        ids, copies = [m[0] for m in members], np.array([m[1] for m in members], np.int64)
        linked = _linked([m[3] for m in members], None, similarity)
    else:
        a, b = [m for m in members if m[2] == p], [m for m in members if m[2] == q]
        if not a or not b:
            return
        members = a + b
        ids, copies = [m[0] for m in members], np.array([m[1] for m in members], np.int64)
        linked = np.zeros((len(members), len(members)), bool)
        across = _linked([m[3] for m in a], [m[3] for m in b], similarity)
        linked[:len(a), len(a):], linked[len(a):, :len(a)] = across, across.T
    links, label = linked @ copies, np.arange(len(ids))
    order = np.array(ids).argsort().argsort()
    low = order.copy()
    while True:
        reach = np.minimum(low, np.where(linked, low[None, :], len(ids)).min(axis=1, initial=len(ids)))
        if (reach == low).all():
            break
        low = reach
    by_order = np.array(ids)[np.argsort(order)]
    for i in label.tolist():
        if links[i]:
            yield ids[i], int(links[i]), int(by_order[low[i]])


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
         similarity: float = SIMILARITY, recall: float = RECALL, block_ngrams: int = BLOCK_NGRAMS,
         block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """One row per document: doc_id, digest (of its text), class_id (the least doc_id of its
    group of near copies), n_links (other documents at ``similarity`` or more) and keep (true
    for the one text of each group that stands for it)."""
    bands, rows = choose_bands(similarity, recall)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for part in slices(batches, "text"):
            sets = ngram_sets(part.column("text").to_pylist(), words)
            some = [s for s in sets if len(s)]
            hashes = iter(band_hashes(some, bands, rows).view(np.int64).tolist() if some else [])
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("digest"), pa.array(keys, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([next(hashes) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "digest", "key", "n", "bands"])

    texts = id_and_text(docs, id_col, text_col).withColumn("digest", F.unhex(F.md5("text")))
    sets = written(texts.mapInArrow(describe, "doc_id long, digest binary, key binary, n long, bands array<long>"), "ngram-sets")
    some = sets.where("key is not null")
    name = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")
    classes = written(some.groupBy("key").agg(
        F.min(name).alias("first"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
        F.first("bands").alias("bands")).withColumn("class", F.monotonically_increasing_id()), "ngram-classes")

    # Candidates: a star per band bucket.
    buckets = classes.select("class", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("class").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    stars = buckets.join(heads.select("bucket", "head"), "bucket").where("class <> head")
    groups = written(components(stars.select(F.col("class").alias("a"), F.col("head").alias("b"))), "ngram-candidates")

    # Blocks of bounded size, and the text of one row of each class.
    members = groups.join(classes.select("class", "first", "copies", "n"), groups["node"] == classes["class"])
    sizes = members.groupBy("root").agg(F.greatest(
        F.ceil(F.sum("n") / block_ngrams), F.ceil(F.count(F.lit(1)) / block_members)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "root").select(
        "root", "class", "copies", "blocks", F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("block"),
        F.col("first.doc_id").alias("of"), F.col("first.digest").alias("of_digest"))
    held = texts.join(dealt, (texts["digest"] == F.col("of_digest")) & texts["doc_id"].eqNullSafe(F.col("of")))

    def ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = ngram_sets(part.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("root", "class", "copies", "blocks", "block")]
                + [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["root", "class", "copies", "blocks", "block", "ngrams"])

    blocks = held.select("root", "class", "copies", "blocks", "block", "text").mapInArrow(
        ngrams, "root long, class long, copies long, blocks int, block int, ngrams array<long>")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = blocks.withColumn("other", other).select(
        "root", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        "class", "copies", "block", "ngrams")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped() -> Iterator[tuple]:
            at, group = None, []
            for batch in batches:
                flat = batch.column("ngrams")
                heads = [batch.column(c).to_pylist() for c in ("root", "p", "q", "class", "copies", "block")]
                for i, (root, p, q, class_, copies, block) in enumerate(zip(*heads, strict=True)):
                    if (root, p, q) != at:
                        if group:
                            yield from _verified(group, at[1], at[2], similarity)
                        at, group = (root, p, q), []
                    group.append((class_, copies, block, flat[i].values.to_numpy()))
            if group:
                yield from _verified(group, at[1], at[2], similarity)

        out = list(zip(*grouped(), strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["class", "links", "low"])

    found = written(pairs.repartition("root", "p", "q").sortWithinPartitions("root", "p", "q", "class")
                    .mapInArrow(verify, "class long, links long, low long"), "ngram-links")
    near = components(found.select(F.col("class").alias("a"), F.col("low").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))

    # Every class: its group's name and its links.
    placed = classes.join(near, classes["class"] == near["node"], "left").join(links, "class", "left").select(
        "key", "first", "copies", F.coalesce("root", "class").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
    names = placed.groupBy("group").agg(F.min("first").alias("name"))
    placed = placed.join(names, "group").select(
        F.col("key").alias("of_key"), "name", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return sets.join(placed, sets["key"] == F.col("of_key"), "left").select(
        "doc_id", "digest", F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("name.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("name").isNull() | (sets["doc_id"].eqNullSafe(F.col("name.doc_id")) & (sets["digest"] == F.col("name.digest")))).alias("keep"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near copies; rows equal in id and text are one."""
    kept = join(docs, id_col, text_col, **options).where("keep")
    kept = kept.groupBy(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")).agg(
        F.count(F.lit(1)).alias("kept_rows"))
    marked = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col("kept_id"))
                       & (F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))) == F.col("kept_digest")))
    once = marked.where("kept_rows = 1").select(*[F.col(c) for c in docs.columns])
    # Of rows equal in id and text the first by all columns stays, so reruns agree; a map-side combined minimum finds it.
    row = F.struct(*[F.col(c) for c in docs.columns])
    again = marked.where("kept_rows > 1").groupBy("kept_id", "kept_digest").agg(F.min_by(row, F.to_json(row)).alias("row")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])
    return once.unionByName(again)


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE c * 1.8 >= 0.8 * (s.n + t.n) - 1e-9),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id AND l.b > r.root),
roots AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, r.class_id, coalesce(n.n_links, 0) AS n_links
FROM documents d JOIN roots r USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) n USING (doc_id)
"""
