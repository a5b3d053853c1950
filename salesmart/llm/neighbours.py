"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 3).

Nearness is the largest inner product. Rows with equal vectors are one node, so
a vector that many rows share is searched once; results are expanded to rows
at the end. Vectors travel as 16-bit codes with a scale; the whole beam is scored
in double precision on the original vectors before the best are taken.

Build: leaves of ``trees`` random-hyperplane orders give first neighbours. Then
each round joins neighbours of neighbours: every node gathers its neighbours
and at most ``reverse`` nodes it is a neighbour of, scores all of them against each
other, and sends each its best; nodes keep their ``k`` best. Rounds end when
fewer than ``settled`` of the edges change. A group has at most k + reverse + 1
members, so no node is hot.

Search: a query keeps a beam of ``beam`` nodes, expands its best unexpanded ones,
``expand`` a round, through a join with the graph (both edge directions), and is
done when all of its beam is expanded; nodes in its beam are not sent to it again. It starts from its own node's
neighbours and from ``entries`` fixed nodes, so clusters that no edge joins are
reached too. The frontier is a table; only counts reach the driver. Beams and links
travel as lists, and ``beam`` is the same for every number of nodes, so a round's rows
grow with the number of queries alone.

Vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do null ids; shorter vectors are padded with zeros. Ties go to the
smaller id. Rows with the query's id are its own. No rows: no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import groups, written

K, REVERSE, TREES, LEAF, ROUNDS, SETTLED = 20, 20, 4, 64, 8, 0.02
BEAM, EXPAND, ENTRIES = 600, 100, 64
SEND = 12
STEPS = 32767
_NEAR = "node long, ids array<long>, sims array<float>, own boolean"


def _matrix(column) -> np.ndarray:
    """A binary column of equal lengths as rows of 16-bit codes."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.int16).reshape(len(values), -1).astype(np.float32)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


class _Out:
    """Collects (node, ids, sims) rows and gives them out as Arrow batches."""

    def __init__(self, own: bool):
        self.own, self.rows = own, []

    def add(self, node: int, ids: np.ndarray, sims: np.ndarray) -> None:
        self.rows.append((node, ids, sims))

    def batch(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            nodes, ids, sims = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), _lists(list(ids), pa.int64()), _lists(list(sims), pa.float32()),
                 pa.array([self.own] * len(nodes))], names=["node", "ids", "sims", "own"])
            self.rows = []


def _best_of_group(ids: np.ndarray, vectors: np.ndarray, most: int, out: _Out) -> None:
    """Sends every member its best others of the group."""
    if len(ids) < 2:
        return
    sims = vectors @ vectors.T
    np.fill_diagonal(sims, -np.inf)
    most = min(most, len(ids) - 1)
    best = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    near = np.take_along_axis(sims, best, axis=1)
    for i, node in enumerate(ids.tolist()):
        out.add(node, ids[best[i]], near[i])


class Index:
    """nodes (node, vector, code, scale), members (node, vec_id), graph (node, ids, sims)."""

    def __init__(self, nodes: DataFrame, members: DataFrame, graph: DataFrame):
        self.nodes, self.members, self.graph = nodes, members, graph


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One node per distinct vector, with its code, and the ids of each node."""
    alike = ("k1", "k2")
    rows = rows.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.hash("vector"))
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    distinct = rows.groupBy(*alike).agg(F.first("vector").alias("vector"))
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "ann-vectors")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = np.zeros((b.num_rows, dim))
            for i, v in enumerate(b.column("vector")):
                vectors[i, :len(v)] = v.values.to_numpy()
            most = np.abs(vectors).max(axis=1, initial=0)
            codes = np.rint(vectors / most[:, None] * STEPS).astype(np.int16)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array((most / STEPS).astype(np.float32))],
                names=["node", "code", "scale"])

    codes = distinct.select("node", "vector").mapInArrow(encode, "node long, code binary, scale float")
    members = written(rows.select("vec_id", *alike).join(distinct.select("node", *alike), list(alike)).select("node", "vec_id"), "ann-members")
    return written(distinct.select("node", "vector").join(codes, "node"), "ann-nodes"), members


def _first_neighbours(nodes: DataFrame, k: int, trees: int, leaf: int, n: int) -> DataFrame:
    """Best neighbours within the leaves of random-hyperplane orders."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = _matrix(b.column("code"))
            for tree in range(trees):
                planes = np.random.default_rng(tree).standard_normal((codes.shape[1], 32))
                key = ((codes @ planes > 0) @ (1 << np.arange(31, -1, -1))).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), tree, np.int32)), pa.array(key), b.column("node"), b.column("code"), b.column("scale")],
                    names=["tree", "key", "node", "code", "scale"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(False)
        for _, rows in groups(batches, "tree"):
            ids = rows.column("node").to_numpy()
            vectors = _matrix(rows.column("code")) * rows.column("scale").to_numpy()[:, None]
            cuts = max(1, len(ids) // leaf)
            for members in np.array_split(np.arange(len(ids)), cuts):
                _best_of_group(ids[members], vectors[members], k, out)
                yield from out.batch(5000)
        yield from out.batch()

    keyed = nodes.select("node", "code", "scale").mapInArrow(keys, "tree int, key long, node long, code binary, scale float")
    order = ("tree", "key", "node")
    return keyed.repartitionByRange(max(1, n * trees // 8192), *order).sortWithinPartitions(*order).mapInArrow(leaves, _NEAR)


def _merged(near: DataFrame, k: int) -> DataFrame:
    """Each node's k best of all that was sent to it; fresh: how many it did not have."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nodes, ids, sims, fresh = zip(*rows, strict=True)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), _lists(list(ids), pa.int64()), _lists(list(sims), pa.float32()), pa.array(fresh, pa.int32())],
                names=["node", "ids", "sims", "fresh"])
            rows.clear()
            return batch

        for node, sent in groups(batches, "node"):
            ids, sims = (pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x
                         for x in (sent.column("ids"), sent.column("sims")))
            flat, score = ids.flatten().to_numpy(), sims.flatten().to_numpy()
            order = np.lexsort((flat, -score))
            _, first = np.unique(flat[order], return_index=True)
            best = order[np.sort(first)][:k]
            own = [v for v, o in zip(ids.to_pylist(), sent.column("own").to_pylist(), strict=True) if o]
            fresh = len(set(flat[best].tolist()) - {x for v in own for x in v})
            rows.append((node, flat[best], score[best], fresh))
            if len(rows) >= 5000:
                yield flush()
        if rows:
            yield flush()

    return near.repartition("node").sortWithinPartitions("node").mapInArrow(
        merge, "node long, ids array<long>, sims array<float>, fresh int")


def _with_reverse(graph: DataFrame, reverse: int) -> DataFrame:
    """(node, other): each node's neighbours, and the ``reverse`` best of the nodes it is a neighbour of."""
    edges = graph.select("node", F.explode(F.arrays_zip("ids", "sims")).alias("e")).select(
        "node", F.col("e.ids").alias("other"), F.col("e.sims").alias("sim"))
    nearest = Window.partitionBy("other").orderBy(F.col("sim").desc(), "node")
    back = edges.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= reverse)
    return edges.select("node", "other").unionByName(back.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct()


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, reverse: int = REVERSE,
          trees: int = TREES, leaf: int = LEAF, rounds: int = ROUNDS, settled: float = SETTLED) -> Index:
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & good)
    nodes, members = _nodes(rows)
    n = nodes.count()

    def local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(False)
        for _, rows in groups(batches, "node"):
            vectors = _matrix(rows.column("code")) * rows.column("scale").to_numpy()[:, None]
            _best_of_group(rows.column("other").to_numpy(), vectors, SEND, out)
            yield from out.batch(20_000)
        yield from out.batch()

    codes = nodes.select(F.col("node").alias("other"), "code", "scale")
    graph = written(_merged(_first_neighbours(nodes, k, trees, leaf, n), k), "ann-graph")
    for _ in range(rounds):
        gathered = _with_reverse(graph, reverse).unionByName(nodes.select("node", F.col("node").alias("other")))
        sent = gathered.join(codes, "other").repartition("node").sortWithinPartitions("node").mapInArrow(local_join, _NEAR)
        graph = written(_merged(sent.unionByName(graph.select("node", "ids", "sims", F.lit(True).alias("own"))), k), "ann-graph")
        fresh = graph.agg(F.sum("fresh")).first()[0] or 0
        if fresh <= settled * k * n:
            break
    return Index(nodes, members, graph.select("node", "ids", "sims"))


def search(index: Index, starts: DataFrame, beam: int = BEAM, expand: int = EXPAND, entries: int = ENTRIES,
           reverse: int = REVERSE) -> DataFrame:
    """(query, node, score): the beam that greedy search ends with for each of ``starts`` (node), scored in double precision."""
    codes = index.nodes.select(F.col("node").alias("other"), "code", "scale")
    links = written(_with_reverse(index.graph, reverse).groupBy("node").agg(F.collect_list("other").alias("others")), "ann-links")
    fixed = index.nodes.select("node").orderBy(F.xxhash64("node")).limit(entries)
    first = starts.select(F.col("node").alias("query")).distinct()
    begun = first.join(index.nodes.select(F.col("node").alias("query"), F.col("code").alias("own"), F.col("scale").alias("own_scale")), "query")
    kind = "query long, own binary, own_scale float, ids array<long>, sims array<float>, done array<boolean>, next array<long>"
    state = written(begun.select("query", "own", "own_scale", F.array().cast("array<long>").alias("ids"),
                                 F.array().cast("array<float>").alias("sims"), F.array().cast("array<boolean>").alias("done"),
                                 F.array(F.col("query")).alias("next")), "ann-beam")
    fixed_ids = [r["node"] for r in fixed.collect()]  # at most ``entries`` numbers

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.float32()),
                 _lists(cols[3], pa.int64()), _lists(cols[4], pa.float32()), _lists(cols[5], pa.bool_()), _lists(cols[6], pa.int64())],
                names=["query", "own", "own_scale", "ids", "sims", "done", "next"])
            rows.clear()
            return batch

        for query, sent in groups(batches, "query"):
            is_state = np.array(sent.column("own").is_valid())
            at = int(np.flatnonzero(is_state)[0])
            own, own_scale = sent.column("own")[at].as_py(), sent.column("own_scale")[at].as_py()
            ids, sims, done = (np.array(sent.column(c)[at].as_py() or [], t) for c, t in (("ids", np.int64), ("sims", np.float32), ("done", bool)))
            got = sent.filter(pa.array(~is_state))
            if got.num_rows:
                new = got.column("other").to_numpy()
                fresh = ~np.isin(new, ids)
                vectors = _matrix(got.column("code")) * got.column("scale").to_numpy()[:, None]
                score = (vectors @ (np.frombuffer(own, np.int16).astype(np.float32) * own_scale)).astype(np.float32)
                ids, sims = np.concatenate([ids, new[fresh]]), np.concatenate([sims, score[fresh]])
                done = np.concatenate([done, np.zeros(int(fresh.sum()), bool)])
            best = np.lexsort((ids, -sims))[:beam]
            ids, sims, done = ids[best], sims[best], done[best]
            chosen = np.flatnonzero(~done)[:expand]
            done[chosen] = True
            rows.append((query, own, own_scale, ids, sims, done, ids[chosen]))
            if len(rows) >= 1000:
                yield flush()
        if rows:
            yield flush()

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for query, sent in groups(batches, "query"):
            held, lists = np.array(sent.column("held")), sent.column("others")
            ids, new = (np.concatenate([x.values.to_numpy() for x in lists.filter(pa.array(which))] or [np.zeros(0, np.int64)])
                        for which in (held, ~held))
            new = np.setdiff1d(new, ids)
            if len(new):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(new), query)), pa.array(new)], names=["query", "other"])

    none = [F.lit(None).cast(t).alias(c) for c, t in (("own", "binary"), ("own_scale", "float"), ("ids", "array<long>"),
                                                      ("sims", "array<float>"), ("done", "array<boolean>"))]
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("other", "long"), ("code", "binary"), ("scale", "float"))]
    begin = state.select("query", F.array("query", *[F.lit(i).cast("long") for i in fixed_ids]).alias("others"))
    round_ = 0
    while state.where(F.size("next") > 0).limit(1).count():
        front = state.select("query", F.explode("next").alias("node"))
        linked = front.join(links, "node").select("query", "others")
        if round_ == 0:
            linked = linked.unionByName(begin)
        sent = linked.withColumn("held", F.lit(False)).unionByName(
            state.where(F.size("next") > 0).select("query", F.col("ids").alias("others"), F.lit(True).alias("held")))
        reached = sent.repartition("query").sortWithinPartitions("query").mapInArrow(unknown, "query long, other long")
        found = reached.join(codes, "other").select("query", *none, "other", "code", "scale")
        held = state.select("query", "own", "own_scale", "ids", "sims", "done", *empty)
        state = written(held.unionByName(found).repartition("query").sortWithinPartitions("query").mapInArrow(step, kind), "ann-beam")
        round_ += 1

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, other = b.column("query_vector"), b.column("vector")
            sizes = pa.compute.list_value_length(own).to_numpy(), pa.compute.list_value_length(other).to_numpy()
            if len(np.unique(np.concatenate(sizes))) == 1:
                x, y = (c.flatten().to_numpy().reshape(b.num_rows, -1) for c in (own, other))
                scores = np.einsum("ij,ij->i", x, y)
            else:
                scores = [float(np.dot(x.values.to_numpy()[:m], y.values.to_numpy()[:m]))
                          for x, y, m in zip(own, other, np.minimum(*sizes).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("query"), b.column("node"), pa.array(scores, pa.float64())],
                                             names=["query", "node", "score"])

    best = state.select("query", F.explode("ids").alias("node"))
    vectors = index.nodes.select("node", "vector")
    pairs = best.join(vectors, "node").join(vectors.select(F.col("node").alias("query"), F.col("vector").alias("query_vector")), "query")
    return pairs.select("query", "node", "query_vector", "vector").mapInArrow(exact, "query long, node long, score double")


def nearest(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 20,
            beam: int | None = None, expand: int = EXPAND, entries: int = ENTRIES, **options) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id satisfies ``queries`` (a function of the id column),
    the ``top`` nearest other rows found."""
    index = build(vectors, id_col, vector_col, **options)
    asked = index.members.where(queries(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "node").distinct()
    found = search(index, asked, beam=max(beam or BEAM, 2 * top), expand=expand, entries=entries)
    # Of rows with the same vector only the top + 1 smallest ids can be wanted.
    ids = Window.partitionBy("node").orderBy("vec_id")
    few = index.members.withColumn("n", F.row_number().over(ids)).where(F.col("n") <= top + 1).drop("n")
    by_score = (F.col("score").desc(), F.col("vec_id"))
    rows = found.join(few, "node").withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*by_score))).where(F.col("n") <= top + 1)
    answers = asked.join(rows.select(F.col("query").alias("node"), "vec_id", "score"), "node").where("query_id <> vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "node").orderBy(*by_score)))
    return ranked.where(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
