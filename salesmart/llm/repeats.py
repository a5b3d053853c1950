"""Removal of byte strings that an earlier document holds too (operator 12).

Every byte covered by a string of ``length`` bytes that also starts in a document
with a smaller id goes. Strings are judged on the input; none crosses documents.
Windows (strings of ``length`` bytes) are compared by a hash-compared suffix sort
(``suffix_sort``), never all at one place:

1. *Blocks.* Documents are written as blocks of some megabytes, compressed, in a
   table bucketed by block, so that the two later passes over the texts join it
   without shuffling it.
2. *Anchors.* A window's anchor is the ``anchor``-byte string in it with the least
   hash, the leftmost of equals: equal windows have equal anchors at the same
   place. Neighbouring windows mostly share theirs, so a text is a row of
   pieces, one for about every 15 bytes. Blocks send each distinct anchor once;
   it is shared if two blocks, or two documents of one block, have it.
3. *Pieces.* Blocks send the bytes of their distinct pieces at shared anchors.
   Where more than ``hot`` different pieces share an anchor (the edges of a
   passage that very many documents quote), each window goes by a hash of its
   own, so such an anchor spreads over many tasks, and equal windows of a
   block go once. One window then has at most one row per block.
4. *Sort.* In each bucket equal pieces are put together (and compared byte by
   byte), then the windows of the different pieces at one anchor are sorted as
   suffixes. Of equal windows the smallest id counts; a piece hears where an
   earlier document has its windows.
5. *Removal.* Blocks mark the bytes, per document.

Nothing is capped or sampled: the anchors only decide where windows meet. The
driver gets the number of bytes. Null text: empty. A null id counts as greater
than all ids. Rows that share an id don't remove each other's strings. Texts
shorter than ``length`` stay whole. An empty table gives no rows. A task holds a
block (or one longer text) with about 20 bytes per anchor, or a bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import groups, id_and_text, slices
from salesmart.llm.suffix_sort import PrefixHashes, differ, mixed, suffix_sort
from salesmart.session import scratch_path

LENGTH, ANCHOR, HOT = 50, 20, 4096
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
_LAST = (1 << 63) - 1
_CHUNK = 1 << 17  # windows hashed at a time: the arrays stay in the processor's cache
_U = np.uint64


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; the bytes of equal weight lie together."""
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    body = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *body]))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    count = int(raw[:8].view(np.int64)[0])
    head, at, out = raw[8:8 + 16 * count].view(np.int64).tolist(), 8 + 16 * count, []
    for char, n in zip(head[::2], head[1::2], strict=True):
        kind = np.dtype(chr(char))
        flat = raw[at:at + n * kind.itemsize].reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(flat.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _stretches(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all stretches, one behind the other."""
    ends = np.cumsum(size)
    return raw[np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Block:
    """Some documents: ids (null: last of all), bytes, and where each begins."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, sizes: np.ndarray, raw: np.ndarray):
        self.ids, self.null, self.raw = ids, null, raw
        self.edges = np.concatenate([[0], np.cumsum(sizes)])

    def owner(self, at: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.edges, at, side="right") - 1]

    def pieces(self, length: int, anchor: int, bits: int) -> dict[str, np.ndarray]:
        """Runs of windows with one anchor: start, count (of windows), anchor (its place in the
        first window), key (hash of the anchor) and body (hash of the run's bytes)."""
        out: dict[str, list[np.ndarray]] = {k: [] for k in ("start", "count", "anchor", "key", "body")}
        total, wide = len(self.raw) - length + 1, length - anchor + 1
        ends = self.edges[1:]
        for a in range(0, total, _CHUNK):
            n = min(_CHUNK, total - a)
            hashes = PrefixHashes(self.raw[a:a + n + length - 1])
            least = mixed(hashes.of(np.arange(n + wide - 1), anchor))
            key, where, span = least, np.arange(len(least), dtype=np.int32), 1
            while span < wide:  # least of ever longer spans, the left one of equals
                d = min(span, wide - span)
                keep = least[:-d] <= least[d:]
                least, where = np.where(keep, least[:-d], least[d:]), np.where(keep, where[:-d], where[d:])
                span += d
            # Windows that begin in the last length - 1 bytes of a document cross its end.
            hit = slice(np.searchsorted(ends, a, side="right"), np.searchsorted(ends, a + n + length, side="left"))
            cross = np.zeros(n + 1, np.int32)
            np.add.at(cross, np.clip(np.maximum(ends[hit] - length + 1, self.edges[:-1][hit]) - a, 0, n), 1)
            np.add.at(cross, np.clip(ends[hit] - a, 0, n), -1)
            whole = np.cumsum(cross[:-1]) == 0
            turn = np.concatenate([[True], (where[1:] != where[:-1]) | ~whole[:-1]]) & whole
            last = np.concatenate([(where[1:] != where[:-1]) | ~whole[1:], [True]]) & whole
            start, stop = np.flatnonzero(turn), np.flatnonzero(last)
            count = stop - start + 1
            out["start"].append(start + a)
            out["count"].append(count)
            out["anchor"].append(where[start] - start)
            # The least hashes are small ones: spread them again, even, for an even share of buckets.
            out["key"].append(mixed(key[where[start]]) & ~_U(1))
            out["body"].append(hashes.of(start, count + length - 1) & _U((1 << bits) - 1))
        return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k in ("key", "body") else np.int64) for k, v in out.items()}

    def window_keys(self, at: np.ndarray, length: int) -> np.ndarray:
        """A hash of each window at ``at`` (rising), odd, unlike the keys of anchors."""
        out = []
        for a in range(0, len(self.raw), _CHUNK):
            here = at[np.searchsorted(at, a):np.searchsorted(at, a + _CHUNK)]
            if len(here):
                out.append(PrefixHashes(self.raw[a:a + _CHUNK + length]).of(here - a, length))
        return mixed(np.concatenate(out)) | _U(1) if out else np.zeros(0, np.uint64)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Whether each row of sorted columns begins a new run of equal rows."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The stretch of rising ``keys`` that each bucket (a range of keys) takes."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, slice(int(cuts[b]), int(cuts[b + 1]))


def _batch(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.values())], names=list(schema))


_ROUTED = {"bucket": pa.int32(), "block": pa.int64(), "kind": pa.int32(), "body": pa.binary()}
_ROUTED_DDL = "bucket int, block long, kind int, body binary"
_ANSWER = {"block": pa.int64(), "kind": pa.int32(), "body": pa.binary()}
_ANSWER_DDL = "block long, kind int, body binary"


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """doc_id, text as a table of blocks (block, size, body) that is bucketed by block."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, held
            null = np.array([i is None for i in ids])
            raw = np.frombuffer(b"".join(texts), np.uint8)
            body = _pack(np.array([_LAST if i is None else i for i in ids], np.int64), null,
                         np.array(list(map(len, texts)), np.int64), raw)
            number, held = number + 1, 0
            ids.clear(), texts.clear()
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(raw)], pa.int64()), pa.array([body], pa.binary())],
                                              names=["block", "size", "body"])

        for batch in slices(batches, "text"):
            texts += [t.encode() for t in batch.column("text").to_pylist()]
            ids += batch.column("doc_id").to_pylist()
            held += sum(map(len, texts[len(texts) - batch.num_rows:]))
            if held >= block_bytes or len(ids) >= 1 << 16:
                yield block()
        if ids:
            yield block()

    spark = rows.sparkSession
    name = f"repeat_blocks_{uuid.uuid4().hex}"
    (rows.mapInArrow(pack, "block long, size long, body binary").write.option("path", scratch_path(spark, "repeat-blocks"))
     .option("compression", "uncompressed").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name))
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # from the catalog: the files stay, and so does the frame over them
    return blocks


def _open(body: bytes) -> Block:
    return Block(*_unpack(body))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, hot: int = HOT, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                   bits: int = 64) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans (maximal removed runs: start, end in bytes)
    and kept (the remaining bytes). ``bits``: how many the hashes keep that comparisons trust until
    they are verified (fewer only in tests)."""
    if not 8 <= anchor <= length:
        raise ValueError("an anchor has at least 8 bytes, and at most a window's")
    blocks = _blocks(id_and_text(docs, id_col, text_col), block_bytes)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    texts = blocks.select("block", F.col("body").alias("texts"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("block").to_pylist(), batch.column("texts"), strict=True):
                b = _open(body.as_py())
                p = b.pieces(length, anchor, bits)
                order = np.lexsort((p["body"], p["key"]))
                key, owner = p["key"][order], b.owner(p["start"][order])
                first = np.flatnonzero(_runs(key)) if len(key) else np.zeros(0, np.int64)
                if not len(first):
                    continue
                several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
                bodies = np.add.reduceat(_runs(key, p["body"][order]).astype(np.int64), first)
                key, bodies = key[first], np.minimum(bodies, hot + 1).astype(np.int32)
                yield _batch(_ROUTED, [(k, number, 0, _pack(key[s], bodies[s], several[s])) for k, s in _by_bucket(key, buckets)])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "bucket"):
            numbers = rows.column("block").to_numpy()
            found = [_unpack(x.as_py()) for x in rows.column("body")]
            of = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            key, bodies, several = (np.concatenate([f[i] for f in found]) for i in range(3))
            order = np.lexsort((of, key))
            key, of = key[order], of[order]
            first = np.flatnonzero(_runs(key))
            held = np.diff(np.append(first, len(key)))
            shared = np.repeat((held > 1) | np.logical_or.reduceat(several[order], first), held)
            is_hot = np.repeat(np.add.reduceat(bodies[order].astype(np.int64), first) > hot, held)
            back = np.argsort(of[shared], kind="stable")
            key, of, is_hot = key[shared][back], of[shared][back], is_hot[shared][back]
            cuts = np.searchsorted(of, np.arange(len(found) + 1))
            yield _batch(_ANSWER, [(int(numbers[i]), 0, _pack(key[a:z], is_hot[a:z]))
                                   for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body, answers in zip(batch.column("block").to_pylist(), batch.column("texts"), batch.column("bodies"), strict=True):
                b, found = _open(body.as_py()), [_unpack(x) for x in answers.as_py()]
                shared, is_hot = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                order = np.argsort(shared)
                entry, start, entries = _entries(b, b.pieces(length, anchor, bits), shared[order], is_hot[order], length)
                # What each entry stands for here comes back with the answers.
                rows = [(number % buckets, number, 1, _pack(entry, start, entries["count"], entries["owner"]))]
                for k, s in _by_bucket(entries["key"], buckets):
                    size = entries["count"][s] + length - 1
                    rows.append((k, number, 0, _pack(np.array([s.start], np.int32), entries["count"][s], entries["anchor"][s],
                                                     entries["owner"][s], _stretches(b.raw, entries["start"][s], size.astype(np.int64)))))
                yield _batch(_ROUTED, rows)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "bucket"):
            kinds, numbers = rows.column("kind").to_numpy(), rows.column("block").to_numpy()
            bodies = rows.column("body")
            yield _batch(_ANSWER, [(int(numbers[i]), 1, bodies[i].as_py()) for i in np.flatnonzero(kinds == 1).tolist()])
            here = np.flatnonzero(kinds == 0).tolist()
            if not here:
                continue
            out = _earlier([_unpack(bodies[i].as_py()) for i in here], length, anchor, bits)
            cuts = np.searchsorted(out[0], np.arange(len(here) + 1))
            yield _batch(_ANSWER, [(int(numbers[here[i]]), 0, _pack(*(x[a:z] for x in out[1:])))
                                   for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, answers in zip(batch.column("texts"), batch.column("answers"), strict=True):
                b = _open(body.as_py())
                gone = _marked(b, [(x["kind"], _unpack(x["body"])) for x in answers.as_py() or []], length)
                yield from _kept(b, gone)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    shares = dealt(texts.mapInArrow(sketch, _ROUTED_DDL)).mapInArrow(share, _ANSWER_DDL)
    shares = shares.groupBy("block").agg(F.collect_list("body").alias("bodies"))
    sent = texts.join(shares, "block").mapInArrow(send, _ROUTED_DDL)
    answers = dealt(sent).mapInArrow(sort, _ANSWER_DDL).groupBy("block").agg(
        F.collect_list(F.struct("kind", "body")).alias("answers"))
    return texts.join(answers, "block", "left").mapInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")


def _entries(b: Block, p: dict[str, np.ndarray], shared: np.ndarray, is_hot: np.ndarray,
             length: int) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The distinct pieces of a block at ``shared`` anchors (rising), by key: start, count, anchor,
    key and owner (smallest id) of each, and (entry, start) of every place where one occurs."""
    at = np.minimum(np.searchsorted(shared, p["key"]), len(shared) - 1)
    known = shared[at] == p["key"]
    plain, hot = np.flatnonzero(known & ~is_hot[at]), np.flatnonzero(known & is_hot[at])
    count = p["count"][hot]
    ends = np.cumsum(count)
    window = np.repeat(p["start"][hot] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
    rows = {"start": np.concatenate([p["start"][plain], window]),
            "count": np.concatenate([p["count"][plain], np.ones(len(window), np.int64)]),
            "anchor": np.concatenate([p["anchor"][plain], np.full(len(window), -1)]),
            "key": np.concatenate([p["key"][plain], b.window_keys(window, length)]),
            "body": np.concatenate([p["body"][plain], np.zeros(len(window), np.uint64)])}
    rows["owner"] = b.owner(rows["start"])
    while True:
        order = np.lexsort((rows["start"], rows["owner"], rows["count"], rows["body"], rows["key"]))
        rows = {k: v[order] for k, v in rows.items()}
        new = _runs(rows["key"], rows["body"], rows["count"])
        first = np.flatnonzero(new)
        entry = np.cumsum(new) - 1
        later = np.flatnonzero(~new)
        off = later[differ(b.raw, rows["start"][later], rows["start"][first[entry[later]]], rows["count"][later] + length - 1) != 0]
        if not len(off):
            break
        rows["body"][off] = mixed(rows["body"][off] + _U(1))  # a collision: they are no copies of the first
    return entry.astype(np.int32), rows["start"].astype(np.int32), {
        "start": rows["start"][first], "count": rows["count"][first].astype(np.int32),
        "anchor": rows["anchor"][first].astype(np.int16), "key": rows["key"][first], "owner": rows["owner"][first]}


def _earlier(found: list[list[np.ndarray]], length: int, anchor: int, bits: int) -> tuple[np.ndarray, ...]:
    """For the pieces of one bucket, one list of arrays per block: (block's place, entry, from, to,
    id): windows from ... to of the piece are in a document with that id, smaller than its owner."""
    of = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
    entry = np.concatenate([np.arange(len(f[1])) + int(f[0][0]) for f in found])
    count = np.concatenate([f[1] for f in found]).astype(np.int64)
    place = np.concatenate([f[2] for f in found]).astype(np.int64)
    owner = np.concatenate([f[3] for f in found])
    size = count + length - 1
    at = np.cumsum(size) - size
    raw = np.concatenate([f[4] for f in found])
    key, body, base = [], [], 0
    for f in found:  # hashes block by block: the arrays behind them are short-lived
        here = slice(base, base + len(f[1]))
        hashes, a = PrefixHashes(f[4]), at[here] - at[base]
        plain = place[here] >= 0
        key.append(np.where(plain, mixed(mixed(hashes.of(a + np.maximum(place[here], 0), anchor))) & ~_U(1),
                            mixed(hashes.of(a, length)) | _U(1)))
        body.append(hashes.of(a, size[here]) & _U((1 << bits) - 1))
        base += len(f[1])
    key, body = np.concatenate(key), np.concatenate(body)
    while True:
        order = np.lexsort((owner, size, body, key))
        new = _runs(key[order], body[order], size[order])
        first = order[new]
        rep = np.empty(len(order), np.int64)
        rep[order] = np.cumsum(new) - 1
        later = order[~new]
        off = later[differ(raw, at[later], at[first[rep[later]]], size[later]) != 0]
        if not len(off):
            break
        body[off] = mixed(body[off] + _U(1))  # a collision: they are no copies of the first
    # Representatives in order of their keys; windows of those that share a key with others are sorted.
    head = _runs(key[first])
    group = np.cumsum(head) - 1
    alone = np.bincount(group, minlength=len(first))[group] == 1 if len(first) else np.zeros(0, bool)
    runs = [np.column_stack([np.flatnonzero(alone), np.zeros(alone.sum(), np.int64), count[first[alone]], owner[first[alone]]])]
    mixed_reps = np.flatnonzero(~alone)
    weight = np.cumsum(size[first[mixed_reps]])
    a = 0
    while a < len(mixed_reps):  # whole groups of about a megabyte
        z = int(np.searchsorted(weight, (weight[a - 1] if a else 0) + (1 << 20), side="right"))
        z = max(z, a + 1)
        z = int(np.searchsorted(group[mixed_reps], group[mixed_reps[z - 1]], side="right"))
        some = mixed_reps[a:z]
        runs.append(_sorted_windows(some, first[some], group[some], raw, at, size, count, place, owner, length, bits))
        a = z
    table = np.concatenate(runs)
    table = table[np.argsort(table[:, 0], kind="stable")]
    # Every member of a representative hears its runs, where an earlier id has them.
    begin = np.searchsorted(table[:, 0], np.arange(len(first) + 1))
    many = np.diff(begin)[rep]
    member = np.repeat(np.arange(len(rep)), many)
    ends = np.cumsum(many)
    row = table[np.repeat(begin[rep] - (ends - many), many) + np.arange(len(member))]
    less = row[:, 3] < owner[member]
    member, row = member[less], row[less]
    # Members are in order of their blocks.
    return of[member], entry[member].astype(np.int32), row[:, 1].astype(np.int32), row[:, 2].astype(np.int32), row[:, 3]


def _sorted_windows(rep, piece, group, raw, at, size, count, place, owner, length, bits) -> np.ndarray:
    """Rows (rep, from, to, id): the smallest id of any equal window, for the windows of some pieces."""
    n = count[piece]
    sizes = size[piece]
    local = np.cumsum(sizes) - sizes
    text = _stretches(raw, at[piece], sizes)
    ends = np.cumsum(n)
    of = np.repeat(np.arange(len(rep)), n)
    off = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
    # Equal windows have their anchor at the same place: only those are compared.
    depth = np.where(place[piece][of] >= 0, place[piece][of] - off, 0)
    order = np.lexsort((depth, group[of]))
    cls = np.cumsum(_runs(group[of][order], depth[order])) - 1
    several = np.bincount(cls)[cls] > 1
    smallest = owner[piece][of].copy()
    todo = order[several]
    if len(todo):
        sorted_, same = suffix_sort(text, PrefixHashes(text, bits), local[of[todo]] + off[todo], cls[several], length)
        windows = todo[sorted_]
        start = np.flatnonzero(~same)
        least = np.minimum.reduceat(smallest[windows], start)
        smallest[windows] = np.repeat(least, np.diff(np.append(start, len(windows))))
    begin = np.flatnonzero(_runs(of, smallest))
    to = np.append(begin[1:], len(of)) - 1
    return np.column_stack([rep[of[begin]], off[begin], off[to] + 1, smallest[begin]])


def _marked(b: Block, answers: list[tuple[int, list[np.ndarray]]], length: int) -> np.ndarray:
    """Which bytes of a block go."""
    change = np.zeros(len(b.raw) + 1, np.int32)

    def cover(start: np.ndarray, stop: np.ndarray) -> None:
        np.add.at(change, start, 1)
        np.add.at(change, stop, -1)

    for entry, start, count, owner in (x for kind, x in answers if kind == 1):
        start, mine = start.astype(np.int64), b.owner(start.astype(np.int64))
        # An earlier document of this block has the piece.
        here = mine > owner[entry]
        cover(start[here], start[here] + count[entry[here]] + length - 1)
        found = [x for kind, x in answers if kind == 0]
        if found:
            e, low, high, first = (np.concatenate([f[i] for f in found]) for i in range(4))
            order = np.argsort(e, kind="stable")
            e, low, high, first = e[order], low[order], high[order], first[order]
            # Every place of an entry with every answer to it; places are in order of their entries.
            begin = np.searchsorted(e, np.arange(len(owner) + 1))
            many = np.diff(begin)[entry]
            ends = np.cumsum(many)
            place = np.repeat(np.arange(len(entry)), many)
            answer = np.repeat(begin[entry] - (ends - many), many) + np.arange(len(place))
            hit = first[answer] < mine[place]
            place, answer = place[hit], answer[hit]
            cover(start[place] + low[answer], start[place] + high[answer] - 1 + length)
    return np.cumsum(change[:-1]) > 0


def _kept(b: Block, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a block's documents, some megabytes a batch."""
    edges = b.edges
    inner = np.zeros(len(gone) + 1, bool)
    inner[edges[:-1]] = True
    starts = np.flatnonzero(gone & (np.concatenate([[True], ~gone[:-1]]) | inner[:-1]))
    stops = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]]) | inner[1:])) + 1
    spans = np.searchsorted(starts, edges)
    total = np.concatenate([[0], np.cumsum(~gone)])[edges]
    kept = b.raw[~gone]
    first = 0
    while first < len(b.ids):
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + (2 << 20), side="right")) - 1)
        docs = slice(first, last)
        base = np.repeat(edges[first:last], np.diff(spans[first:last + 1]))
        inside = slice(spans[first], spans[last])
        pairs = pa.StructArray.from_arrays([pa.array(starts[inside] - base), pa.array(stops[inside] - base)], names=["start", "end"])
        size, left = np.diff(edges[first:last + 1]), np.diff(total[first:last + 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.ids[docs], mask=b.null[docs].astype(bool)), pa.array(size), pa.array(size - left),
             pa.ListArray.from_arrays(pa.array((spans[first:last + 1] - spans[first]).astype(np.int32)), pairs),
             pa.array([kept[x:y].tobytes() for x, y in zip(total[first:last], total[first + 1:last + 1], strict=True)], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
        first = last
