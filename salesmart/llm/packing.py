"""Best-fit packing of tokenised documents into sequences (operator 7).

A document's ids end with ``end_id``. One longer than ``capacity`` is cut into
pieces of ``capacity`` ids, the first of which may be shorter; full pieces are
sequences by themselves. The others are packed hierarchically:

1. every partition packs its own pieces by best fit, longest first;
2. bins filled to within ``slack`` are final. Of the rest at most one is half
   full or less (two would have been put together), and bins over half never
   share a sequence. So a partition hands up its half-empty bin and its
   ``spare`` emptiest bins, as items, and keeps the others as they are;
3. groups of ``fan_in`` partitions best-fit the bins they were handed, hand up
   what is left in the same way, and so on until one group remains. The rows a
   group gets are bounded by ``fan_in`` x (``spare`` + 1), whatever the input.

The pieces are written once (narrow rows: no text, no ids); the rounds see
bins only. Null text: an empty document, which is just its end id. An empty
table packs into nothing. Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, slices, written
from salesmart.llm.tokens import encoder, with_end

CAPACITY, SLACK, SPARE, FAN_IN = 1024, 8, 256, 8
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, at long, used long, handed boolean"


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best fit, largest first: each item's bin and place in it, and each bin's fill.

    Open bins are kept by free room; a bit mask of the rooms in use finds the
    least room that is enough in one step.
    """
    bin_of, at, used = [0] * len(sizes), [0] * len(sizes), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        size = sizes[i]
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b = len(used)
            used.append(0)
        bin_of[i], at[i] = b, used[b]
        used[b] += size
        if left := capacity - used[b]:
            by_room[left].append(b)
            rooms |= 1 << left
    return bin_of, at, used


def _handed(used: list[int], capacity: int, slack: int, spare: int) -> set[int]:
    """Bins that go up a level: those at most half full, and the emptiest others."""
    under = sorted((u, b) for b, u in enumerate(used) if u < capacity - slack)
    low = sum(2 * u <= capacity for u, _ in under)
    return {b for _, b in under[:low + spare]}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         end_id: int = 2, capacity: int = CAPACITY, slack: int = SLACK, spare: int = SPARE,
         fan_in: int = FAN_IN, cached_pieces: int = 600_000) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``cached_pieces``
    bounds the encoder's cache."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(vocabulary, cached_pieces), TaskContext.get().partitionId() << 40
        doc_of, null_of, number, start, length, crc = [], [], [], [], [], []
        for rows in slices(batches, "text"):
            ids, edges = with_end(*enc.encode(rows.column("text").to_pylist()), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            edges = edges.tolist()
            for doc, first, end in zip(rows.column("doc_id").to_pylist(), edges[:-1], edges[1:], strict=True):
                cuts = [first, *range(first + ((end - first) % capacity or capacity), end + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    doc_of.append(doc or 0), null_of.append(doc is None), number.append(k)
                    start.append(a - first), length.append(b - a), crc.append(zlib.crc32(raw[4 * a:4 * b]))
        bin_of, at, used = best_fit(length, capacity)
        up = _handed(used, capacity, slack, spare)
        for i in range(0, len(length), 10_000):
            cut, bins = slice(i, i + 10_000), bin_of[i:i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(doc_of[cut], np.int64), mask=np.array(null_of[cut])), pa.array(number[cut], pa.int32()),
                 pa.array(start[cut], pa.int64()), pa.array(length[cut], pa.int64()), pa.array(crc[cut], pa.int64()),
                 pa.array([part + b for b in bins], pa.int64()), pa.array(at[cut], pa.int64()),
                 pa.array([used[b] for b in bins], pa.int64()), pa.array([b in up for b in bins], pa.bool_())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "at", "used", "handed"])

    placed = written(id_and_text(docs, id_col, text_col).mapInArrow(pieces, _PIECES), "pieces")
    # One row per bin: the piece at its start stands for it.
    bins = placed.where("handed and at = 0").select("bin", "used")
    moved = _merge_rounds(bins, capacity, slack, spare, fan_in)
    return placed.join(moved, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"))


def _merge_rounds(bins: DataFrame, capacity: int, slack: int, spare: int, fan_in: int) -> DataFrame:
    """bin, into, shift of every handed bin: the sequence it ends in, and its place there."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).to_pydict() if batches else {}
        groups: dict[int, list[int]] = {}
        for i, g in enumerate(rows["group"]):
            groups.setdefault(g, []).append(i)
        out: list[tuple] = []
        for members in groups.values():
            members.sort(key=lambda i: rows["bin"][i])
            bin_of, at, used = best_fit([rows["used"][i] for i in members], capacity)
            up = _handed(used, capacity, slack, spare)
            head = {b: rows["bin"][i] for i, b, a in zip(members, bin_of, at, strict=True) if a == 0}
            out += [(rows["bin"][i], head[b], a, used[b], b in up)
                    for i, b, a in zip(members, bin_of, at, strict=True)]
        names = ["bin", "into", "shift", "used", "handed"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out],
                                         pa.schema([*((n, pa.int64()) for n in names[:4]), ("handed", pa.bool_())]))

    def merged_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from merge(held)

    schema = "bin long, into long, shift long, used long, handed boolean"
    moved, level = None, 0
    last = bins.select(F.max(F.shiftright("bin", 40))).first()[0]
    groups = 1 if last is None else int(last) + 1
    live = bins.withColumn("group", F.shiftright("bin", 40))
    while groups > 1 or level == 0:
        level += 1
        live = live.withColumn("group", F.floor(F.col("group") / fan_in).cast("long"))
        groups = -(-groups // fan_in)
        round_ = written(live.select("group", "bin", "used").repartition("group")
                         .mapInArrow(merged_groups, schema), "packing-round")
        step = round_.select("bin", "into", "shift")
        if moved is None:
            moved = step
        else:
            then = step.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("shift").alias("more"))
            moved = moved.join(then, "into", "left").select(
                "bin", F.coalesce("next", "into").alias("into"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        live = round_.where("handed and shift = 0").select(
            "bin", "used", F.shiftright("bin", 40).alias("group"))
        for _ in range(level):
            live = live.withColumn("group", F.floor(F.col("group") / fan_in).cast("long"))
    return moved
