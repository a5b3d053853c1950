"""Token ids of a corpus as wavelet-matrix shards (operator 1).

A shard holds the ids of consecutive documents as one wavelet matrix: a
bit-plane per id bit, most significant first, each followed by a stable
partition of the sequence by that bit. With a directory of ones per block a
plane answers rank and select, and so the shard gives, from one compressed
blob, the token at a position (``access``), how often an id occurs before a
position (``rank``) and where its k-th occurrence is (``select``).

Blob layout (little-endian): magic, width, tokens, documents; then zstd
frames, each with its length: document ids, a null mask and first positions;
and per plane the zeros, the ones before each block, and the blocks of
``BLOCK`` bytes, each compressed apart, so a lookup inflates one block a plane.

Documents keep ascending doc_id order (nulls first, then by hash and text
for repeated ids) across shards. Null or empty text: only the end id. An
empty table writes no shard. A document is never cut, so a very long one makes
a longer shard. Lost tasks rewrite their part files through Spark's committer.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, slices
from salesmart.llm.tokens import encoder, with_end
from salesmart.session import scratch_path

MAGIC = b"WVM1"
BLOCK = 8192
SHARD_TOKENS = 1 << 20
INDEX_SCHEMA = "part int, shard int, start_in_part long, n_tokens long, n_documents long, blob binary"


def _planes(ids: np.ndarray, width: int) -> Iterator[np.ndarray]:
    seq = ids.astype(np.uint16 if width <= 16 else np.uint32)
    for level in range(width - 1, -1, -1):
        ones = (seq & seq.dtype.type(1 << level)) != 0
        yield ones
        seq = np.concatenate([seq[~ones], seq[ones]])


def _frame(data: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=1).compress(data)
    return struct.pack("<I", len(packed)) + packed


class WaveletMatrix:
    """One shard, built from ids or read from a blob; planes are inflated block by block."""

    def __init__(self, blob: bytes):
        self.blob = blob
        magic, self.width, self.n, documents = struct.unpack_from("<4sBQQ", blob)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        at = struct.calcsize("<4sBQQ")

        def frame() -> bytes:
            nonlocal at
            (size,) = struct.unpack_from("<I", blob, at)
            at += 4 + size
            return zstandard.ZstdDecompressor().decompress(blob[at - size:at])

        self.doc_ids = np.frombuffer(frame(), np.int64, documents)
        self.null_ids = np.frombuffer(frame(), np.uint8, documents)
        self.edges = np.frombuffer(frame(), np.int64, documents + 1)
        self.zeros, self.before, self.places = [], [], []
        for _ in range(self.width):
            before = np.frombuffer(frame(), np.int64)
            places = []
            for _ in range(len(before) - 1):
                (size,) = struct.unpack_from("<I", blob, at)
                places.append((at + 4, size))
                at += 4 + size
            self.zeros.append(self.n - int(before[-1]))
            self.before.append(before)
            self.places.append(places)
        self._bits: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def pack(ids: np.ndarray, width: int, doc_ids: list, edges: np.ndarray) -> bytes:
        out = [struct.pack("<4sBQQ", MAGIC, width, len(ids), len(doc_ids)),
               _frame(np.array([d or 0 for d in doc_ids], np.int64).tobytes()),
               _frame(np.array([d is None for d in doc_ids], np.uint8).tobytes()),
               _frame(np.asarray(edges, np.int64).tobytes())]
        for ones in _planes(ids, width):
            bits = np.packbits(ones, bitorder="little")
            blocks = [bits[i:i + BLOCK] for i in range(0, len(bits), BLOCK)]
            counts = [int(np.bitwise_count(b).sum()) for b in blocks]
            out.append(_frame(np.cumsum([0, *counts], dtype=np.int64).tobytes()))
            out.extend(_frame(b.tobytes()) for b in blocks)
        return b"".join(out)

    def _block(self, plane: int, block: int) -> np.ndarray:
        """Bits of one block, as bytes of 0 and 1."""
        at, size = self.places[plane][block]
        raw = zstandard.ZstdDecompressor().decompress(self.blob[at:at + size])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
        return bits[:self.n - block * BLOCK * 8]

    def _kept(self, plane: int, block: int) -> np.ndarray:
        if (plane, block) not in self._bits:
            self._bits[plane, block] = self._block(plane, block)
        return self._bits[plane, block]

    def _rank1(self, plane: int, i: int) -> int:
        block, rest = divmod(i, BLOCK * 8)
        ones = int(self.before[plane][min(block, len(self.before[plane]) - 1)])
        return ones + (int(self._kept(plane, block)[:rest].sum()) if rest else 0)

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) ``bit``."""
        ones = self.before[plane]
        ends = np.minimum(np.arange(len(ones)) * BLOCK * 8, self.n)
        counts = ones if bit else ends - ones
        block = int(np.searchsorted(counts, k, side="right")) - 1
        return block * BLOCK * 8 + int(np.flatnonzero(self._kept(plane, block) == bit)[k - counts[block]])

    def access(self, i: int) -> int:
        value = 0
        for plane in range(self.width):
            bit = int(self._kept(plane, i // (BLOCK * 8))[i % (BLOCK * 8)])
            ones = self._rank1(plane, i)
            value = value << 1 | bit
            i = self.zeros[plane] + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        first, end = 0, i
        for plane in range(self.width):
            a, b = self._rank1(plane, first), self._rank1(plane, end)
            if token >> (self.width - 1 - plane) & 1:
                first, end = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                first, end = first - a, end - b
        return first, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` ids."""
        if token >> self.width:
            return 0
        first, end = self._range(token, i)
        return end - first

    def select(self, token: int, k: int) -> int:
        """Position of occurrence ``k`` (from 0) of ``token``."""
        if not 0 <= k < self.rank(token, self.n):
            raise IndexError(k)
        at = self._range(token, self.n)[0] + k
        for plane in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """The whole sequence: the partitions undone from the last plane to the first."""
        seq = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for plane in range(self.width - 1, -1, -1):
            bits = [self._block(plane, b) for b in range(len(self.places[plane]))]
            ones = (np.concatenate(bits) if bits else np.zeros(0, np.uint8)).view(bool)
            back = np.empty_like(seq)
            back[np.flatnonzero(~ones)] = seq[:self.zeros[plane]]
            back[np.flatnonzero(ones)] = seq[self.zeros[plane]:] | seq.dtype.type(1 << (self.width - 1 - plane))
            seq = back
        return seq.astype(np.uint32)


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 0,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` in ascending id order and write their shards under ``path``.

    Documents are range-partitioned by (id, hash of text), so neither one hot id
    nor one task holds the corpus; each task encodes its sorted rows as a
    stream and holds one shard.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(vocabulary)
        width = max(1, (max(enc.tokenizer.get_vocab_size() - 1, end_id)).bit_length())
        shard, start, held, doc_ids, lengths = 0, 0, [], [], []

        def blob() -> pa.RecordBatch:
            nonlocal shard, start
            ids = np.concatenate(held)
            packed = WaveletMatrix.pack(ids, width, doc_ids, np.concatenate([[0], np.cumsum(lengths)]))
            row = [[part], [shard], [start], [len(ids)], [len(doc_ids)], [packed]]
            shard, start = shard + 1, start + len(ids)
            held.clear(), doc_ids.clear(), lengths.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                                                      pa.int64(), pa.binary()), strict=True)],
                names=["part", "shard", "start_in_part", "n_tokens", "n_documents", "blob"])

        for rows in slices(batches, "text", max_rows=max(1, min(512, shard_tokens // 64))):
            ids, edges = with_end(*enc.encode(rows.column("text").to_pylist()), end_id)
            ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
            names = rows.column("doc_id").to_pylist()
            held.append(ids)
            doc_ids.extend(names)
            lengths.extend(np.diff(edges).tolist())
            if sum(map(len, held)) >= shard_tokens:
                yield blob()
        if doc_ids:
            yield blob()

    rows = id_and_text(docs, id_col, text_col)
    key = F.xxhash64("text")
    (rows.repartitionByRange("doc_id", key).sortWithinPartitions("doc_id", key, "text")
     .mapInArrow(encode, INDEX_SCHEMA)
     .write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(path))


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document, from the shards: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32 (of its ids as little-endian unsigned 32-bit integers).

    A part's first position is the sum over earlier parts: a window over one row
    per written part (a task's output), not over shards or documents.
    """
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = parts.select(F.col("part").alias("of_part"), (F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("offset"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, blob in zip(*(batch.column(c) for c in ("part", "start_in_part", "blob")), strict=True):
                m = WaveletMatrix(blob.as_py())
                raw, edges = memoryview(m.ids().astype("<u4").tobytes()), m.edges
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(crc), part.as_py(), np.int32)),
                     pa.array(m.doc_ids, mask=m.null_ids.astype(bool)), pa.array(edges[:-1] + start.as_py()),
                     pa.array(np.diff(edges)), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "start_in_part", "blob").mapInArrow(
        decode, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, docs["part"] == offsets["of_part"]).select(
        "doc_id", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("start"), "n_tokens", "ids_crc32")


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """Occurrences of ``token`` per shard, by rank, without decoding the sequences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(m := WaveletMatrix(x.as_py())).rank(token, m.n) for x in b.column("blob")]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("shard"), pa.array(found, pa.int64())],
                                             names=["part", "shard", "n"])
    return shards.select("part", "shard", "blob").mapInArrow(count, "part int, shard int, n long")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """Every occurrence of ``token``: doc_id and the position in its document, by select."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("blob"):
                m = WaveletMatrix(x.as_py())
                at = np.array([m.select(token, k) for k in range(m.rank(token, m.n))], np.int64)
                doc = np.searchsorted(m.edges, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m.doc_ids[doc], mask=m.null_ids[doc].astype(bool)), pa.array(at - m.edges[doc])],
                    names=["doc_id", "position"])
    return shards.select("blob").mapInArrow(find, "doc_id long, position long")


def corpus_shards(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` as shards in the shared scratch folder and open them."""
    path = scratch_path(docs.sparkSession, "wavelet")
    write_shards(docs, path, **options)
    return docs.sparkSession.read.schema(INDEX_SCHEMA).parquet(path)
