"""Helpers shared by the operators: tables, scratch tables, Arrow slices, process-wide caches."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: a lost executor rereads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_rows: int = 512, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (a string) holds about ``max_bytes`` per
    slice: working memory follows the slice, or one row, never the batch."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        first = held = 0
        for i, size in enumerate(sizes):
            if i > first and (held + size > max_bytes or i - first >= max_rows):
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if first < len(sizes):
            yield batch.slice(first)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table | pa.RecordBatch]]:
    """(key, rows) of each run of equal keys, in batches sorted by ``key`` (a number)."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[a] != at:
                yield at, held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks()
                held = []
            at = int(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield at, held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks()


def per_process(name: str, make: Callable):
    """``make()`` once per Python worker process; later tasks of the worker reuse it."""
    cache = sys.__dict__.setdefault("_salesmart_process_cache", {})
    if name not in cache:
        cache[name] = make()
    return cache[name]


def resident(name: str, make: Callable):
    """Like ``per_process`` for large things: a worker holds the last one alone, so that models and
    caches of earlier stages, or of earlier inputs, don't add up in a worker that lives on."""
    cache = sys.__dict__.setdefault("_salesmart_resident", {})
    if name not in cache:
        cache.clear()
        gc.collect()
        cache[name] = make()
    return cache[name]


def vacate() -> None:
    """Give back what earlier stages left in this worker: the resident thing and freed memory."""
    sys.__dict__.setdefault("_salesmart_resident", {}).clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Send at most ``rows`` rows a batch to the session's Python workers: Spark builds a batch whole on
    both sides, so of documents of some kilobytes the default of 10,000 takes tens of megabytes a task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text (null: empty), under fixed names: extra columns and
    clashing names in ``docs`` never reach an operator."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def running_starts(lengths: Column) -> Column:
    """Exclusive running sums of an array<long>, as an expression.

    Two levels (blocks of 256, then inside a block) keep the array copying of
    ``aggregate`` linear in practice for rows with very many entries.
    """
    def scan(values: Column, base: Column) -> Column:
        init = F.struct(F.array().cast("array<long>").alias("out"), base.cast("long").alias("at"))
        step = lambda acc, x: F.struct(F.array_append(acc["out"], acc["at"]).alias("out"),
                                       (acc["at"] + x).alias("at"))
        return F.aggregate(values, init, step, lambda acc: acc["out"])

    size = F.size(lengths)
    blocks = F.sequence(F.lit(0), F.expr("0") + F.floor((size - 1) / 256).cast("int"))
    part = lambda b: F.slice(lengths, b * 256 + 1, F.lit(256))
    sums = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0).cast("long"), lambda a, x: a + x))
    nested = F.zip_with(blocks, scan(sums, F.lit(0)), lambda b, base: scan(part(b), base))
    return F.when(size <= 0, F.array().cast("array<long>")).when(
        size <= 256, scan(lengths, F.lit(0))).otherwise(F.flatten(nested))
