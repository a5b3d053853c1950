"""From raw documents to packed training sequences: each stage reads what the one before it kept.

1. language: documents without a language go; ``lang`` is what was identified.
2. near_duplicates: one document of each group of near copies stays.
3. secrets: every secret is replaced by a mark.
4. mixture: a document is repeated as often as the mix takes it; one it does not take goes.
5. packing: the documents' pieces and their places in sequences of 1024 ids.

Each stage works on the table that the one before it wrote, so a lost executor rereads that.
Null and empty texts have no language and go in the first stage, as do texts without a letter;
nulls in other columns stay. Rows equal in id and text are one after the second stage; of rows
that tie as representatives the least id stays, then the least text. Null ids are kept and
count as larger than all. An empty table gives no rows. Further columns of ``documents``, also
ones whose names an operator uses itself, come through all stages but the last.

A stage's Python workers get small batches, and no model of an earlier stage stays in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import language, mixing, ngram_join, packing, secrets
from salesmart.llm.common import bounded_batches, table, written

#: Language models decide one stage, so SQL can't express run(); tests compare it with a plain-Python version of all stages.
ORACLE_SQL = None
#: Of the encoder's cache beside the memory that the stages before packing took.
CACHED_PIECES = 250_000


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return language.with_language(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return ngram_join.deduplicate(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resampled(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack(docs, cached_pieces=CACHED_PIECES)


STAGES = [("language", language_stage), ("near_duplicates", near_duplicate_stage), ("secrets", secret_stage),
          ("mixture", mixture_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
