"""The operators bound to the given tables: one query per operator, with its oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    hamming, language, main_text, middle, mixing, neighbours, ngram_join, packing, pii, repeats, resampling, secrets,
    wavelet,
)
from salesmart.llm.common import table
from salesmart.llm.oracles import SECRETS_SQL


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as wavelet-matrix shards and read back."""
    return wavelet.read_documents(wavelet.corpus_shards(table(spark, sf_dir, "documents")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and its number of links."""
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose vec_id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda c: c % 20 == 0)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op7_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.scan(table(spark, sf_dir, "documents"))


def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages"))


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact nearest binary codes of every row whose vec_id is divisible by 50."""
    codes = hamming.sign_codes(table(spark, sf_dir, "embeddings"))
    return hamming.nearest(codes, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "distance")


def op11_skip_list_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle, and the text restored from it."""
    return middle.digests(middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that earlier documents hold."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the quarter that is drawn."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_wavelet_tokens, op2_ngram_join, op3_nn_descent, op4_multi_index_hashing, op5_mix_sources, op6_cross_parsing,
    op7_residual_packing, op8_weak_pii, op9_entropy_secrets, op10_mincut_text, op11_skip_list_middle,
    op12_suffix_dedup, op13_importance_resampling)}

ORACLES = {"op2_ngram_join": ngram_join.ORACLE_SQL, "op4_multi_index_hashing": hamming.ORACLE_SQL,
           "op5_mix_sources": mixing.ORACLE_SQL,
           "op9_entropy_secrets": SECRETS_SQL, "op11_skip_list_middle": middle.ORACLE_SQL}
