"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (op1_quality, op2_url, op3_exact, op4_bpe, op5_shards, op6_wordpiece, op7_pack, op8_quality, op9_html,
               op10_neardup, op11_codes, op12_centroids, op13_secrets)
from .common import fresh_path, table


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_quality.report(table(spark, sf_dir, "documents"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_url.judge(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_exact.groups(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_bpe.digests(op4_bpe.encode(table(spark, sf_dir, "documents"), decoded=True))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "shards")
    op5_shards.write(table(spark, sf_dir, "documents"), folder)
    return op5_shards.read(spark, folder, with_ids=False).drop("ids")


def op6_word_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_wordpiece.counts(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_pack.with_crc(op7_pack.pack(table(spark, sf_dir, "documents")))


def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_consensus_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op10_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_neardup.components(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_codes.with_errors(*op11_codes.encode(table(spark, sf_dir, "embeddings")))


def op12_threshold_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_centroids.with_inertia(*op12_centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_inferred_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_secrets.secrets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_compression_bands, op2_url_rules, op3_exact_dedup, op4_byte_bpe, op5_token_shards, op6_word_pieces,
                            op7_best_fit_packing, op8_pairwise_quality, op9_consensus_text, op10_tensored_minhash, op11_vector_codes, op12_threshold_centroids,
                            op13_inferred_secrets)}

ORACLES: dict[str, str] = {"op2_url_rules": op2_url.SQL, "op3_exact_dedup": op3_exact.SQL,
                           "op11_vector_codes": op11_codes.sql(), "op12_threshold_centroids": op12_centroids.sql()}
