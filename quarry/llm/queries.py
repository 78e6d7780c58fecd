"""Queries of the subpackage: one per operator, over whole tables, and SQL where it can express the rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import centroids, cotraining, decontaminate, fim, fingerprint, mixing, ngram_join, oracles, passages, pieces, pii, sharding, substring, url_filter
from quarry.llm.tables import hex_sha256, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(table(spark, sf_dir, "documents")).drop("removed_spans")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(table(spark, sf_dir, "documents"))


def near_passage_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links behind the classes of `op5_near_passages`: in a group of near copies as many as pairs."""
    return passages.near_passages(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), model, packed=True).select("doc_id", "ids")
    counted = docs.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
    return pieces.decoded(counted, model, drop=("ids",)).select("doc_id", "n_tokens", "ids_sha256", hex_sha256(F.col("decoded")).alias("decoded_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transformed(table(spark, sf_dir, "documents"))
    moved = F.col("form") != "plain"
    return made.select(
        "doc_id",
        "n",
        "form",
        F.when(moved, F.length("prefix").cast("long")).alias("prefix_chars"),
        F.when(moved, F.length("middle").cast("long")).alias("middle_chars"),
        hex_sha256(F.col("output")).alias("output_sha256"),
        hex_sha256(fim.restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_mix_sources, op3_substring_dedup, op4_decontaminate, op5_near_passages, op6_url_filter, op7_fingerprint, op8_pii, op9_shards, op10_ngram_join, op11_sentencepiece, op12_centroids, op13_fill_in_middle, near_passage_links)}
ORACLE_SQL: dict[str, str] = dict(oracles.SQL)
