"""The queries of the operators (fixed contracts) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (op1_ctw, op2_toxicity, op3_mixing, op4_suffixes, op5_jaccard, op6_secrets, op7_recompression, op8_topk,
               op9_decontamination, op10_warc, op11_whitening, op12_minhash, op13_clustering)
from .common import table
from .oracles import ORACLES  # noqa: F401


def op1_ctw_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_ctw.score(table(spark, sf_dir, "documents"))


def op2_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op2_toxicity.classify(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", op2_toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= op2_toxicity.THRESHOLD).cast("int").alias("predicted"), "offending")


def op3_mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op4_suffixes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_suffixes.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op5_jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_secrets.report(table(spark, sf_dir, "documents"))


def op7_recompression_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_recompression.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op8_topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return op8_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op9_decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_warc.round_trip(table(spark, sf_dir, "pages")) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_whitening.whiten(table(spark, sf_dir, "embeddings")) \
        .withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_minhash.classes(table(spark, sf_dir, "documents"))


def op13_clustering_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op13_clustering.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumns({c: F.col(c).try_cast("long") for c in ("distance", "cluster_inertia", "inertia")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ctw": op1_ctw_query,
    "op2_toxicity": op2_toxicity_query,
    "op3_mixing": op3_mixing_query,
    "op4_suffixes": op4_suffixes_query,
    "op5_jaccard": op5_jaccard_query,
    "op6_secrets": op6_secrets_query,
    "op7_recompression": op7_recompression_query,
    "op8_topk": op8_topk_query,
    "op9_decontamination": op9_decontamination_query,
    "op10_warc": op10_warc_query,
    "op11_whitening": op11_whitening_query,
    "op12_minhash": op12_minhash_query,
    "op13_clustering": op13_clustering_query,
    "pipeline": corpus_pipeline.run,
}
