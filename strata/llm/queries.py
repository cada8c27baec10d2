"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe_prefix, conversation_repair, exact_topk, hamming_index, licenses, packing, pii,
               quality, simhash, token_files, toxicity, warc, whitening)
from .common import id_in_fold, table

#: Scores from here on are predicted 1 (toxic, or of good quality).
THRESHOLD = 0.3
#: Near duplicates: words of a shingle, and bits two linked fingerprints may differ in.
SHINGLE, MAX_BITS = 4, 4


def toxicity_held_out() -> Column:
    return id_in_fold(F.col("doc_id"), 4, 2)


def quality_held_out() -> Column:
    return id_in_fold(F.col("doc_id"), 5, 0)


def toxicity_model(spark: SparkSession, docs: DataFrame,
                   sf_dir: str) -> toxicity.FactorizationMachine:
    """Fitted on the documents at hand that are labelled and not held out."""
    return toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic",
                                 ~toxicity_held_out())


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.QualityField:
    """Fitted on the documents at hand that are labelled and not held out."""
    return quality.fit_quality(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality",
                               ~quality_held_out())


def _predicted(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    return _predicted(docs.select(
        "doc_id", toxicity_held_out().alias("held_out"),
        toxicity.toxicity_score(spark, model, F.col("text")).alias("score")))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text",
                                    SHINGLE, MAX_BITS)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_topk(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                                 exact_topk.every(100), k=10, scale=1024.0)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text",
                                  added_tokens=True)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_prefix.encode_documents(table(spark, sf_dir, "documents"), "doc_id", "text",
                                       "byte_bpe_multi_50k.tiktoken")
    return done.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                                 exact_topk.every(100), k=10)


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(spark, docs, sf_dir)
    return _predicted(docs.select(
        "doc_id", quality_held_out().alias("held_out"),
        quality.quality_score(spark, model, F.col("text")).alias("score")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), "doc_id", "text",
                                             token_files.token_folder(spark), added_tokens=True)
    return token_files.read_token_files(manifest)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), "page_id", "html", "url",
                                   warc.archive_folder(spark), min_bytes=0)
    return warc.read_archives(archives)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = conversation_repair.damaged(table(spark, sf_dir, "conversations"), "conv_id", "turn",
                                         "role", "text")
    repair = conversation_repair.repair(broken, "conv", "turn", "role", "text", F.col("copies"))
    return repair.digests().withColumnRenamed("conv", "conv_id")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = whitening.Whitening(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 32)
    return fit.long_rows().withColumnRenamed("id", "vec_id")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), "doc_id", "text").rows
    return found.select("doc_id", *[pii.number_of(k, "base").alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.written("base"), 256).alias("base_sha256"),
                        pii.written("spans").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_simhash_near_dedup, op3_exact_topk, op4_license_scan,
        op5_best_fit_packing, op6_byte_bpe, op7_hamming_index, op8_line_quality,
        op9_token_files, op10_warc, op11_conversation_repair,
        op12_embedding_whitening, op13_personal_data)
}
