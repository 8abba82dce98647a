"""The registered queries of the operators: thin, with production parameters,
each over its whole table; and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    centroids,
    decontamination,
    fill_in_middle,
    language_id,
    mixing,
    near_duplicates,
    oracle,
    pseudonyms,
    quality_model,
    quality_rules,
    secrets_crf,
    sharding,
    suffix_index,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    texts = language_id.training_texts(docs.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, texts)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), k=2).drop("set_digest")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed_rules")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets_crf.digest(secrets_crf.find(docs, secrets_crf.train(docs)))


#: a fixed key makes the query repeatable; a user passes a secret of their own
DEMONSTRATION_KEY = "demonstration key, not a secret"


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, DEMONSTRATION_KEY, counts=True)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).drop("source")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
                                    lambda doc_id: ~language_id.held_out(doc_id, 3, 1))
    return scored.select("doc_id", language_id.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    digits = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(digits, 256).alias("centroid_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_index.remove_repeats(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_secrets": op6_secrets,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_mixing": op8_mixing,
    "op9_quality_model": op9_quality_model,
    "op10_sharding": op10_sharding,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": oracle.decontamination(5, 80),
    "op3_near_duplicates": oracle.near_duplicates(2, 80),
    "op4_warc": oracle.warc(),
    "op5_quality_rules": oracle.quality_rules(),
    "op8_mixing": oracle.mixing(),
    "op11_centroid_clusters": oracle.centroids(),
    "op12_fill_in_middle": oracle.fill_in_middle(),
    "op13_suffix_dedup": oracle.suffix_dedup(),
}
