"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbook.llm import (
    ann,
    hard_negatives,
    kn_quality,
    lang_id,
    line_rules,
    mixing,
    near_dup,
    packing,
    sharding,
    suffix_family,
    toxicity,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, d, "documents"))


def line_frequency_rules(spark: SparkSession, d: str) -> DataFrame:
    return line_rules.verdicts(_table(spark, d, "documents"))


def warc_derivatives(spark: SparkSession, d: str) -> DataFrame:
    responses = warc.responses_of(_table(spark, d, "pages"), date="2024-01-01T00:00:00Z")
    return warc.derivatives(responses, carry="page_id")


def projection_forest_search(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(_table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def segmentation_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    langs, table = lang_id.fit(docs.filter(~held_out))
    predicted = lang_id.predict(docs.select("doc_id", "text"), langs, table)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def kneser_ney_quality(spark: SparkSession, d: str) -> DataFrame:
    return kn_quality.filtered(_table(spark, d, "documents"), _table(spark, d, "labels"))


def toxicity_chain(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = _table(spark, d, "documents"), _table(spark, d, "labels")
    chain = toxicity.fit(docs, labels, ["quality", "toxic"])
    return toxicity.predict(docs, chain).select("doc_id", "p_quality", "p_toxic", "toxic")


def bound_certified_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(_table(spark, d, "documents"), length=2048)


def feistel_shards(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    return sharding.shard(rows, "doc_id", ["doc_id", "text_crc32", "size"], n_shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def source_mix(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size"), F.md5(F.col("text").cast("binary")).alias("tie")
    )
    return mixing.mix(rows, "size", ["tie"], weights=[3, 1, 2]).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whitened(_table(spark, d, "embeddings"), k=4)


def threshold_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def suffix_array_family(spark: SparkSession, d: str) -> DataFrame:
    return suffix_family.repeated_passages(_table(spark, d, "documents")).drop("spans")


QUERIES = {
    "op1_minhash_near_dedup": minhash_near_dedup,
    "op2_line_frequency_rules": line_frequency_rules,
    "op3_warc_derivatives": warc_derivatives,
    "op4_segmentation_language_id": segmentation_language_id,
    "op5_projection_forest_search": projection_forest_search,
    "op6_kneser_ney_quality": kneser_ney_quality,
    "op7_toxicity_chain": toxicity_chain,
    "op8_bound_certified_packing": bound_certified_packing,
    "op9_feistel_shards": feistel_shards,
    "op10_source_mix": source_mix,
    "op11_embedding_whitening": embedding_whitening,
    "op12_suffix_array_family": suffix_array_family,
    "op13_threshold_hard_negatives": threshold_hard_negatives,
}
