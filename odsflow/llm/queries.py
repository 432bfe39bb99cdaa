"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.llm import (
    align,
    decontaminate,
    language,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    repeats,
    scoring,
    sharding,
    spelling,
    tiers,
)
from odsflow.llm.store import settle, table

VOCABULARY, BYTE_VOCABULARY, PIECE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_masked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(documents(spark, sf_dir))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(documents(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary())


def op4_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.with_quality(documents(spark, sf_dir))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "p_good")


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.dedup_passages(documents(spark, sf_dir))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_licence_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licences(documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(documents(spark, sf_dir))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.found_items(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs)
    held_out = ~language.learning(F.col("doc_id"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_cross_tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY)
    found = align.align(documents(spark, sf_dir), a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    stored = settle(found.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"), "aligned")
    rated = align.rate_links(stored, *align.vocabulary_sizes(a, b))
    return rated.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = tiers.pack_tiers(documents(spark, sf_dir), vocabulary(BYTE_VOCABULARY))
    crc = F.crc32("ids").alias("ids_crc32")
    return placed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "tier", "step")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_masked_scores,
        op2_near_duplicates,
        op3_best_fit_packing,
        op4_differencing_shards,
        op5_quality_votes,
        op6_passage_dedup,
        op7_licence_texts,
        op8_line_dedup,
        op9_benchmark_items,
        op10_language,
        op11_cross_tokenizer_links,
        op12_tier_packing,
        op13_spelling_variants,
    )
}
