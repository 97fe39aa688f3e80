"""The registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewake.llm import conversation_repair, exact_dedup, language_id, merkle, mixing, near_dedup, packing, quality, simhash_dedup, substring_dedup, token_counts, toxicity, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir)).drop("tag")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_documents(spark, sf_dir)).drop("spans", "tag")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir)).drop("copies", "tag")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_held_out(_documents(spark, sf_dir)).drop("spans")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles and 85 percent, as asked for; eight registers a band."""
    return near_dedup.near_dedup(_documents(spark, sf_dir), width=3, percent=85, rows_per_band=8).drop("tag")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_held_out(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir)).drop("removed_at", "tag")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(_documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.merkle_manifest(_documents(spark, sf_dir), merkle.DOCUMENT, current=merkle.tampered_documents())
    return found.drop("proof")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair_conversations(conversation_repair.damaged(conversations), named=conversations)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_substring_dedup, op3_mixing, op4_packing, op5_language_id, op6_near_dedup, op7_toxicity, op8_token_counts, op9_quality, op10_warc, op11_simhash_dedup, op12_merkle_manifest, op13_conversation_repair)}

ORACLES = {
    "op1_exact_dedup": exact_dedup.QUERY_SQL,
    "op2_substring_dedup": substring_dedup.QUERY_SQL,
    "op3_mixing": mixing.QUERY_SQL,
    "op9_quality": quality.QUERY_SQL,
    "op10_warc": warc.QUERY_SQL,
    "op12_merkle_manifest": merkle.QUERY_SQL,
    "op13_conversation_repair": conversation_repair.QUERY_SQL,
}
