"""One query per operator over the driver tables, with production parameters, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.llm import (
    bpe_replay,
    decontamination,
    hard_negatives,
    jaccard_join,
    language_id,
    line_dedup,
    quality_cnn,
    quality_rules,
    sharding,
    sql,
    substring_dedup,
    topk_search,
    toxicity,
    whitening,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_cnn.train(docs, _table(spark, sf_dir, "labels"))
    return quality_cnn.score_quality(docs, model)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op2_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("segments").alias("n_segments"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = _table(spark, sf_dir, "documents")
    return bpe_replay.encode_and_digest(docs, path, public_tokenizers.PATTERN, with_ids=False)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    # A long where it fits one; ``deviation_exact`` holds it at any size.
    exact = F.col("deviation")
    return done.withColumn("deviation_exact", exact).withColumn("deviation", exact.try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_quality_classifier,
        op2_jaccard_join,
        op2_jaccard_links,
        op3_substring_dedup,
        op4_language_id,
        op5_line_dedup,
        op6_toxicity,
        op7_quality_rules,
        op8_bpe,
        op9_sharding,
        op10_decontamination,
        op11_hard_negatives,
        op12_topk_search,
        op13_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op2_jaccard_join": sql.JACCARD_LINKS,
    "op2_jaccard_links": sql.JACCARD_LINKS,
    "op3_substring_dedup": sql.SUBSTRINGS,
    "op5_line_dedup": sql.LINE_DEDUP,
    "op7_quality_rules": sql.QUALITY_RULES,
    "op11_hard_negatives": sql.HARD_NEGATIVES,
    "op12_topk_search": sql.TOP_K,
}
