"""From documents to tokens: reject poor texts, drop common lines, near duplicates and test items, encode the rest."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldledger.llm import bpe_replay, decontamination, jaccard_join, line_dedup, quality_cnn
from fieldledger.llm.queries import VOCABULARY
from fieldledger.llm.store import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_cnn.keep_good(docs, quality_cnn.train(docs, labels))


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many hold. A null text stays null; ``n_chars`` follows the text."""
    cut = line_dedup.cut_lines(docs)
    before = F.col("row").getField("text")
    now = {"text": F.when(before.isNull(), F.lit(None).cast("string")).otherwise(F.col("kept_text"))}
    if "n_chars" in docs.columns:
        own = F.col("row").getField("n_chars")
        now["n_chars"] = F.when(F.col("n_dropped") == 0, own).otherwise(F.char_length("kept_text").cast("long"))
    return cut.select(*[now.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return jaccard_join.drop_near_duplicates(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and their digests."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe_replay.encode_and_digest(docs, path, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", without_common_lines),
    ("n-gram Jaccard join", without_near_duplicates),
    ("benchmark decontamination", without_test_items),
    ("byte-level BPE", tokens),
]

# A trained classifier and a tokenizer are no SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
