"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

language ID -> near duplicates (n-gram Jaccard) -> repeated passages (suffixes) -> benchmark
decontamination -> byte-level BPE.  All but the last return the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import byte_bpe, decontaminate, jaccard_join, language_id, suffix_dedup
from lexloom.llm.common import materialise, read


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: no letters, or no learned language says yes.

    Without labelled rows there is no model, and only those without letters go."""
    return language_id.keep_known(docs, language_id.train(docs), language_id.TOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by Jaccard >= 80/100 of 5-word shingles."""
    return jaccard_join.keep_first(docs, 5, 80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of more than 50 words, or of 400 bytes or more, that occurs elsewhere."""
    return suffix_dedup.strip(docs, 400, 51)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the benchmark's items cover beyond the limit."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), 13)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids of the text."""
    return byte_bpe.encode_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", identify_language), ("jaccard_join", drop_near_duplicates), ("suffix_dedup", cut_repeats), ("decontaminate", drop_contaminated), ("byte_bpe", encode)]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
