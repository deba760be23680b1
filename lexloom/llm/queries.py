"""The eleven queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, chat_format, chroma, decontaminate, interleave, jaccard_join, language_id, sstable, suffix_dedup, token_counts
from .common import materialise, read


def op1_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' bytes, read as 8-bit PCM, are the recordings."""
    return chroma.match(read(spark, sf_dir, "documents"), "text")


def op2_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.store_and_read(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in repeats of 400 go; repeated passages of more than 50 words are counted besides."""
    return suffix_dedup.digest(read(spark, sf_dir, "documents"), 400, words=51)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 13)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    formatted = materialise(chat_format.format_chats(turns.unionByName(extra)), "chats")
    return chat_format.read_chats(formatted)


def op6_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.interleave(read(spark, sf_dir, "documents"), 24)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(read(spark, sf_dir, "documents"))


def queries() -> dict:
    own = [op1_chroma, op2_sstable, op3_suffix_dedup, op4_decontaminate, op5_chat_format, op6_interleave, op7_language_id, op8_token_counts, op9_byte_bpe, op10_jaccard_join]
    import corpus_pipeline

    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": decontaminate.ORACLE, "op5_chat_format": chat_format.ORACLE, "op6_interleave": interleave.ORACLE, "op10_jaccard_join": jaccard_join.ORACLE}
