"""Continuous ingestion of entry files: normalised and keyed as they arrive (Structured Streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import collate
from ..functions.text import headword
from ..io.schemas import ENTRY


def entries(spark: SparkSession, folder: str, language: str = "av") -> DataFrame:
    """A stream of entries from JSONL files put into a folder, with word, prefix and letter."""
    parsed = spark.readStream.text(folder).where(F.trim("value") != "").select(F.col("value").alias("raw"), F.from_json("value", ENTRY, {"mode": "FAILFAST"}).alias("r"))
    word = headword(F.col("r.word"), F.col("r.phrase"))
    prefix = collate.prefix(collate.tokens(word, language))
    return parsed.select("raw", word.alias("word"), prefix.alias("prefix"), collate.letter(prefix, language).alias("letter"))


def bucket_counts(stream: DataFrame) -> DataFrame:
    """Running count of entries per prefix; state is one number per prefix."""
    return stream.groupBy("letter", "prefix").count()
