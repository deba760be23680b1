"""Corpus operators: chapters and their sentences.  Sentences: ordinal, chapter, SentenceNumber,
sentence, title, author, av, ru."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import missing, roman


def in_chapters(sentences: DataFrame) -> DataFrame:
    return sentences.where(F.col("chapter").isNotNull())


def display_number(number: Column, other: Column) -> Column:
    """The number shown: the first that is neither missing nor zero."""
    zero = F.lit(0)
    return F.coalesce(F.nullif(number, zero), F.nullif(other, zero), zero)


def numbered(sentences: DataFrame) -> DataFrame:
    """Sentences with their place in the chapter and the number shown."""
    order = Window.partitionBy("chapter").orderBy(F.coalesce("SentenceNumber", F.lit(0)), "ordinal")
    return in_chapters(sentences).withColumn("place", F.row_number().over(order)).withColumn("shown", display_number(F.col("SentenceNumber"), F.col("sentence")))


def numbers(sentences: DataFrame) -> DataFrame:
    """The chapters' numbers, one row each."""
    return in_chapters(sentences).select("chapter").distinct()


def chapters(sentences: DataFrame) -> DataFrame:
    """(chapter, sentences, title, author): title and author of the first sentence in order."""
    first = F.min_by(F.struct("title", "author"), F.struct(F.coalesce("SentenceNumber", F.lit(0)), F.col("ordinal")))
    found = in_chapters(sentences).groupBy("chapter").agg(F.count("*").alias("sentences"), first.alias("f"))
    return found.select("chapter", "sentences", F.coalesce(missing(F.col("f.title")), roman(F.col("chapter"))).alias("title"), F.coalesce("f.author", F.lit("")).alias("author"))


def navigation(sentences: DataFrame) -> DataFrame:
    """Chapters with the previous and next chapter; the ordered table is one row per chapter."""
    order = Window.orderBy("chapter")
    return chapters(sentences).withColumn("prev_chapter", F.lag("chapter").over(order)).withColumn("next_chapter", F.lead("chapter").over(order))


def stats(sentences: DataFrame) -> DataFrame:
    """(entries, chapters, pages): all sentences count as entries; the index is a page too."""
    return sentences.agg(F.count("*").alias("entries"), F.count_distinct("chapter").alias("chapters")).withColumn("pages", F.col("chapters") + 1)
