"""Dictionary operators: buckets by prefix, letters, pages, navigation and anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import collate
from ..functions.text import anchor_base
from .order import placed

PAGE_SIZE = 500


def keyed(entries: DataFrame, language: str = "av") -> DataFrame:
    """Entries (ordinal, word) with tokens, prefix, letter and sort key."""
    found = entries.withColumn("tokens", collate.tokens(F.col("word"), language))
    found = found.withColumn("prefix", collate.prefix(F.col("tokens"))).withColumn("key", collate.sort_key(F.col("tokens"), language))
    return found.withColumn("letter", collate.letter(F.col("prefix"), language))


def letter_rank(letter: Column, language: str = "av") -> Column:
    return F.coalesce(collate.rank(letter, language), F.lit(collate.UNKNOWN))


def buckets(entries: DataFrame, language: str = "av") -> DataFrame:
    """(letter, prefix, prefix_key, entries): one row per bucket."""
    counts = keyed(entries, language).groupBy("letter", "prefix").agg(F.count("*").alias("entries"))
    return counts.withColumn("prefix_key", collate.sort_key(collate.tokens(F.col("prefix"), language), language))


def letters(entries: DataFrame, language: str = "av") -> DataFrame:
    """(letter, letter_rank, entries, buckets)."""
    return buckets(entries, language).groupBy("letter").agg(F.sum("entries").alias("entries"), F.count("*").alias("buckets")).withColumn("letter_rank", letter_rank(F.col("letter"), language))


def file_name(prefix: Column, page: Column) -> Column:
    return F.concat(prefix, F.when(page == 0, "").otherwise(F.concat(F.lit("-"), (page + 1).cast("string"))), F.lit(".html"))


def paged(entries: DataFrame, language: str = "av", page_size: int = PAGE_SIZE) -> DataFrame:
    """Entries with their place in the bucket, page and page file; a bucket of most entries is no single task."""
    found = placed(keyed(entries, language), ["prefix"], [F.col("key"), F.col("word"), F.col("ordinal")], "position")
    found = found.withColumn("position", (F.col("position") - 1).cast("int"))
    found = found.withColumn("page", F.floor(F.col("position") / page_size).cast("int"))
    return found.withColumn("file", file_name(F.col("prefix"), F.col("page")))


def pages(entries: DataFrame, language: str = "av", page_size: int = PAGE_SIZE) -> DataFrame:
    """(letter, prefix, page, file, on_page, in_bucket, page_count), from bucket counts alone."""
    b = buckets(entries, language).withColumn("page_count", F.ceil(F.col("entries") / page_size).cast("int"))
    p = b.select("letter", "prefix", "prefix_key", F.col("entries").alias("in_bucket"), "page_count", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1)).alias("page"))
    on_page = F.least(F.lit(page_size), F.col("in_bucket") - F.col("page") * page_size).cast("long")
    return p.withColumn("on_page", on_page).withColumn("file", file_name(F.col("prefix"), F.col("page")))


def navigation(entries: DataFrame, language: str = "av", page_size: int = PAGE_SIZE) -> DataFrame:
    """Pages with the previous and next file in the order of all pages.

    Only the table of pages, not of entries, is ordered as a whole."""
    p = pages(entries, language, page_size).withColumn("letter_rank", letter_rank(F.col("letter"), language))
    order = Window.orderBy("letter_rank", "letter", "prefix_key", "prefix", "page")
    return p.select("letter", "prefix", "page", "file", "on_page", "in_bucket", "page_count", F.lag("file").over(order).alias("prev_file"), F.lead("file").over(order).alias("next_file"))


def siblings(entries: DataFrame, language: str = "av") -> DataFrame:
    """(letter, prefixes): each letter's prefixes in order."""
    pairs = buckets(entries, language).groupBy("letter").agg(F.array_sort(F.collect_list(F.struct("prefix_key", "prefix"))).alias("s"))
    return pairs.select("letter", F.col("s.prefix").alias("prefixes"))


def alphabet(entries: DataFrame, language: str = "av") -> DataFrame:
    """One row: ``letters``, an array of (letter, entries) of the whole alphabet in order, those without
    entries too, and after it whatever else words begin with."""
    known = entries.sparkSession.createDataFrame([(x, k) for k, x in enumerate(collate.alphabet(language))], "letter string, letter_rank int")
    counts = letters(entries, language).select("letter", "entries")
    every = known.join(counts, "letter", "full_outer").select(F.coalesce("letter_rank", F.lit(collate.UNKNOWN)).alias("rank"), "letter", F.coalesce("entries", F.lit(0)).cast("long").alias("entries"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "letter", "entries"))), lambda x: F.struct(x["letter"].alias("letter"), x["entries"].alias("entries"))).alias("letters"))


def anchors(entries: DataFrame, language: str = "av", page_size: int = PAGE_SIZE) -> DataFrame:
    """Entries with an anchor that is unique on their page: the n-th equal one ends in -n."""
    found = paged(entries, language, page_size).withColumn("base", anchor_base(F.col("word")))
    nth = F.row_number().over(Window.partitionBy("prefix", "page", "base").orderBy("position"))
    return found.withColumn("nth", nth).withColumn("anchor", F.when(F.col("nth") == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), F.col("nth").cast("string")))).drop("nth")
