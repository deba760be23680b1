"""Dataset diff: entries added, removed and changed between two versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def entry_diff(old: DataFrame, new: DataFrame, keys: list[str], text: str = "text", examples: str = "examples") -> DataFrame:
    """keys, change (added/removed/changed), old_text, new_text, gained and lost examples.

    One full outer join on the keys; unchanged entries do not appear."""
    a = old.select(*keys, F.lit(1).alias("_o"), F.col(text).alias("old_text"), F.coalesce(examples, F.array().cast("array<string>")).alias("_oe"))
    b = new.select(*keys, F.lit(1).alias("_n"), F.col(text).alias("new_text"), F.coalesce(examples, F.array().cast("array<string>")).alias("_ne"))
    none = F.array().cast("array<string>")
    both = a.join(b, keys, "full_outer").withColumn("_oe", F.coalesce("_oe", none)).withColumn("_ne", F.coalesce("_ne", none))
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("changed")
    differs = F.col("_o").isNull() | F.col("_n").isNull() | ~F.col("old_text").eqNullSafe(F.col("new_text")) | (F.col("_oe") != F.col("_ne"))
    return both.where(differs).select(*keys, change.alias("change"), "old_text", "new_text", F.size("_oe").alias("old_examples"), F.size("_ne").alias("new_examples"), F.array_join(F.array_sort(F.array_except("_ne", "_oe")), "\n").alias("gained"), F.array_join(F.array_sort(F.array_except("_oe", "_ne")), "\n").alias("lost"))


def in_turn(entries: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Entries with ``turn``, their place among those of the same key: repeated headwords pair off in order."""
    return entries.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def sense_lines(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the lines of a change log: one for each sense that differs, ``text[i]: old -> new``,
    after ``senses: n -> m`` where their number differs.  old and new: keys, senses (array of text)."""
    none = F.array().cast("array<string>")
    both = old.select(*keys, F.coalesce("senses", none).alias("_a")).join(new.select(*keys, F.coalesce("senses", none).alias("_b")), keys)
    size = F.greatest(F.size("_a"), F.size("_b"))

    def line(i):
        a, b = F.get("_a", i), F.get("_b", i)
        return F.when(~a.eqNullSafe(b), F.concat(F.lit("text["), i.cast("string"), F.lit("]: "), F.coalesce(a, F.lit("")), F.lit(" -> "), F.coalesce(b, F.lit(""))))

    each = F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), line)).otherwise(none)
    count = F.when(F.size("_a") != F.size("_b"), F.array(F.concat(F.lit("senses: "), F.size("_a").cast("string"), F.lit(" -> "), F.size("_b").cast("string")))).otherwise(none)
    return both.select(*keys, F.concat(count, F.filter(each, lambda x: x.isNotNull())).alias("lines")).where(F.size("lines") > 0)


def notation(diff: DataFrame) -> DataFrame:
    """Changes as one line each, in the notation of a change log."""
    line = F.when(F.col("change") == "changed", F.concat(F.lit("text: "), F.coalesce("old_text", F.lit("")), F.lit(" -> "), F.coalesce("new_text", F.lit("")))).otherwise(F.coalesce("new_text", "old_text", F.lit("")))
    return diff.withColumn("line", F.concat(F.when(F.col("change") == "added", "+ ").when(F.col("change") == "removed", "- ").otherwise("~ "), line))
