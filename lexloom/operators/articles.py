"""Article operators: global order, years, neighbours, unique file names.

Articles: ordinal, slug, title, date (text), text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import date_key, missing, slug_base
from .order import placed, ranged, tasks

#: Newest first, then slug downwards; equal ones keep the file's order.
ORDER = [F.desc, F.desc, F.asc]


def ordered_columns() -> list:
    return [F.coalesce("date", F.lit("")).desc(), F.coalesce("slug", F.lit("")).desc(), F.col("ordinal").asc()]


def with_year(articles: DataFrame) -> DataFrame:
    return articles.withColumn("year", date_key(F.col("date"), 4))


def years(articles: DataFrame) -> DataFrame:
    """(year, articles, prev_year, next_year): the previous year is the newer one."""
    counts = with_year(articles).groupBy("year").agg(F.count("*").alias("articles"))
    order = Window.orderBy(F.desc("year"))
    return counts.withColumn("prev_year", F.lag("year").over(order)).withColumn("next_year", F.lead("year").over(order))


def span(articles: DataFrame) -> DataFrame:
    """(first_date, last_date, articles): articles without a date have no part in the span."""
    dated = missing(F.col("date"))
    return articles.agg(F.min(dated).alias("first_date"), F.max(dated).alias("last_date"), F.count("*").alias("articles"))


def neighbours(articles: DataFrame, name: str = "slug") -> DataFrame:
    """Articles with their global place and the names before and after, across years.

    Rows are ranged by the whole order and numbered inside each range, so articles without a date are
    spread like others; only the table of ranges (its counts, first and last names) is ordered as a whole."""
    rows = ranged(articles, ordered_columns())
    inside, named = Window.partitionBy("_range").orderBy(*ordered_columns()), F.col(name)
    rows = rows.withColumn("_n", F.row_number().over(inside)).withColumn("_before", F.lag(named).over(inside)).withColumn("_after", F.lead(named).over(inside))
    ends = rows.groupBy("_range").agg(F.count("*").alias("_rows"), F.min_by(name, "_n").alias("_first"), F.max_by(name, "_n").alias("_last"))
    across = Window.orderBy("_range")
    ends = ends.select("_range", "_rows", (F.sum("_rows").over(across) - F.col("_rows")).alias("_skip"), F.lag("_last").over(across).alias("_prev"), F.lead("_first").over(across).alias("_next"))
    out = rows.join(F.broadcast(ends), "_range")  # one row a range
    return out.select(*articles.columns, (F.col("_skip") + F.col("_n")).alias("place"), F.coalesce("_before", F.when(F.col("_n") == 1, F.col("_prev"))).alias("prev_name"), F.coalesce("_after", F.when(F.col("_n") == F.col("_rows"), F.col("_next"))).alias("next_name"))


def entangled(based: DataFrame) -> DataFrame:
    """(base): names that can take another's numbered name: x and x-2, if both are there."""
    bases = based.select("base").distinct()
    pairs = bases.select(F.col("base").alias("child"), F.regexp_replace("base", r"-\d+$", "").alias("base")).where("child != base").join(bases, "base")
    return pairs.select(F.explode(F.array("base", "child")).alias("base")).distinct()


def file_names(articles: DataFrame) -> DataFrame:
    """(ordinal, file): names in the global order; a taken name gets the first free number from 2.

    The n-th article of a name gets number n, from its place among them.  Only names that meet another
    one's numbers are streamed: families of them (the base without trailing numbers) are dealt out and
    sorted, and a task holds the names of one such family at a time."""
    based = articles.withColumn("base", slug_base(F.col("slug")))
    meeting = entangled(based)
    plain = placed(based.join(meeting, "base", "left_anti"), ["base"], ordered_columns(), "_nth")
    named = plain.select(F.col("ordinal").cast("long").alias("ordinal"), F.concat("base", F.when(F.col("_nth") == 1, "").otherwise(F.concat(F.lit("-"), F.col("_nth").cast("string")))).alias("file"))
    rest = based.join(meeting, "base", "left_semi").withColumn("family", F.regexp_replace("base", r"(-\d+)+$", ""))
    return named.unionByName(streamed_names(rest))


def streamed_names(based: DataFrame) -> DataFrame:
    dealt = based.repartition(tasks(based.sparkSession), "family").sortWithinPartitions("family", *ordered_columns()).select("ordinal", "family", "base")
    out = pa.schema([("ordinal", pa.int64()), ("file", pa.string())])

    def run(batches):
        family, taken, following = None, set(), {}
        for b in batches:
            names = []
            for own, base in zip(b.column("family").to_pylist(), b.column("base").to_pylist(), strict=True):
                if own != family:
                    family, taken, following = own, set(), {}
                name, n = base, following.get(base, 2)
                while name in taken:
                    name, n = f"{base}-{n}", n + 1
                following[base] = n
                taken.add(name)
                names.append(name)
            yield pa.RecordBatch.from_arrays([b.column("ordinal").cast(pa.int64()), pa.array(names, pa.string())], schema=out)

    return dealt.mapInArrow(run, "ordinal long, file string")
