"""Registry operators: dataset flags, statistics, links, downloads, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import kind_label, missing


def is_monolingual(flag: Column, language_from: Column, language_to: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) | language_from.eqNullSafe(language_to)


def pipeline_of(kind: Column) -> Column:
    """The pipeline that builds a dataset; unknown and missing kinds are dictionaries."""
    return F.when(kind.isin("corpus", "articles"), kind).otherwise("dictionary")


def with_stats(registry: DataFrame, stats: DataFrame) -> DataFrame:
    """Datasets with counts (0 if there are none) and the unit shown."""
    joined = registry.join(stats, "id", "left")
    return joined.withColumn("entries", F.coalesce("entries", F.lit(0))).withColumn("pages", F.coalesce("pages", F.lit(0))).withColumn("unit", F.coalesce("stats_unit", "unit", F.lit("статей"))).withColumn("status", F.coalesce(missing(F.col("status")), F.lit("stable"))).drop("stats_unit")


def document_links(registry: DataFrame) -> DataFrame:
    """(id, n, title, kind, path): one row per attached document, in order; none gives one null row."""
    d = registry.select("id", F.posexplode_outer("documents").alias("n", "d"))
    return d.select("id", "n", F.col("d.title").alias("title"), F.when(F.col("d").isNotNull(), kind_label(F.col("d.kind"))).alias("kind"), F.col("d.path").alias("path"))


def first_per_path(links: DataFrame) -> DataFrame:
    """Documents to copy: the first link of every path."""
    order = Window.partitionBy("path").orderBy("source_order", "n")
    return links.where("path is not null").withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def downloads(registry: DataFrame, catalog: str = "catalog.json") -> DataFrame:
    """(part, ordinal, path): the catalog file, then data files, then distinct documents."""
    spark = registry.sparkSession
    top = spark.createDataFrame([(0, 0, catalog)], "part int, ordinal long, path string")
    data = registry.where("data_path is not null").select(F.lit(1).alias("part"), F.col("source_order").cast("long").alias("ordinal"), F.col("data_path").alias("path"))
    docs = first_per_path(registry.select("source_order", F.posexplode("documents").alias("n", "d")).select("source_order", "n", "d.path"))
    return top.unionByName(data).unionByName(docs.select(F.lit(2).alias("part"), (F.col("source_order") * 1000 + F.col("n")).cast("long").alias("ordinal"), "path"))


def totals(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count("*").alias("datasets"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))


def missing_files(wanted: DataFrame, present: DataFrame, on: str = "path") -> DataFrame:
    """Wanted files that are not there."""
    return wanted.join(present.select(on).distinct(), on, "left_anti")
