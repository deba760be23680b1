"""The whole build: every dataset of a registry to its folder of pages, with copies and a record."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.text import headword
from ..io import readers, writers
from ..operators import articles, catalog, corpus, dictionary, render

STATS = "id string, entries long, pages long, stats_unit string"


@dataclass(frozen=True)
class Made:
    """What one dataset becomes: its pages (path, html) and its counts (entries, pages)."""

    pages: DataFrame
    counts: DataFrame
    unit: str | None = None


def _dictionary(data: DataFrame, row: Row, site: str) -> Made:
    language = row["language_from"] or "av"
    entries = data.select("ordinal", "raw", headword(F.col("word"), F.col("phrase")).alias("word")).withColumn("raw", render.pretty_json("raw"))
    pages = render.dictionary_pages(entries, language, site=site, dataset=row["id"]).unionByName(render.dictionary_index(entries, language))
    counts = dictionary.pages(entries, language).agg(F.coalesce(F.sum("on_page"), F.lit(0)).alias("entries"), (F.count("*") + 1).alias("pages"))
    return Made(pages, counts)


def _corpus(data: DataFrame, row: Row, site: str) -> Made:
    alone = bool(row["monolingual"]) or row["language_from"] == row["language_to"]
    pages = render.chapter_pages(data, alone, site, row["id"]).unionByName(render.corpus_index(data, alone))
    return Made(pages, corpus.stats(data).select("entries", "pages"), "предложений")


def _articles(data: DataFrame, row: Row, site: str) -> Made:
    pages = render.article_pages(data, site, row["id"]).unionByName(render.article_index(data)).unionByName(render.archive_index(data))
    counts = articles.years(data).agg(F.coalesce(F.sum("articles"), F.lit(0)).alias("entries"), F.count("*").alias("years"))
    return Made(pages, counts.select("entries", (F.col("entries") + F.col("years") + 1).alias("pages")))


BUILDERS = {"dictionary": _dictionary, "corpus": _corpus, "articles": _articles}


def make(spark: SparkSession, row: Row, root: str, site: str = "") -> Made:
    """Dispatch on the registry row's kind; an unknown or missing one is a dictionary."""
    kind = row["kind"] if row["kind"] in BUILDERS else "dictionary"
    return BUILDERS[kind](readers.read_source(spark, kind, row["format"], f"{root}/{row['data_path']}"), row, site)


def build(spark: SparkSession, root: str, out: str, registry_file: str = "registry.json", site: str = "") -> dict[str, tuple[int, int]]:
    """Build everything under ``root`` into ``out``, which is emptied first; (entries, pages) by dataset.

    The registry is one small row per dataset, so the loop over it runs on the driver; each dataset's
    pages are made and written by the executors.  A missing data file aborts the build before the
    output is touched; a missing attachment only warns."""
    registry = readers.catalog(spark, f"{root}/{registry_file}")
    rows = registry.orderBy("source_order").collect()
    lost = [r["data_path"] for r in rows if not writers.exists(spark, f"{root}/{r['data_path']}")]
    if lost:
        raise FileNotFoundError(f"missing: {', '.join(map(str, lost))}")
    writers.clear(spark, out)
    writers.copy_file(spark, f"{root}/{registry_file}", f"{out}/{registry_file}")
    counted = []
    for row in rows:
        made = make(spark, row, root, site)
        writers.write_files(made.pages.withColumn("path", F.concat(F.lit(f"{row['site_path'] or row['id']}/"), "path")), out)
        writers.copy_file(spark, f"{root}/{row['data_path']}", f"{out}/{row['data_path']}")
        n = made.counts.first()
        counted.append((row["id"], n["entries"], n["pages"], made.unit))
    links = registry.select("source_order", F.posexplode("documents").alias("n", "d")).select("source_order", "n", F.col("d.path").alias("path"))
    for r in catalog.first_per_path(links).orderBy("source_order", "n").collect():
        if not writers.copy_file(spark, f"{root}/{r['path']}", f"{out}/{r['path']}", must_exist=False):
            warnings.warn(f"no such attachment: {r['path']}", stacklevel=2)
    stats = spark.createDataFrame(counted, STATS)
    index = render.catalog_page(catalog.with_stats(registry, stats))
    record = spark.createDataFrame([("build.json", writers.build_record(stats.select("id", "entries", "pages")))], "path string, html string")
    writers.write_files(index.unionByName(record), out)
    writers.check_written(stats)
    return {name: (entries, pages) for name, entries, pages, _ in counted}
