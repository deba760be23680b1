"""Readers of the registry and of the datasets it lists.

Every record keeps its untouched line (``raw``) and an ``ordinal`` that orders records as in the
files: by the file's path, then the position in it.  A malformed record aborts the read."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import collapse_blank_lines, palochka
from . import schemas


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, raw): the lines of the files, numbered from 0 in the order of paths and places.

    A scan deals out its splits by size, so a split's rows are in order but the splits are not.  Each
    split is counted, and only the table of splits is ordered as a whole; no line is shuffled."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_block", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return lines.join(splits, ["_file", "_block"]).select((F.col("_id") + F.col("_shift")).alias("ordinal"), "raw")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record per line; blank lines are skipped; a malformed line aborts the read."""
    lines = numbered_lines(spark, path).where(F.trim("raw") != "")
    return lines.select("ordinal", "raw", F.from_json("raw", schema, {"mode": "FAILFAST"}).alias("r")).select("ordinal", "raw", "r.*")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of a JSON array file, in order; any other root is an error."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("_file"))
    root = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.raise_error(F.lit("the root of a corpus file is not a list")))
    items = whole.select(F.from_json(root, f"array<struct<{_as_struct(schema)}>>", {"mode": "FAILFAST"}).alias("items"), "_file")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    skips = items.select("_file", F.coalesce(F.sum(F.size("items")).over(before), F.lit(0)).alias("_skip"))  # one row per file
    placed = items.select("_file", F.posexplode("items").alias("place", "r")).join(skips, "_file")
    return placed.select((F.col("_skip") + F.col("place")).cast("long").alias("ordinal"), "r.*")


def _as_struct(schema: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in T._parse_datatype_string(schema).fields)


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """The registry's datasets with their order."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", f"sources array<struct<{_as_struct(schemas.SOURCE)}>>", {"mode": "FAILFAST"}).alias("c"))
    return parsed.select(F.posexplode("c.sources").alias("source_order", "s")).select("source_order", "s.*")


def read_source(spark: SparkSession, kind: str | None, fmt: str | None, path: str) -> DataFrame:
    """Dispatch on kind and format; an unknown kind is a dictionary."""
    schema = schemas.KINDS.get(kind or "dictionary", schemas.ENTRY)
    return json_array(spark, path, schema) if fmt == "json" else jsonl(spark, path, schema)


def docx_paragraphs(data: bytes) -> str:
    """Text of a DOCX file, one line per paragraph."""
    xml = zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml").decode()
    out = []
    for block in re.findall(r"<w:p[ >].*?</w:p>|<w:p/>", xml, re.S):
        runs = re.findall(r"<w:t(?: [^>]*)?>([^<]*)</w:t>|(<w:tab/>)|(<w:br/>)", block)
        text = "".join(t or ("\t" if tab else "\n") for t, tab, _ in runs)
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            text = text.replace(entity, char)
        out.append(text)
    return "\n".join(out)


def books(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of book files: DOCX is unpacked, anything else is read as extracted text; then
    letters are normalised and blank lines collapsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                data = data.as_py()
                text = docx_paragraphs(data) if name.lower().endswith(".docx") else data.decode("utf-8", "replace")
                yield pa.RecordBatch.from_pydict({"path": pa.array([name]), "text": pa.array([text])})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, text string").select("path", collapse_blank_lines(palochka(F.col("text"))).alias("text"))


def book_records(files: DataFrame, metadata: DataFrame, folder: str = "books") -> DataFrame:
    """One article record per described book, newest first, ordered by ``ordinal``.

    metadata: file, slug, title, author, editor, date, categories and ordinal.  A described book whose
    file is not there aborts the read before anything is written; other files are ignored.  Books of
    one date keep the metadata's order; the ordered table is one row per book."""
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).select("file", "text")
    require_all(metadata, named, "file")
    order = Window.orderBy(F.desc("date"), F.asc("ordinal"))
    found = metadata.join(named, "file").withColumn("ordinal", F.row_number().over(order) - 1)
    return found.select("ordinal", "slug", "title", "author", "date", "categories", F.concat(F.lit(f"{folder}/"), F.col("file")).alias("book_path"), "text", F.nullif(F.col("editor"), F.lit("")).alias("editor"))


def require_all(wanted: DataFrame, present: DataFrame, on: str = "path") -> None:
    """Raise, before anything is written, if a wanted file is not there."""
    lost = [r[0] for r in wanted.join(present.select(on).distinct(), on, "left_anti").select(on).limit(20).collect()]
    if lost:
        raise FileNotFoundError(f"missing: {', '.join(map(str, lost))}")
