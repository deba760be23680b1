"""Sinks: JSON lines, exact-named files, plain copies, the build record."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, characters unescaped, null fields left out; the folder is replaced."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_files(rendered: DataFrame, folder: str) -> None:
    """One file per row (path, html) under the folder, written by the executors; any file system."""
    def run(rows):
        from pyarrow import fs

        base = folder if ":" in folder.split("/")[0] else f"file://{folder}"
        store, root = (fs.LocalFileSystem(), "/" + base.removeprefix("file:").lstrip("/")) if base.startswith("file:") else fs.FileSystem.from_uri(base)
        for r in rows:
            target = f"{root}/{r['path']}"
            store.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(target) as f:
                f.write(r["html"].encode())

    rendered.select("path", "html").foreachPartition(run)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def clear(spark: SparkSession, folder: str) -> None:
    p, fs = _hadoop(spark, folder)
    fs.delete(p, True)
    fs.mkdirs(p)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def copy_file(spark: SparkSession, source: str, target: str, must_exist: bool = True) -> bool:
    """Byte copy.  A missing file raises, or is reported by False where it may be missing."""
    a, from_fs = _hadoop(spark, source)
    b, to_fs = _hadoop(spark, target)
    if not from_fs.exists(a):
        if must_exist:
            raise FileNotFoundError(source)
        return False
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, a, to_fs, b, False, spark._jsc.hadoopConfiguration())


def build_record(stats: DataFrame) -> str:
    """JSON of the build time and each source's counts (one small row per source)."""
    rows = {r["id"]: {k: v for k, v in r.asDict().items() if k != "id"} for r in stats.orderBy("id").collect()}
    now = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    return json.dumps({"built_at": now, "stats": rows}, indent=2, ensure_ascii=False)


def check_written(df: DataFrame) -> None:
    if df.select(F.lit(1)).limit(1).count() == 0:
        raise RuntimeError("nothing was written")
