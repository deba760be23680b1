"""Shared plumbing of the training-data operators: table reading, the shared work folder,
materialised tables, filesystem access that works for any store, and a worker-side word cache."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch.  Whole texts travel in these batches, so the number is small.
ARROW_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir, which every executor can reach.

    Where it is unset, a folder of our own if driver and executors are one process; else an error."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^-]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='lexloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
        context.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


_SCRATCH: ContextVar[tuple[list[Callable[[], object]], ...]] = ContextVar("scratch", default=())


def delete_path(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def at_end(undo: Callable[[], object], outer: bool = False) -> None:
    """Have this called when the scratch ends that we are in, or the one around it, if any."""
    if found := _SCRATCH.get()[: -1 if outer else None]:
        found[-1].append(undo)


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes the tables materialised inside when it ends; those to keep go with the scratch around it.

    Nothing that is read from them may leave unless it was materialised with ``keep``."""
    undone: list[Callable[[], object]] = []
    token = _SCRATCH.set((*_SCRATCH.get(), undone))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for undo in undone:
            undo()


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    at_end(lambda: delete_path(spark, path), keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that may be broadcast; tables beyond it are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def members(df: DataFrame, wanted: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """The rows of df whose keys are in a materialised table: broadcast if it has few rows.

    Beyond that both sides are plain shuffles, so adaptive execution can split a hot key."""
    return df.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, keys, how)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: str = "16m") -> None:
    """Bound the Arrow batches of this session by rows and by bytes; read when a plan is made."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) for file:, hdfs:, s3: or gs: URIs; works in any executor."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


class WordCache:
    """Bounded memo from a piece of text to its encoding, kept by a Python worker between batches.

    ``fill`` gets a list of unseen pieces and returns their values in order.  When the memo is full
    the half learnt first stays (frequent words come early), and pieces of over ``longest`` signs are
    never remembered, so memory is bounded; results never depend on what is remembered."""

    def __init__(self, fill: Callable[[list], Iterable], limit: int = 600_000, longest: int = 1000):
        self.fill, self.limit, self.longest, self.known = fill, limit, longest, {}

    def learn(self, missing: list) -> dict:
        values = dict(zip(missing, self.fill(missing), strict=True))
        if len(self.known) + len(values) > self.limit:
            self.known = dict(islice(self.known.items(), self.limit // 2))
        if len(self.known) + len(values) <= self.limit:
            self.known.update(values if max(map(len, values), default=0) <= self.longest else {k: v for k, v in values.items() if len(k) <= self.longest})
        return values

    def of(self, wanted: list) -> list:
        """The values of the wanted pieces, in order."""
        found = list(map(self.known.get, wanted))
        if None in found:
            at = [i for i, x in enumerate(found) if x is None]
            values = self.learn(list({wanted[i] for i in at}))
            for i in at:
                found[i] = values[wanted[i]]
        return found


_OWN: dict[tuple, object] = {}


def worker_own(key: tuple, make: Callable[[], object]):
    """The worker's own tool with its memo.  It lives as long as the worker works for one operator:
    the next operator's tool takes its place, so memos of several stages never add up."""
    if key not in _OWN:
        _OWN.clear()
        _OWN[key] = make()
    return _OWN[key]


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def groups_of_bytes(texts: list, limit: int) -> Iterable[tuple[int, int]]:
    """Slices [lo, hi) of the list with about ``limit`` characters each; one long text stands alone."""
    lo = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(x)
    if lo < len(texts):
        yield lo, len(texts)
