"""Operator 2: sorted-string-table shards of token ids.

A shard is one immutable file: data blocks, block index, Bloom filter, footer.
  block   = zstd of entries; an entry is varint(shared prefix), varint(rest of key), varint(value
            bytes), the rest of the key, the value.  The shared prefix restarts in every block.
  value   = little-endian ids, two bytes each where the vocabulary allows it, else four.
  index   = zstd of one entry per block: varint(length of last key), last key, varint(offset),
            varint(bytes).
  Bloom   = bits for k probes of xxh3_128 of each key.
  footer  = fixed size, little-endian: offsets and sizes of index and Bloom filter, probes, id
            width, rows, ids, crc32 of all that stands before it, magic.
A lookup reads the footer, asks the Bloom filter, searches the block index by bisection and scans
one block.  Keys are document ids as eight big-endian bytes with the sign bit turned, so byte order
is numeric order; a null id has the empty key and comes first; equal ids stay side by side, ordered
by text.

Spark deals the rows out by range of the key (one shuffle), sorts each range and writes one or
more shards per task, each of bounded size, through a temporary name and a rename: a lost task is
simply run again.  The manifest has one row per shard.

Defined cases: null and empty texts have no ids but the end id; repeated rows are stored once per
row; other columns are ignored; an empty table gives no shard and an empty result."""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WordCache, batch, filesystem, fresh_path, materialise, small_batches, worker_own
from .pretokens import rules
from .token_counts import byte_chars, load_tokenizer

MAGIC = b"LXSST\x00\x01\n"
FOOTER = struct.Struct("<QQQQIIQQI8s")
_SEPARATORS = re.compile("[\x1c-\x1f]")
BLOCK_BYTES, SHARD_BYTES, BLOOM_BITS, BLOOM_PROBES = 32 << 10, 32 << 20, 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & (2**64 - 1))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _take(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int, k: int) -> list[int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (2**64 - 1), h >> 64 | 1
    return [(a + i * b) % bits for i in range(k)]


class Writer:
    """Builds one shard in memory, bounded by the caller's SHARD_BYTES, from ascending keys."""

    def __init__(self, width: int):
        self.width, self.rows, self.ids = width, 0, 0
        self.out, self.index, self.keys = bytearray(), bytearray(), []
        self.block, self.last = bytearray(), b""

    def add(self, key: bytes, value: bytes) -> None:
        if self.keys and key < self.keys[-1]:
            raise ValueError("keys must ascend")
        same = 0
        if self.block:
            while same < min(len(key), len(self.last)) and key[same] == self.last[same]:
                same += 1
        self.block += _varint(same) + _varint(len(key) - same) + _varint(len(value)) + key[same:] + value
        self.last = key
        self.keys.append(key)
        self.rows += 1
        self.ids += len(value) // self.width
        if len(self.block) >= BLOCK_BYTES:
            self.close_block()

    def close_block(self) -> None:
        if self.block:
            import zstandard

            packed = zstandard.ZstdCompressor(level=1).compress(bytes(self.block))
            self.index += _varint(len(self.last)) + self.last + _varint(len(self.out)) + _varint(len(packed))
            self.out += packed
            self.block, self.last = bytearray(), b""

    def finish(self) -> bytes:
        import zstandard

        self.close_block()
        index_at = len(self.out)
        self.out += zstandard.ZstdCompressor(level=1).compress(bytes(self.index))
        bloom_at, bits = len(self.out), max(64, BLOOM_BITS * self.rows)
        bloom = bytearray(-(-bits // 8))
        for k in self.keys:
            for p in _probes(k, bits, BLOOM_PROBES):
                bloom[p >> 3] |= 1 << (p & 7)
        self.out += bloom
        self.out += FOOTER.pack(index_at, bloom_at - index_at, bloom_at, bits, BLOOM_PROBES, self.width, self.rows, self.ids, zlib.crc32(self.out), MAGIC)
        return bytes(self.out)


class Reader:
    """Reads a shard by its parts: footer, index and Bloom filter at once, blocks on demand."""

    def __init__(self, uri: str):
        import zstandard

        fs, path = filesystem(uri)
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.file = fs.open_input_file(path)
        size = self.file.size()
        index_at, index_size, bloom_at, self.bits, self.k, self.width, self.rows, self.ids, self.crc, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a shard: {uri}")
        self.body = size - FOOTER.size
        self.bloom = self._at(bloom_at, -(-self.bits // 8))
        index = self.unpack(self._at(index_at, index_size)) if index_size else b""
        self.last_keys, self.blocks, at = [], [], 0
        while at < len(index):
            n, at = _take(index, at)
            self.last_keys.append(index[at : at + n])
            offset, at = _take(index, at + n)
            length, at = _take(index, at)
            self.blocks.append((offset, length))

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def verify(self) -> bool:
        return zlib.crc32(self._at(0, self.body)) == self.crc

    def entries(self, block: int) -> Iterator[tuple[bytes, bytes]]:
        data, at, key = self.unpack(self._at(*self.blocks[block])), 0, b""
        while at < len(data):
            same, at = _take(data, at)
            rest, at = _take(data, at)
            n, at = _take(data, at)
            key = key[:same] + data[at : at + rest]
            at += rest
            yield key, data[at : at + n]
            at += n

    def scan(self) -> Iterator[tuple[bytes, bytes]]:
        for b in range(len(self.blocks)):
            yield from self.entries(b)

    def lookup(self, doc_id: int | None) -> list[list[int]]:
        """Ids of every row stored under the key."""
        key = key_of(doc_id)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits, self.k)):
            return []
        found = []
        for b in range(bisect_left(self.last_keys, key), len(self.blocks)):
            hits = [v for k, v in self.entries(b) if k == key]
            found += hits
            if not hits or self.last_keys[b] > key:
                break
        return [np.frombuffer(v, f"<u{self.width}").tolist() for v in found]

    def close(self) -> None:
        self.file.close()


#: Words of printable ASCII and accented Latin letters: nothing in them composes or folds unusually.
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: The vocabulary's pre-token pattern for such words in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

#: Fixed value: the rules of a tokenizer file under which white-space-separated words encode alone.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "dropout": None,
}


class WordIds:
    """Token ids of whole texts, by cached white-space-separated words.

    The vocabulary's normaliser turns white space into spaces and the pre-tokens never cross them,
    so words encode alone as in the text.  Plain words are cut into their pre-tokens here and the
    library's model merges each; all other words go through the library's whole pipeline.  A text
    with a special string, or with one of the four control signs that Python alone counts as white
    space, goes to the library whole, and so does every text if the file has other rules."""

    def __init__(self, path: str):
        self.tok = load_tokenizer(path)
        self.model = self.tok.model
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.proven = rules(path) == RULES
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        chars = {b: c for c, b in byte_chars().items()}
        self.bytes = {i: "".join(chars[b] for b in chr(i).encode()) for i in range(0x21, 0x100)}
        self.parts = WordCache(lambda parts: [self.packed([t.id for t in self.model.tokenize(p.translate(self.bytes))]) for p in parts])
        self.words = WordCache(self.fill)

    def packed(self, ids: list[int]) -> bytes:
        data = array(self.code, ids)
        if sys.byteorder == "big":
            data.byteswap()
        return data.tobytes()

    def fill(self, words: list[str]) -> list[bytes]:
        plain = [_PARTS.findall(w.lower()) if _PLAIN.fullmatch(w) else None for w in words]
        every = list({p for parts in plain if parts for p in parts})
        known = dict(zip(every, self.parts.of(every), strict=True))
        other = iter(self.tok.encode_batch_fast([w for w, p in zip(words, plain, strict=True) if p is None], add_special_tokens=False))
        return [b"".join(map(known.__getitem__, p)) if p is not None else self.packed(next(other).ids) for p in plain]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian bytes of the format's width."""
        if not self.proven or any(s in text for s in self.special) or _SEPARATORS.search(text):
            return self.packed(self.tok.encode(text, add_special_tokens=False).ids)
        return b"".join(self.words.of(text.split()))


def encoder(path: str) -> WordIds:
    return worker_own(("word ids", path), lambda: WordIds(path))


MANIFEST = pa.schema([("path", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("rows", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards; the manifest (path, low, high, rows, ids, bytes), read from its own table."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        import uuid

        own = encoder(tokenizer)
        end = np.array([end_id], f"<u{own.width}").tobytes()
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        writer, first = Writer(own.width), None

        def close():
            data = writer.finish()
            name = f"{uuid.uuid4().hex}.sst"  # a task that runs again writes new files; only the manifest counts
            with fs.open_output_stream(f"{base}/.{name}") as f:
                f.write(data)
            fs.move(f"{base}/.{name}", f"{base}/{name}")
            return batch(MANIFEST, path=[f"{folder}/{name}"], low=[first], high=[id_of(writer.keys[-1])], rows=[writer.rows], ids=[writer.ids], bytes=[len(data)])

        size = 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if writer.rows == 0:
                    first = doc_id
                value = own.encode(text or "") + end
                writer.add(key_of(doc_id), value)
                size += len(value) + 9
                if size >= shard_bytes:
                    yield close()
                    writer, size = Writer(own.width), 0
        if writer.rows:
            yield close()

    return materialise(dealt.mapInArrow(run, "path string, low long, high long, rows long, ids long, bytes long"), "sst-manifest")


def read_shards(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: start counts all ids before the row.

    The running sum over the manifest sees one row per shard of many megabytes."""
    small_batches(spark)
    order = Window.orderBy(F.col("low").asc_nulls_first(), F.col("high").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = manifest.select("path", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before")).repartition(n, "path")
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("before").to_pylist(), strict=True):
                shard = Reader(path)
                kind = f"<u{shard.width}"
                for block in range(len(shard.blocks)):
                    rows = []
                    for key, value in shard.entries(block):
                        ids = np.frombuffer(value, kind)
                        rows.append((id_of(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    doc, at, size, crc = zip(*rows, strict=True)
                    yield batch(out, doc_id=doc, start=at, n_tokens=size, ids_crc32=crc)
                shard.close()

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, tokenizer, fresh_path(spark, "sst"), end_id))
