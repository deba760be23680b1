"""Operator 3: exact duplicate passages by distributed prefix doubling over sampled positions.

Wanted: every unit (byte or word) that lies in a window of ``length`` units which also starts
anywhere else.

The classic algorithm gives every position the rank of the first k units that start there, pairs the
rank at i with the rank at i + k, sorts the pairs and ranks again, until ranks are unique or k passes
the threshold.  Here the same rounds run on few positions:

* Positions.  A gram is an anchor if it is least, by hash, in some stretch of ``_stretch``
  neighbouring grams.  Equal strings have equal anchors in their middle, so every window is dealt to
  the anchor nearest its centre, and equal windows are dealt alike.  What all windows of an anchor
  share is its core (274 of 400 bytes, 35 of 51 words); the position is where the core starts.
* Ranks are names: equal for equal content, 64-bit, made where the text lies.  They need no order
  beyond equality, so Spark's shuffle of the position-rank pairs is the sort, and a group is a rank.
* Rounds at growing offsets: k is half a core; then the pair (rank at i, rank at i + k), the whole
  core; then the pair (rank of the core, rank of its extension by all that the anchor's windows
  cover); for bytes then groups of ``step`` neighbouring windows; then single windows.  After every
  round a position whose rank is unique is done: none of its windows repeats.  A rank past the
  threshold that repeats is done as well: all its windows repeat.  Only the rest goes on.

Hot ranks: Spark pre-aggregates every round, and the members of a repeated rank are found by joins
with written tables, broadcast if short, else shuffled so that adaptive execution can split a hot
key; identical texts are collapsed first, so no group is ever gathered.
Texts are told apart by 64-bit hashes (one expected mistake at some 10^9.5 different texts).

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; repeated rows and
equal texts are copies of one another; other columns pass through ``strip`` and are ignored by
``digest``; an empty table gives an empty result; very long texts are scanned in overlapping
blocks, and what is gathered per text is bounded by its own length."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_end, batch, delete_path, fresh_path, materialise, members, scratch, small_batches, unused

LENGTH = 400
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(32)
    h *= _C
    return h ^ h >> np.uint64(29)


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Bytes:
    """A text as units of one UTF-8 byte; a gram is 12 of them."""

    gram, step = 12, 8

    def __init__(self, text: str | bytes):
        self.data = text if isinstance(text, bytes) else encoded(text)
        self.n = len(self.data)

    def grams(self, lo: int, hi: int) -> np.ndarray:
        """Hashes of the grams inside units lo to hi."""
        x = np.frombuffer(self.data, np.uint8, hi - lo, lo).astype(np.uint64)
        x2 = x[:-1] | x[1:] << np.uint64(8)
        x4 = x2[:-2] | x2[2:] << np.uint64(16)
        x8 = x4[:-4] | x4[4:] << np.uint64(32)
        h = x8[:-4] * _A
        h ^= x4[8:] * _B
        h ^= h >> np.uint64(32)
        return (h * _C >> np.uint64(32)).astype(np.uint32)

    def names(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The ranks of units lo to hi, as 64-bit names of their content."""
        from xxhash import xxh3_64_intdigest as digest

        data = self.data
        return np.fromiter((digest(data[i:j]) for i, j in zip(lo.tolist(), hi.tolist(), strict=True)), np.uint64, len(lo))


class Words:
    """A text as words, each a hash of eight bytes; a gram is two of them."""

    gram, step = 2, 1

    def __init__(self, text: str | bytes):
        self.hashes = word_hashes(text if isinstance(text, bytes) else encoded(text))
        self.n = len(self.hashes)

    def grams(self, lo: int, hi: int) -> np.ndarray:
        part = self.hashes[lo:hi]
        return (_mixed(part[:-1] * _A ^ part[1:] * _B) >> np.uint64(32)).astype(np.uint32)

    def names(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Ranks by differences of one running polynomial over the words' hashes."""
        total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(self.hashes * _powers(_BASE, self.n), out=total[1:])
        return _mixed((total[hi] - total[lo]) * _powers(_INVERSE, self.n + 1)[lo] ^ (hi - lo).astype(np.uint64) * _A)


#: For each byte a fixed 64-bit value, by rule, and the odd base of polynomial hashes with its inverse.
_VALUE = _mixed((np.arange(1, 257, dtype=np.uint64) * _A) ^ _B)
_VALUE[_SPACE] = 0
_BASE = np.uint64(0x165667B19E3779F9)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base)
    out[0] = 1
    return out.cumprod(dtype=np.uint64)


_POWERS = _powers(_BASE, 65)


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one byte of every word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial of its bytes, or xxh3 beyond 64 bytes."""
    from xxhash import xxh3_64_intdigest as digest

    out, block = [], 1 << 16
    begin, end = word_bounds(data)
    for lo in range(0, len(begin), block):
        b, e = begin[lo : lo + block], end[lo : lo + block]
        first = int(b[0])
        place = np.arange(int(e[-1]) - first)
        starts = np.zeros(len(place), np.int64)
        starts[b - first] = b - first
        place -= np.maximum.accumulate(starts)
        values = _VALUE[np.frombuffer(data, np.uint8, len(place), first)] * _POWERS[np.minimum(place, 64)]
        total = np.zeros(len(place) + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        size = e - b
        h = _mixed(total[e - first] - total[b - first] ^ size.astype(np.uint64) * _A)
        for k in np.flatnonzero(size > 64).tolist():
            h[k] = digest(data[b[k] : e[k]])
        out.append(h)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _stretch(length: int, gram: int = Bytes.gram) -> int:
    """Grams in a stretch: three of them and two grams fit a window."""
    return (length - 2 * gram) // 3


def anchors(units: Bytes | Words, stretch: int) -> np.ndarray:
    """Positions of the grams that are least in some stretch of neighbouring grams."""
    found, block, gram = [], 1 << 20, units.gram
    for lo in range(0, max(1, units.n - gram + 1), block):
        first, last = max(0, lo - stretch + 1), min(units.n, lo + block + stretch + gram)
        if last - first < gram + stretch - 1:
            continue
        h = units.grams(first, last)
        least = _sliding(h, stretch, np.minimum)
        n = len(h)
        padded = np.zeros(n + stretch - 1, np.uint32)  # stretches that hold a gram: those ending at or after it
        padded[stretch - 1 : n] = least
        chosen = np.flatnonzero(_sliding(padded, stretch, np.maximum) == h) + first
        found.append(chosen[(chosen >= lo) & (chosen < lo + block)])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    size, out = 1, x
    while size * 2 <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    return best(out[: len(x) - width + 1], out[width - size :][: len(x) - width + 1]) if size < width else out


class Cells:
    """The windows of a text, dealt to anchors; what the rounds need of each."""

    def __init__(self, length: int = LENGTH, units=Bytes):
        self.length, self.units, self.stretch = length, units, _stretch(length, units.gram)
        if self.stretch < 1 or length > 1023:
            raise ValueError(f"windows of {length} units are not provided for")
        self.centre = (length - units.gram + 1) // 2
        half = (self.stretch + 1) // 2
        self.near, self.far = self.centre - half, self.centre + half  # an anchor's distance from a window's start
        self.offset = (length - self.far + self.near + 1) // 2  # half a core

    def of(self, units: Bytes | Words) -> np.ndarray:
        """Every anchor that has windows, with their least and greatest distance, as places."""
        if units.n < self.length:
            return np.zeros(0, np.int64)
        at = anchors(units, self.stretch)
        bounds = (at[:-1] + at[1:]) // 2
        low = np.maximum(np.concatenate(([-1], bounds)) + 1 - self.centre, 0)  # first and last window start
        high = np.minimum(np.concatenate((bounds, [units.n])) - self.centre, units.n - self.length)
        some = high >= low
        at, low, high = at[some], low[some], high[some]
        return at << 20 | (at - high) << 10 | at - low


def _split(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, least distance, greatest distance) of places."""
    return place >> 20, place >> 10 & 1023, place & 1023


def _lists(column) -> list[np.ndarray]:
    """The rows of a list column of numbers."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[lo:hi] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def positions(texts: DataFrame, cells: Cells) -> DataFrame:
    """(tid, ranks, places): per text its positions' ranks at half a core, and where they are.

    A place is one number: the anchor, and the least and the greatest distance of its windows."""
    out = pa.schema([("tid", pa.int64()), ("ranks", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            tids, ranks, places = [], [], []
            for tid, text in zip(b.column("tid").to_pylist(), b.column("text").to_pylist(), strict=True):
                units = cells.units(text)
                place = cells.of(units)
                if len(place):
                    start = (place >> 20) - cells.near
                    tids.append(tid)
                    ranks.append(units.names(start, start + cells.offset).view(np.int64))
                    places.append(place)
            yield batch(out, tid=tids, ranks=ranks, places=places)

    return texts.select("tid", "text").mapInArrow(run, "tid long, ranks array<long>, places array<long>")


def paired(live: DataFrame, texts: DataFrame, cells: Cells) -> DataFrame:
    """(core, whole, tid, place): the rank of the pair (rank at i, rank at i + k), and of all its windows cover."""
    out = pa.schema([("rank", pa.int64()), ("later", pa.int64()), ("cover", pa.int64()), ("tid", pa.int64()), ("place", pa.int64())])
    length = cells.length

    def run(batches):
        for b in batches:
            for tid, text, place in zip(b.column("tid").to_pylist(), b.column("text").to_pylist(), _lists(b.column("places")), strict=True):
                units = cells.units(text)
                p, near, far = _split(place)
                first, last = p - cells.near, p - cells.far + length
                ranks = [units.names(lo, hi).view(np.int64) for lo, hi in ((first, first + cells.offset), (last - cells.offset, last), (p - far, p - near + length))]
                yield batch(out, rank=ranks[0], later=ranks[1], cover=ranks[2], tid=np.full(len(p), tid), place=place)

    rows = with_text(live, texts, "places").mapInArrow(run, "rank long, later long, cover long, tid long, place long")
    core = F.xxhash64("rank", "later")
    return rows.select(core.alias("core"), F.xxhash64(core, "cover", F.col("place").bitwiseAND(0xFFFFF)).alias("whole"), "tid", "place")


def with_text(rows: DataFrame, texts: DataFrame, column: str) -> DataFrame:
    """(tid, text, the column as a list): each text with its rows; the bucketed texts do not move."""
    gathered = rows.groupBy("tid").agg(F.collect_list(column).alias(column))
    return gathered.join(texts.select("tid", "text").hint("shuffle_merge"), "tid").select("tid", "text", column)


def windows(going: DataFrame, texts: DataFrame, cells: Cells) -> DataFrame:
    """(core, left, right, valid, tid, base): ``step`` windows each, for the positions that go on.

    Window u of an item starts u bytes before ``base``; it is the u bytes before the core, the core
    and the step - 1 - u bytes after it.  Those bytes travel as numbers, so the last round needs no text."""
    out = pa.schema([("core", pa.int64()), ("left", pa.int64()), ("right", pa.int64()), ("valid", pa.int16()), ("tid", pa.int64()), ("base", pa.int64())])
    step, length = cells.units.step, cells.length
    edge = step - 1

    def run(batches):
        for b in batches:
            for tid, text, place in zip(b.column("tid").to_pylist(), b.column("text").to_pylist(), _lists(b.column("place")), strict=True):
                units = cells.units(text)
                p, near, far = _split(place)
                each = far // step - near // step + 1
                k = np.arange(each.sum()) - np.repeat(each.cumsum() - each, each) + np.repeat(near // step, each)
                near, far, base = np.repeat(near, each), np.repeat(far, each), np.repeat(p, each) - k * step
                end = base - edge + length
                valid = sum(((near <= k * step + u) & (k * step + u <= far)).astype(np.int16) << u for u in range(step))
                left = right = np.zeros(len(base), np.int64)
                if edge:
                    data = units.data
                    left = [int.from_bytes(data[max(0, i - edge) : i][::-1], "little") for i in base.tolist()]
                    right = [int.from_bytes(data[i : i + edge], "little") for i in end.tolist()]
                yield batch(out, core=units.names(base, np.minimum(end, units.n)).view(np.int64), left=left, right=right, valid=valid, tid=np.full(len(base), tid), base=base)

    return with_text(going, texts, "place").mapInArrow(run, "core long, left long, right long, valid short, tid long, base long")


def repeated(items: DataFrame, rank: str) -> tuple[DataFrame, DataFrame]:
    """(items whose rank repeats, the repeated ranks as a written table)."""
    ranks = materialise(items.groupBy(rank).count().where("count > 1").select(rank), "suffix-repeated")
    return members(items, ranks, [rank]), ranks


def settle(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over (core, whole, ...): (items whose whole repeats, one witness of each whole of a
    core that repeats where one of its wholes does not)."""
    columns = [c for c in items.columns if c not in ("core", "whole")]
    pairs = materialise(items.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct(*columns)).alias("witness")), "suffix-pairs")
    counts = pairs.groupBy("core").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"))
    doubtful = materialise(counts.where("all > 1 and single > 0").select("core"), "suffix-doubtful")
    again = materialise(pairs.where("n > 1").select("whole"), "suffix-repeated")
    return members(items, again, ["whole"]), members(pairs, doubtful, ["core"]).select("core", "whole", "witness.*")


def distinct_texts(docs: DataFrame, name: str) -> DataFrame:
    """(tid, text, copies), one row per different text, in a table bucketed by tid in the shared folder.

    Equal texts are combined before the shuffle; later joins on tid do not move the texts again."""
    spark = docs.sparkSession
    keyed = docs.select(F.xxhash64("text").alias("tid"), "text").where("text is not null")
    one = keyed.groupBy("tid").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    table, path = f"lexloom_{name}_{uuid.uuid4().hex}", fresh_path(spark, name)

    def drop():
        spark.sql(f"drop table if exists {table}")
        delete_path(spark, path)

    at_end(drop)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    one.write.option("path", path).bucketBy(buckets, "tid").saveAsTable(table)
    return spark.table(table)


def covered(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sorted maximal runs [lo, hi) of what the runs from low to high cover of n units."""
    steps = np.bincount(low, minlength=n + 1) - np.bincount(high, minlength=n + 1)
    gone = (steps.cumsum()[:n] > 0).astype(np.int8)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
    return edges.reshape(-1, 2)


def repeats(texts: DataFrame, length: int = LENGTH, units=Bytes) -> DataFrame:
    """(tid, spans): per text the ranges of starts of windows that repeat elsewhere, as low << 10 | width."""
    cells = Cells(length, units)
    ranked = materialise(positions(texts, cells), "suffix-positions")
    every = ranked.select("tid", F.explode(F.arrays_zip("ranks", "places")).alias("x")).select("tid", F.col("x.ranks").alias("rank"), F.col("x.places").alias("places"))
    shared = materialise(ranked.select(F.explode("ranks").alias("rank")).groupBy("rank").count().where("count > 1").select("rank"), "suffix-shared")
    items = materialise(paired(members(every, shared, ["rank"]).drop("rank"), texts, cells), "suffix-pairs-of-ranks")
    done, going = settle(items)
    spans = done.select("tid", F.expr("(((place >> 20) - (place & 1023)) << 10) | ((place & 1023) - ((place >> 10) & 1023))").alias("span"))
    narrow = materialise(windows(going, texts, cells), "suffix-windows")
    if units.step == 1:
        done, _ = repeated(narrow, "core")
        spans = spans.unionByName(done.select("tid", F.expr("base << 10").alias("span")))
    else:
        done, going = settle(narrow.withColumn("whole", F.xxhash64("core", "left", "right", "valid")))
        first = F.floor(F.log2(F.col("valid").bitwiseAND(-F.col("valid"))) + 0.5).cast("int")
        last = F.floor(F.log2(F.col("valid").cast("double"))).cast("int")
        spans = spans.unionByName(done.select("tid", (F.shiftleft(F.col("base") - last, 10) + (last - first)).alias("span")))
        mask = [(1 << 8 * u) - 1 for u in range(units.step)]
        each = F.array(*[F.struct(F.lit(u).alias("u"), F.lit(mask[u]).cast("long").alias("l"), F.lit(mask[units.step - 1 - u]).cast("long").alias("r")) for u in range(units.step)])
        single = going.select("core", "tid", "base", "left", "right", "valid", F.explode(each).alias("w")).where("((valid >> w.u) & 1) = 1")
        whole = F.xxhash64("core", "w.u", F.col("left").bitwiseAND(F.col("w.l")), F.col("right").bitwiseAND(F.col("w.r")))
        done, _ = repeated(single.select(whole.alias("whole"), "tid", F.shiftleft(F.col("base") - F.col("w.u"), 10).alias("span")), "whole")
        spans = spans.unionByName(done.select("tid", "span"))
    return spans.groupBy("tid").agg(F.collect_list("span").alias("spans"))


RESULT = pa.schema([("tid", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_passages", pa.int64()), ("kept", pa.string())])


def cut(docs: DataFrame, length: int = LENGTH, words: int = 0, cut_words: bool = False, with_text: bool = False) -> DataFrame:
    """Per different text: tid, n_bytes, n_removed, n_spans, kept_sha256, n_passages and kept text.

    words: n_passages counts the maximal runs of so many words or more that repeat elsewhere (0
    without words), and with ``cut_words`` these go too, however short they are in bytes.
    kept: with ``with_text``, what is left of the texts that lose something; else null."""
    small_batches(docs.sparkSession)
    with scratch():
        texts = distinct_texts(docs, "suffix_texts")
        marked = texts.join(repeats(texts, length), "tid", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<long>")))
        if words:
            runs = repeats(texts, words, Words).withColumnRenamed("spans", "runs")
            marked = marked.join(runs, "tid", "left").withColumn("runs", F.coalesce("runs", F.array().cast("array<long>")))
        columns = ["tid", "text", "copies", "spans", *["runs"] * bool(words)]

        def starts(spans):
            """First and last window starts."""
            return spans >> 10, (spans >> 10) + (spans & 1023)

        def run(batches):
            for b in batches:
                rows = []
                for tid, text, copies, spans, *more in zip(*(b.column(c).to_pylist() for c in columns[:3]), *(_lists(b.column(c)) for c in columns[3:]), strict=True):
                    data = encoded(text)
                    passages, found = 0, np.zeros((0, 2), np.int64)
                    if words and (copies > 1 or len(more[0])):
                        begin, end = word_bounds(data)
                        if copies > 1:
                            passages = int(len(begin) >= words)
                        else:
                            low, high = starts(more[0])
                            found = covered(len(begin), low, high + words)
                            passages = len(found)
                            found = np.stack([begin[found[:, 0]], end[found[:, 1] - 1]], axis=1)
                    low, high = starts(spans)
                    low, high = np.concatenate((low, found[:, 0] if cut_words else low[:0])), np.concatenate((high + length, found[:, 1] if cut_words else high[:0]))
                    whole = copies > 1 and (len(data) >= length or cut_words and passages)
                    gone = [[0, len(data)]] if whole else covered(len(data), low, high).tolist() if len(low) else []
                    left, at = [], 0
                    for lo, hi in gone:
                        left.append(data[at:lo])
                        at = hi
                    kept = b"".join([*left, data[at:]])
                    rows.append((tid, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), passages, kept.decode("utf-8", "ignore") if with_text and gone else None))
                cols = list(zip(*rows, strict=True)) or [()] * len(RESULT)
                yield batch(RESULT, **dict(zip(RESULT.names, cols, strict=True)))

        done = marked.select(*columns).mapInArrow(run, "tid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, kept string")
        return materialise(done, "suffix-results", keep=True)


def digest(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every whole text; with words, n_passages too.

    What is removed follows the length in bytes alone; n_passages counts repeated runs of words."""
    results = cut(docs, length, words).drop("kept")
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tid"))
    joined = keyed.join(results, "tid", "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans", "n_passages")]
    return joined.select("doc_id", *counts[:3], F.coalesce("kept_sha256", empty).alias("kept_sha256"), *counts[3:] * bool(words))


def strip(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """The documents with repeated passages cut out of the text and n_chars, if there, counted anew.

    words: passages of so many words go too, from their first word to their last.
    A character that loses some of its bytes goes with them."""
    key, new = unused(docs, "_tid"), unused(docs, "_new_text")
    kept = cut(docs, length, words, cut_words=True, with_text=True).where("kept is not null").select(F.col("tid").alias(key), F.col("kept").alias(new))
    out = docs.withColumn(key, F.xxhash64("text")).join(kept, key, "left")
    columns = {"text": F.coalesce(new, "text").alias("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(new).isNull(), F.col("n_chars")).otherwise(F.length(new)).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[columns.get(c, F.col(f"`{c}`")) for c in docs.columns])
