"""Operator 1: Chroma audio fingerprints and alignment of recordings.

A media column holds a recording as unsigned 8-bit or signed 16-bit PCM.  Overlapping frames become
power spectra, spectra fold onto the twelve pitch classes, each frame is scaled to whole numbers (so
that results do not depend on how rows are batched), and an integral image over (frame, pitch class)
answers every filter in four look-ups.  Sixteen filters of two bits each, in Gray code, make one
32-bit integer per position.  ``Shape`` has rate, frame, hop and bits; its defaults suit music.

Alignment.  ``SEED`` codes in a row are a run.  The runs that two recordings share vote for their
offset; at the offset with the most votes the share of differing bits over the overlap is the bit
error.  Two recordings are linked if that offset has at least ``LEAST_VOTES`` votes and at least one
for every ``PER_VOTE`` runs of the shorter one, and the bit error is at most ``MOST_ERROR``.

Exact candidates without all pairs.  Votes at one offset are no more than the runs shared, counted
with repeats.  So with all runs in one order, the shorter one's first n - needed + 1 hold a shared
one.  The order is rare-first: what many recordings share comes last and makes no candidates unless
it is a good part of a recording.  Runs that only one recording has are counted, never moved.  First every
recording is aligned with the longest one that holds each of its leading runs, the links found are
contracted to components, and then only pairs between different components are aligned.  A link
left out is between recordings connected already, so components are exact, and a group of copies is
never listed as pairs.  Hot runs: counts are pre-aggregated, and joins are with written tables that
are broadcast if short or else split by adaptive execution.

Defined cases: a null or empty recording has no codes, is its own class and is linked with nothing;
recordings with equal codes, and those too short for a code with equal samples, share a class; with
fewer than SEED + LEAST_VOTES - 1 codes a recording is linked with its class only; null ids take
part and name a class or group only where it has no other; repeated rows share a class; other columns
are ignored, whatever their names; an empty table gives an empty result; long recordings are
transformed in blocks."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, materialise, members, scratch, small_batches
from .graph import components

WIDTH, SCALE = 16, 4096
SEED, LEAST_VOTES, PER_VOTE, MOST_ERROR = 4, 3, 4, 0.25
_GRAY = np.array([0, 1, 3, 2], np.uint32)


@dataclass(frozen=True)
class Shape:
    """How samples become frames: samples a second, samples in a frame and between frames, bits of one."""

    rate: int = 11025
    frame: int = 4096
    hop: int = 1365
    bits: int = 16

    @cached_property
    def window(self) -> np.ndarray:
        return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(self.frame) / self.frame)

    @cached_property
    def fold(self) -> np.ndarray:
        """Spectrum bins to pitch classes, A = 0; bins outside the musical range fold to nothing."""
        hz = np.arange(self.frame // 2 + 1) * self.rate / self.frame
        out = np.zeros((len(hz), 12))
        for i, f in enumerate(hz):
            if 60 <= f <= 3600:
                out[i, round(12 * np.log2(f / 440)) % 12] = 1
        return out


#: For bytes of text read as 8-bit samples: frames as short as texts need, though they tell pitches
#: apart only above some 1,000 Hz.
SHORT = Shape(8000, 128, 32, 8)


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, pitch classes, frames) of the sixteen filters, by rule."""
    return [(i % 4, i * 7 % 5, 4 + i * 3 % 5, 4 + i * 5 % (WIDTH - 3)) for i in range(16)]


def chroma(samples: np.ndarray, shape: Shape = SHORT) -> np.ndarray:
    """Whole-number pitch-class frames of samples in -1..1."""
    frame, hop = shape.frame, shape.hop
    n = 1 + (len(samples) - frame) // hop if len(samples) >= frame else 0
    out = np.zeros((n, 12), np.int64)
    step = max(1, (1 << 20) // frame)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        part = samples[lo * hop : (hi - 1) * hop + frame]
        frames = np.lib.stride_tricks.sliding_window_view(part, frame)[::hop] * shape.window
        spectrum = np.fft.rfft(frames, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2) @ shape.fold
        norm = np.sqrt((power**2).sum(axis=1, keepdims=True))
        out[lo:hi] = np.rint(power / np.maximum(norm, 1e-9) * SCALE) * (norm > 1e-6)
    return out


def codes_of(image: np.ndarray) -> np.ndarray:
    """Packed 32-bit integers from pitch-class frames through an integral image."""
    n = len(image) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, 13), np.int64)
    total[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)

    def area(x0: int, x1: int, y0: int, y1: int) -> np.ndarray:
        high, low = total[x1 : x1 + n], total[x0 : x0 + n]
        return high[:, y1] - high[:, y0] - low[:, y1] + low[:, y0]

    out = np.zeros(n, np.uint32)
    for kind, y, height, width in filters():
        top, mid, half = y + height, y + height // 2, width // 2
        if kind == 0:
            a, b = area(0, width, y, mid), area(0, width, mid, top)
        elif kind == 1:
            a, b = area(0, half, y, top), area(half, width, y, top)
        elif kind == 2:
            a = area(0, half, y, mid) + area(half, width, mid, top)
            b = area(0, half, mid, top) + area(half, width, y, mid)
        else:
            third = max(1, width // 3)
            a, b = area(third, width - third, y, top), area(0, third, y, top) + area(width - third, width, y, top)
        ratio = np.log((SCALE + a) / (SCALE + b))
        level = (ratio > -0.25).astype(np.int64) + (ratio > 0) + (ratio > 0.25)
        out = out << np.uint32(2) | _GRAY[level]
    return out


def samples_of(pcm: bytes, bits: int = 8) -> np.ndarray:
    if bits == 8:
        return (np.frombuffer(pcm, np.uint8).astype(np.float64) - 128) / 128
    return np.frombuffer(pcm[: len(pcm) // 2 * 2], "<i2").astype(np.float64) / 32768


def fingerprint(pcm: bytes | None, shape: Shape = SHORT) -> tuple[int, np.ndarray]:
    """(number of frames, codes) of a recording."""
    image = chroma(samples_of(pcm or b"", shape.bits), shape)
    return len(image), codes_of(image)


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * _ODD[0]
    h ^= h >> np.uint64(29)
    h *= _ODD[1]
    return h ^ h >> np.uint64(32)


def runs(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the SEED codes that start at each position."""
    n = max(0, len(codes) - SEED + 1)
    h = np.zeros(n, np.uint64)
    for i in range(SEED * bool(n)):
        h = _mixed(h ^ codes[i : i + n].astype(np.uint64))
    return h


def counted_runs(codes: np.ndarray) -> np.ndarray:
    """Every run with its turn among equal ones, so that a set of them counts repeats."""
    h = np.sort(runs(codes))
    return _mixed(h ^ (np.arange(len(h)) - np.searchsorted(h, h, "left")).astype(np.uint64) * _ODD[1])


def needed(n: int) -> int:
    """Votes that link a recording of n runs with a longer one."""
    return max(LEAST_VOTES, -(-n // PER_VOTE))


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """(votes, offset, differing bits, overlap): position i of b lies at i + offset of a."""
    x, y = runs(a), runs(b)
    order = np.argsort(y, kind="stable")
    ordered = y[order]
    low, high = np.searchsorted(ordered, x, "left"), np.searchsorted(ordered, x, "right")
    votes = np.zeros(len(x) + len(y), np.int64)
    counts = high - low
    ends = counts.cumsum()
    step, lo = 1 << 20, 0
    while lo < len(x):  # repeated runs vote in blocks, so memory stays bounded
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, "right")))
        c = counts[lo:hi]
        if c.sum():
            inside = np.arange(c.sum()) - np.repeat(c.cumsum() - c, c)
            at_y = order[np.repeat(low[lo:hi], c) + inside]
            votes += np.bincount(np.repeat(np.arange(lo, hi), c) - at_y + len(y), minlength=len(votes))
        lo = hi
    most = votes.max(initial=0)
    if not most:
        return 0, 0, 0, 0
    best = np.flatnonzero(votes == most) - len(y)
    offset = int(best[np.lexsort((best, np.abs(best)))[0]])
    x, y = a[max(0, offset) :], b[max(0, -offset) :]
    n = min(len(x), len(y))
    return int(most), offset, int(np.bitwise_count(x[:n] ^ y[:n]).sum()), n


def linked(a: np.ndarray, b: np.ndarray, votes: int, wrong: int, overlap: int) -> bool:
    return votes >= needed(min(len(a), len(b)) - SEED + 1) and wrong <= MOST_ERROR * 32 * overlap


def fingerprints(media: DataFrame, column: str, shape: Shape = SHORT) -> DataFrame:
    """doc_id, n_frames, n_codes, codes_crc32, recording (equal for one class; null without samples), codes."""
    small_batches(media.sparkSession)
    out = pa.schema([("doc_id", pa.int64()), ("n_frames", pa.int64()), ("n_codes", pa.int64()), ("codes_crc32", pa.int64()), ("recording", pa.int64()), ("codes", pa.binary())])
    width = shape.bits // 8

    def run(batches):
        from xxhash import xxh3_64_intdigest as digest

        for b in batches:
            rows = []
            for pcm in b.column("pcm").to_pylist():
                frames, codes = fingerprint(pcm, shape)
                data, raw = codes.astype("<u4").tobytes(), pcm or b""
                raw = raw[: len(raw) // width * width]
                name = digest(data) if data else digest(raw, 1) if raw else None
                rows.append((frames, len(codes), zlib.crc32(data), None if name is None else name - (name >> 63 << 64), data))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield batch(out, doc_id=b.column("doc_id"), n_frames=cols[0], n_codes=cols[1], codes_crc32=cols[2], recording=cols[3], codes=cols[4])

    return media.select(F.col("doc_id").cast("long"), F.col(column).cast("binary").alias("pcm")).mapInArrow(run, "doc_id long, n_frames long, n_codes long, codes_crc32 long, recording long, codes binary")


def _counted(classes: DataFrame) -> DataFrame:
    """(recording, n, runs) of the classes that are long enough to be linked."""
    out = pa.schema([("recording", pa.int64()), ("n", pa.int32()), ("runs", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            rows = [(r, len(h), h.view(np.int64)) for r, x in zip(b.column("recording").to_pylist(), b.column("codes").to_pylist(), strict=True) if len(h := counted_runs(np.frombuffer(x, "<u4"))) >= LEAST_VOTES]
            name, n, h = zip(*rows, strict=True) if rows else ((), (), ())
            yield batch(out, recording=name, n=n, runs=h)

    return classes.select("recording", "codes").mapInArrow(run, "recording long, n int, runs array<long>")


def align_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, votes, offset, wrong, overlap) of the pairs (a, b) that are linked."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), *((c, pa.int64()) for c in ("votes", "offset", "wrong", "overlap"))])

    def run(batches):
        for b in batches:
            rows = []
            for x, y, codes, other in zip(*(b.column(c).to_pylist() for c in ("a", "b", "codes", "other")), strict=True):
                codes, other = np.frombuffer(codes, "<u4"), np.frombuffer(other, "<u4")
                votes, offset, wrong, overlap = align(other, codes)
                if linked(codes, other, votes, wrong, overlap):
                    rows.append((x, y, votes, offset, wrong, overlap))
            yield batch(out, **dict(zip(out.names, zip(*rows, strict=True) if rows else ((),) * 6, strict=True)))

    own, other = classes.select(F.col("recording").alias("a"), "codes"), classes.select(F.col("recording").alias("b"), F.col("codes").alias("other"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", "codes", "other").mapInArrow(run, "a long, b long, votes long, offset long, wrong long, overlap long")


def links(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, labels): aligned pairs enough to connect every group, and (node, label) of its members."""
    counted = _counted(classes)
    shared = materialise(counted.select(F.explode("runs").alias("run")).groupBy("run").agg(F.count("*").alias("df")).where("df > 1"), "print-runs")
    held = members(counted.select("recording", "n", F.explode("runs").alias("run")), shared, ["run"], "inner")
    lists = held.groupBy("recording").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "run"))).alias("by_rarity"))
    first = F.expr(f"size(by_rarity) - greatest({LEAST_VOTES}, (n + {PER_VOTE - 1}) div {PER_VOTE}) + 1")  # those no one else has come before all
    postings = lists.withColumn("first", first).where("first > 0").select("recording", "n", "first", F.posexplode("by_rarity").alias("place", "r"))
    postings = materialise(postings.select(F.col("r.run").alias("run"), "recording", "n", (F.col("place") < F.col("first")).alias("leads")), "print-postings")
    leaders = postings.groupBy("run").agg(F.max(F.struct("n", "recording")).alias("lead"), F.max("leads").alias("leads")).where("leads").drop("leads")
    stars = members(postings.where("leads"), materialise(leaders, "print-leaders"), ["run"], "inner").where("recording <> lead.recording")
    stars = materialise(stars.select(F.col("recording").alias("a"), F.col("lead.recording").alias("b")).distinct(), "print-stars")
    near = materialise(align_pairs(stars, classes), "print-links", keep=True)
    labels = components(near)
    node = labels.select(F.col("node").alias("recording"), "label")
    labelled = materialise(postings.join(node, "recording", "left").withColumn("label", F.coalesce("label", "recording")), "print-labelled")
    mixed = labelled.groupBy("run").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("leads").alias("leads")).where("x <> y and leads").select("run")
    open_ = members(labelled, materialise(mixed, "print-mixed"), ["run"])
    left = open_.where("leads").select("run", F.col("recording").alias("a"), F.struct("n", "recording").alias("size"), F.col("label").alias("x"))
    right = open_.select("run", F.col("recording").alias("b"), F.struct("n", "recording").alias("other"), F.col("label").alias("y"))
    pairs = left.join(right, "run").where("x <> y and size < other").select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    far = materialise(align_pairs(pairs, classes), "print-far", keep=True)
    every = near.unionByName(far)
    return every, components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(far.select("a", "b"))) if not far.isEmpty() else labels


def match(media: DataFrame, column: str, shape: Shape = SHORT) -> DataFrame:
    """Per recording: its fingerprint's figures, its class, its group, and its best alignment found.

    doc_id, n_frames, n_codes, codes_crc32, class_id (equal codes), group_id (linked directly or
    through others), match_id (class of a linked recording; null: none), match_votes, match_offset (of
    this recording in that one), bit_error, aligned."""
    with scratch():
        prints = materialise(fingerprints(media, column, shape), "prints", keep=True)
        classes = prints.where("recording is not null").groupBy("recording").agg(F.first("codes").alias("codes"))
        every, labels = links(materialise(classes, "print-classes"))
        labels = materialise(labels, "print-labels", keep=True)
    names = prints.where("recording is not null").groupBy("recording").agg(F.min("doc_id").alias("class_id"))
    names = names.join(labels.withColumnRenamed("node", "recording"), "recording", "left").withColumn("label", F.coalesce("label", "recording"))
    groups = names.groupBy("label").agg(F.min("class_id").alias("group_id"))
    ids = names.select(F.col("recording").alias("other"), F.col("class_id").alias("match_id"))
    both = every.select(F.col("a").alias("recording"), F.col("b").alias("other"), "votes", "offset", "wrong", "overlap").unionByName(every.select(F.col("b").alias("recording"), F.col("a").alias("other"), "votes", (-F.col("offset")).alias("offset"), "wrong", "overlap"))
    error = F.round(F.col("wrong") / (32 * F.greatest("overlap", F.lit(1))), 6)
    best = both.join(ids, "other").groupBy("recording").agg(F.max(F.struct("votes", (-error).alias("good"), (-F.col("match_id")).alias("back"), "offset")).alias("m"))
    found = names.join(groups, "label").join(best, "recording", "left").drop("label")
    return prints.drop("codes").join(found, "recording", "left").select(
        "doc_id", "n_frames", "n_codes", "codes_crc32", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("group_id", "doc_id").alias("group_id"),
        (-F.col("m.back")).alias("match_id"), F.coalesce("m.votes", F.lit(0)).cast("long").alias("match_votes"), F.col("m.offset").alias("match_offset"),
        (-F.col("m.good")).alias("bit_error"), F.col("m.votes").isNotNull().alias("aligned"),
    )
