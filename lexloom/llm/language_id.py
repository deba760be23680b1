"""Operator 7: language identification by string kernels.

Kernel: the blended-spectrum presence kernel on UTF-8 bytes.  A text, lower-cased, with every run
of ASCII non-letters as one space, is the set of its 1- to 4-grams, hashed into ``2**BITS`` places;
k(x, z) = |x and z| / sqrt(|x| |z|).  A bounded, documented sample of labelled rows (``sample``
rows over all languages, chosen by hash of the id) gives ``landmarks`` Nyström landmarks and the
one-versus-rest kernel ridge regression on the Nyström features.  Scoring is batched: a block of
presence vectors times the landmarks' matrix, times one small matrix of weights.  The model is a
few megabytes whatever the input.  Scoring is one map over the rows: no shuffle.

Defined cases: a text that is null or has no letters is ``und`` with score 0; with no labelled rows
every text is ``und``; rows with a null id are never learnt from and not held out; ties go to the
language that sorts first; repeated rows give repeated rows; other columns are ignored by
``predict`` and kept by ``keep_known``; an empty table gives an empty result."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, small_batches

BITS, ORDERS, BLOCK = 14, 4, 64
#: The least score at which a language is told.  0.5 is a one-versus-rest value of 0, neither no (-1) nor
#: yes (1); of two languages one is always there, and a text that shares nothing with them is just above.
TOLD = 0.52
_LETTER = re.compile(r"[^\W\d_]")
_TABLE = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def presence(text: str, out: np.ndarray) -> None:
    """Set the places of the text's n-grams in a zeroed vector."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()) + b" ", np.uint8)
    step = 1 << 20  # very long texts in pieces that overlap by an n-gram
    for lo in range(0, max(1, len(data)), step):
        part = data[lo : lo + step + ORDERS - 1].astype(np.uint32)
        code = part
        for n in range(1, ORDERS + 1):
            if n > 1:
                code = (code[:-1] << np.uint32(8)) | part[n - 1 :]
            if not len(code):
                break
            mixed = (code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
            out[(mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)] = 1


def has_letters(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


class Model:
    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.weights = languages, weights
        self.landmarks = np.ascontiguousarray(normalised(landmarks).T) if len(landmarks) else None

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.languages:
            return out
        at = [i for i, x in enumerate(texts) if has_letters(x)]
        for lo in range(0, len(at), BLOCK):
            block = at[lo : lo + BLOCK]
            seen = np.zeros((len(block), 1 << BITS), np.float32)
            for row, i in zip(seen, block, strict=True):
                presence(texts[i], row)
            scores = (normalised(seen) @ self.landmarks).astype(np.float64) @ self.weights
            best = scores.argmax(axis=1)
            for i, k, s in zip(block, best, scores[np.arange(len(block)), best], strict=True):
                out[i] = (self.languages[k], round(float(np.clip((s + 1) / 2, 0, 1)), 6))
        return out


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def _unpacked(packed: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(packed), np.uint8)).reshape(-1, 1 << BITS).astype(np.float32)


def fit(samples: list[tuple[str, bytes]], landmarks: int = 128, ridge: float = 1e-2) -> Model:
    """Nyström features and one-versus-rest ridge regression; samples: (language, packed presence).

    Presence vectors are unpacked a block at a time; what is held is the sample in bits (2 KB a row),
    the landmarks and one row of features per sample."""
    if not samples:
        return Model([], np.zeros((0, 1 << BITS), np.float32), np.zeros((0, 0)))
    names, packed = zip(*samples, strict=True)
    languages = sorted(set(names))
    turns: dict[str, int] = {}
    order = []
    for i, lang in enumerate(names):  # landmarks are dealt to the languages in turn
        turns[lang] = turns.get(lang, 0) + 1
        order.append((turns[lang], lang, i))
    z = _unpacked([packed[i] for *_, i in sorted(order)[:landmarks]])
    zn = normalised(z)
    values, vectors = np.linalg.eigh((zn @ zn.T).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    kernel = [(normalised(_unpacked(packed[lo : lo + BLOCK])) @ zn.T).astype(np.float64) for lo in range(0, len(packed), BLOCK)]
    features = np.concatenate(kernel) @ root
    y = np.where(np.array(names)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weight = 1 / np.array([turns[lang] for lang in names], np.float64)[:, None]  # languages count alike
    weight = weight / weight.mean()
    gram = features.T @ (features * weight) + ridge * len(samples) / 100 * np.eye(features.shape[1])
    return Model(languages, z, root @ np.linalg.solve(gram, features.T @ (y * weight)))


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample: int = 2000, landmarks: int = 128) -> Model:
    """Fit on at most ``sample`` labelled rows of those that are not held out, languages alike."""
    small_batches(docs.sparkSession)
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()}
    if not counts:
        return fit([])
    each = max(1, sample // len(counts))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 2.0 * each / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    some = usable.select("lang", "text", "doc_id", draw.alias("draw")).where(F.col("draw") < F.try_element_at(share, F.col("lang")))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    some = some.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= each)

    def run(batches):
        kept = pa.schema([("lang", pa.string()), ("turn", pa.int32()), ("seen", pa.binary())])
        for b in batches:
            rows = []
            for lang, turn, text in zip(*(b.column(c).to_pylist() for c in ("lang", "turn", "text")), strict=True):
                if has_letters(text):
                    presence(text, v := np.zeros(1 << BITS, np.uint8))
                    rows.append((lang, turn, np.packbits(v).tobytes()))
            lang, turn, seen = zip(*rows, strict=True) if rows else ((), (), ())
            yield batch(kept, lang=lang, turn=turn, seen=seen)

    found = some.select("lang", "turn", "text").mapInArrow(run, "lang string, turn int, seen binary").collect()
    found.sort(key=lambda r: (r["lang"], r["turn"]))
    return fit([(r["lang"], bytes(r["seen"])) for r in found], landmarks)


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text; only the text is looked at."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            lang, score = zip(*shared.value.predict(b.column("text").to_pylist()), strict=True) if b.num_rows else ((), ())
            yield batch(OUT, doc_id=b.column("doc_id"), held_out=b.column("held_out"), lang_pred=lang, score=score)

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The documents, all columns as they are, whose language is known with at least this score.

    Without a model (no labelled rows) no language can be told, and all with a letter stay."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            keep = [lang != "und" and score >= least for lang, score in shared.value.predict(texts)] if shared.value.languages else map(has_letters, texts)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
