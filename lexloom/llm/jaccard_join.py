"""Operator 10: exact n-gram Jaccard join with several global token orders.

Sets: the distinct 4-word shingles of a text (64-bit hashes).  Two texts link at Jaccard >= 85/100
(``links`` and ``keep_first`` take other lengths and thresholds), so they share at least ``o`` shingles, and under any global order of shingles the first n - o + l
of each hold at least l common ones.  The filters, each from its own order:

1. Hash order, l-prefix (l = n / 20): only prefix shingles are shuffled.  Those that a second text has
   in its prefix are counted; a text with fewer than the l of its smallest possible partner links
   with nothing and leaves.  This drops nearly all texts before any pair is thought of.
2. Rare-first order of what is left of the prefixes (frequency, then hash): of m shared shingles,
   the first m - l + 1 are kept.  Very common passages come last, so they make no candidates.
3. Reversed hash order: the l-prefix again, of the order read from its end.  A text with fewer than
   l shingles that others have in theirs leaves as well, and a pair must share one of the last n - o + 1.

Candidates intersect the filters before any verification.  Pairs inside big groups of near copies
are never listed: first every text is paired with the leader of each of its kept shingles (the most
central text), the links found are contracted to components, and only pairs between different
components are looked at, in blocks of about ``BLOCK`` x ``BLOCK`` rows (the rows of a leader's own
component are held against the others only, so a long list costs its length times the few that are
not with its leader), by a bit-parity sketch whose bound never rules out a link: once for each text's likeliest partner, then, with these
contracted too, for all pairs that are left.  Survivors are verified on the whole sets.  A link left out is
between texts that are connected already, so components are exact.

Equal texts are one node.  Texts are told apart by 64-bit hashes.

Defined cases: null texts and texts without words have empty sets and stand alone; a text of one to
three words is one shingle; repeated rows and equal texts share a component; a null doc_id takes part
and never names a component unless no other id does; other columns are ignored by ``link`` and kept
by ``keep_first``; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WordCache, batch, materialise, members, scratch, small_batches, unused, worker_own
from .graph import components

SHINGLE, NUMERATOR, BLOCK, SKETCH = 4, 85, 1024, 16
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def overlap(n: int, numerator: int = NUMERATOR) -> int:
    """Shingles that a set of n shares with any partner, at least."""
    return (numerator * n + 99) // 100


def extra(n: int) -> int:
    """The l of the l-prefix of a set of n; never falls as n grows."""
    return max(1, n // 20)


def required(n: int, numerator: int = NUMERATOR) -> int:
    """Common prefix shingles with the smallest possible partner."""
    return extra(overlap(n, numerator))


def prefix_size(n: int, numerator: int = NUMERATOR) -> int:
    return n - overlap(n, numerator) + extra(n)


def _word_hashes(words: list[bytes]) -> list[int]:
    from xxhash import xxh3_64_intdigest

    return [xxh3_64_intdigest(w) for w in words]


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted set of shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(worker_own(("word hashes",), lambda: WordCache(_word_hashes, 200_000)).of(words), np.uint64)
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = (out ^ h[i : len(h) - n + 1 + i]) * _ODD[i % len(_ODD)]
        out ^= out >> np.uint64(31)
    return np.unique(out)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the set's shingles in each of 64 * SKETCH places: differing places bound the difference."""
    bits = np.bincount((tokens * _ODD[1] >> np.uint64(64 - 10)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def _tokens(docs: DataFrame, size: int, numerator: int) -> DataFrame:
    """(tid, n, prefix), one row per different text with words: the l-prefix under hash order."""
    out = pa.schema([("tid", pa.int64()), ("n", pa.int32()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            rows = [(tid, len(s), s[: prefix_size(len(s), numerator)].view(np.int64)) for tid, text in zip(b.column("tid").to_pylist(), b.column("text").to_pylist(), strict=True) if len(s := shingles(text, size))]
            tid, n, prefix = zip(*rows, strict=True) if rows else ((), (), ())
            yield batch(out, tid=tid, n=n, prefix=prefix)

    keyed = docs.where("text is not null").select(F.xxhash64("text").alias("tid"), "text")
    return keyed.mapInArrow(run, "tid long, n int, prefix array<long>").dropDuplicates(["tid"])


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(tid, n, tokens, sketch) of the wanted texts."""
    out = pa.schema([("tid", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary()), ("sketch", pa.binary())])

    def run(batches):
        for b in batches:
            rows = [(tid, len(s), s.tobytes(), sketch(s).tobytes()) for tid, s in zip(b.column("tid").to_pylist(), (shingles(x, size) for x in b.column("text").to_pylist()), strict=True)]
            tid, n, tokens, sk = zip(*rows, strict=True) if rows else ((),) * 4
            yield batch(out, tid=tid, n=n, tokens=tokens, sketch=sk)

    keyed = docs.where("text is not null").select(F.xxhash64("text").alias("tid"), "text")
    return members(keyed, wanted, ["tid"]).mapInArrow(run, "tid long, n int, tokens binary, sketch binary").dropDuplicates(["tid"])


def _tails(numerator: int):
    """From (tid, n, tokens) the l-prefix under reversed hash order."""
    out = pa.schema([("tid", pa.int64()), ("n", pa.int32()), ("tail", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            tails = [np.frombuffer(x, np.int64)[len(x) // 8 - prefix_size(len(x) // 8, numerator) :] for x in b.column("tokens").to_pylist()]
            yield batch(out, tid=b.column("tid"), n=b.column("n"), tail=tails)

    return run


def _linked(x: np.ndarray, y: np.ndarray, numerator: int) -> bool:
    """Third order, then the whole sets."""
    small, large = sorted((len(x), len(y)))
    if 100 * small < numerator * large:
        return False
    tail_x, tail_y = x[overlap(len(x), numerator) - 1 :], y[overlap(len(y), numerator) - 1 :]
    if not len(np.intersect1d(tail_x, tail_y, assume_unique=True)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= numerator * (len(x) + len(y) - common)


def _may_link(n: np.ndarray, m: int, differ: np.ndarray, numerator: int) -> np.ndarray:
    """False only where sizes or sketches prove that two sets do not link."""
    least = -(-numerator * (n + m) // (100 + numerator))
    return (differ <= n + m - 2 * least) & (100 * np.minimum(n, m) >= numerator * np.maximum(n, m))


def _verified(pairs: DataFrame, sets: DataFrame, numerator: int) -> DataFrame:
    """The pairs (a, b) that link: by sketches first, then on whole sets."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def rough(batches):
        for b in batches:
            n, m = (b.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(-1, SKETCH) for c in ("sketch", "other"))
            keep = _may_link(n, m, np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64), numerator) if len(n) else np.zeros(0, bool)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches):
        for b in batches:
            keep = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), numerator) for x, y in zip(b.column("tokens").to_pylist(), b.column("other").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], schema=out).filter(pa.array(keep, pa.bool_()))

    def sided(name: str):
        own = sets.select(F.col("tid").alias("a"), "n", name)
        other = sets.select(F.col("tid").alias("b"), F.col("n").alias("m"), F.col(name).alias("other"))
        return own, other

    own, other = sided("sketch")
    few = materialise(pairs.join(own, "a").join(other, "b").select("a", "b", "n", "m", "sketch", "other").mapInArrow(rough, "a long, b long"), "jaccard-rough")
    wanted = materialise(few.select(F.explode(F.array("a", "b")).alias("tid")).distinct(), "jaccard-wanted")
    sets = members(sets, wanted, ["tid"])
    own, other = sided("tokens")
    return few.join(own, "a").join(other, "b").select("a", "b", "tokens", "other").mapInArrow(exact, "a long, b long")


def _across(postings: DataFrame, sets: DataFrame, numerator: int, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) of one posting list and different components that may link.

    postings: token, tid, label, home (whether the label is that of the token's leader).
    nearest: only the likeliest partner of each text outside the list's largest component, which is
    enough to join most components before all the pairs that are left are looked at.

    Rows away from home and rows at home are cut into blocks by hash; a unit of work is a block of
    the former against another block.  Units stream through sorted partitions, so a task holds two
    blocks at a time."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    away, home = F.sum(F.when(F.col("home"), 0).otherwise(1)), F.sum(F.when(F.col("home"), 1).otherwise(0))
    sizes = postings.groupBy("token").agg(F.ceil(away / BLOCK).cast("int").alias("away"), F.ceil(home / BLOCK).cast("int").alias("at_home"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").drop("x", "y")
    cut = postings.join(sizes, "token").withColumn("own", F.expr("if(home, away + pmod(xxhash64(tid), at_home), pmod(xxhash64(tid), away))").cast("int"))
    units = cut.select("token", "tid", "label", "own", F.explode(F.expr("sequence(0, if(home, away, away + at_home) - 1)")).alias("other"))
    units = units.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "tid", "label").join(sets.select("tid", "n", "sketch"), "tid")

    def compare(rows: list[tuple]):
        own = np.array([r[3] for r in rows])
        tid, label, n = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 6))
        bits = np.frombuffer(b"".join(r[7] for r in rows), np.uint64).reshape(-1, SKETCH)
        i, j = rows[0][1:3]
        values, counts = np.unique(label, return_counts=True)
        largest, room, best = values[counts.argmax()], np.full(len(rows), -1), np.zeros(len(rows), np.int64)
        for k in range(len(rows) - 1):
            maybe = label[k + 1 :] != label[k]
            if i != j:
                maybe &= own[k + 1 :] != own[k]
            at = np.flatnonzero(maybe) + k + 1
            if not len(at):
                continue
            differ = np.bitwise_count(bits[at] ^ bits[k]).sum(axis=1, dtype=np.int64)
            may = _may_link(n[at], int(n[k]), differ, numerator)
            at, spare = at[may], (n[at] + n[k] - differ)[may] * 1000 // (n[at] + n[k])[may]
            if not nearest:
                for x in tid[at].tolist():
                    yield max(x, int(tid[k])), min(x, int(tid[k]))
            elif len(at):
                better = spare > room[at]
                room[at[better]], best[at[better]] = spare[better], tid[k]
                if spare.max() > room[k]:
                    room[k], best[k] = spare.max(), tid[at[spare.argmax()]]
        if nearest:
            for k in np.flatnonzero((room >= 0) & (label != largest)):
                yield max(int(tid[k]), int(best[k])), min(int(tid[k]), int(best[k]))

    def run(batches):
        key, held, found = None, [], set()
        names = ("token", "i", "j", "own", "tid", "label", "n", "sketch")

        def flush():
            a, b = zip(*found, strict=True)
            found.clear()
            return batch(out, a=a, b=b)

        def unit():
            for pair in compare(held) if len(held) > 1 else ():
                found.add(pair)
                if len(found) > 50_000:
                    yield flush()

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if row[:3] != key:
                    yield from unit()
                    key, held = row[:3], []
                held.append(row)
        yield from unit()
        if found:
            yield flush()

    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(parts, "token", "i", "j").sortWithinPartitions("token", "i", "j").select("token", "i", "j", "own", "tid", "label", "n", "sketch")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _candidates(docs: DataFrame, size: int, numerator: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tokens, postings, sets): what passes the filters of all three orders."""
    need = F.greatest(F.lit(1), F.expr(f"(({numerator} * n + 99) div 100) div 20"))
    with scratch():
        prefixes = materialise(_tokens(docs, size, numerator), "jaccard-prefixes")
        tokens = materialise(prefixes.select("tid", "n"), "jaccard-sizes", keep=True)
        rows = prefixes.select("tid", "n", F.explode("prefix").alias("token"))
        shared = prefixes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
        kept = materialise(rows.join(shared, "token"), "jaccard-shared")
        lists = kept.groupBy("tid").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("by_rarity"))
        lists = lists.withColumn("need", need).where(F.size("by_rarity") >= F.col("need"))
        central = F.expr("-((1000 * size(by_rarity)) div n)")
        postings = lists.select("tid", "n", central.alias("rank"), F.explode(F.expr("slice(by_rarity, 1, cast(size(by_rarity) - need + 1 as int))")).alias("t")).select("tid", "n", "rank", F.col("t.token").alias("token"))
        alive = postings.groupBy("token").count().where("count > 1").select("token")
        postings = materialise(postings.join(alive, "token", "left_semi"), "jaccard-postings", keep=True)
    with scratch():
        sets = materialise(_sets(docs, materialise(postings.select("tid").distinct(), "jaccard-candidates"), size), "jaccard-sets", keep=True)
        tails = sets.select("tid", "n", "tokens").mapInArrow(_tails(numerator), "tid long, n int, tail array<long>").select("tid", "n", F.explode("tail").alias("token"))
        common = materialise(tails.groupBy("token").count().where("count > 1").select("token"), "jaccard-tails")
        staying = members(tails, common, ["token"]).groupBy("tid").agg(F.first("n").alias("n"), F.count("*").alias("shared")).where(F.col("shared") >= need).select("tid")
        postings = materialise(members(postings, materialise(staying, "jaccard-staying"), ["tid"]), "jaccard-filtered", keep=True)
    return tokens, postings, sets


def links(docs: DataFrame, size: int = SHINGLE, numerator: int = NUMERATOR) -> tuple[DataFrame, DataFrame]:
    """(tokens, labels): (tid, n) of every different text, and (node, label) of the linked ones."""
    small_batches(docs.sparkSession)
    tokens, postings, sets = _candidates(docs, size, numerator)
    leaders = materialise(postings.groupBy("token").agg(F.min(F.struct("rank", "tid")).alias("lead")), "jaccard-leaders")
    stars = postings.join(leaders, "token").where("tid <> lead.tid").select(F.greatest("tid", "lead.tid").alias("a"), F.least("tid", "lead.tid").alias("b")).distinct()
    labels = materialise(components(_verified(stars, sets, numerator)), "jaccard-components")
    for nearest in (True, False):
        node = labels.select(F.col("node").alias("tid"), "label")
        led = leaders.select("token", F.col("lead.tid").alias("tid")).join(node, "tid", "left").select("token", F.coalesce("label", "tid").alias("lead"))
        labelled = postings.select("token", "tid").join(node, "tid", "left").select("token", "tid", F.coalesce("label", "tid").alias("label"))
        labelled = labelled.join(led, "token").select("token", "tid", "label", (F.col("label") == F.col("lead")).alias("home"))
        found = materialise(_verified(_across(labelled, sets, numerator, nearest), sets, numerator), "jaccard-across")
        if found.isEmpty():
            continue
        labels = materialise(components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(found)), "jaccard-components")
    return tokens, labels


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every whole text."""
    with scratch():
        tokens, labels = links(docs)
        keyed = docs.select(F.col("doc_id").cast("long"), F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("tid"))
        known = tokens.join(labels.select(F.col("node").alias("tid"), "label"), "tid", "left").select("tid", "n", F.coalesce("label", "tid").alias("label"))
        placed = keyed.join(known, "tid", "left")
        placed = materialise(placed.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), "label"), "jaccard-placed", keep=True)
    names = placed.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("first"))
    return placed.join(names, "label", "left").select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, size: int = SHINGLE, numerator: int = NUMERATOR) -> DataFrame:
    """The documents, all columns, exactly one row of each component: that with the component's id.

    Rows that repeat an id and a text are one; a row with a null id stays only where its component
    has no other id.  Texts without words stand alone, and of these rows with a null id all stay."""
    spark = docs.sparkSession
    doc, key = unused(docs, "_doc"), unused(docs, "_tid")
    keyed = docs.withColumn(doc, F.col("doc_id").cast("long")).withColumn(key, F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    with scratch():
        tokens, labels = links(docs, size, numerator)
        known = tokens.join(labels.select(F.col("node").alias("tid"), "label"), "tid", "left").select("tid", F.coalesce("label", "tid").alias("label"))
        groups = keyed.select(F.col(doc).alias("doc"), F.col(key).alias("tid")).groupBy("doc", "tid").agg(F.count("*").alias("rows")).join(known, "tid", "left")
        firsts = groups.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "tid", "rows")).alias("f")).select("f.doc", "f.tid", "f.rows")
        alone = groups.where("label is null").select("doc", "tid", F.when(F.col("doc").isNull(), 1).otherwise(F.col("rows")).alias("rows"))
        chosen = materialise(firsts.unionByName(alone), "jaccard-chosen", keep=True)

    def those(wanted: DataFrame) -> DataFrame:
        return keyed.join(wanted, keyed[doc].eqNullSafe(wanted["doc"]) & keyed[key].eqNullSafe(wanted["tid"]), "left_semi")

    out, repeated = those(chosen.where("rows = 1")).select(docs.columns), chosen.where("rows > 1")
    if again := repeated.count():
        few = those(F.broadcast(repeated) if again <= BROADCAST_ROWS else repeated)
        out = out.unionByName(few.dropDuplicates([doc, key]).select(docs.columns))
    return out


#: ``link`` in DuckDB SQL: all pairs that share a shingle, and what each text reaches by links.
ORACLE = r"""WITH RECURSIVE doc AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (SELECT rid, w, unnest(range(greatest(1, len(w) - 3))) AS i FROM doc WHERE len(w) > 0),
gram AS (SELECT DISTINCT rid, array_to_string(w[i + 1:i + 4], ' ') AS s FROM placed),
size AS (SELECT rid, count(*) AS n FROM gram GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS n_both FROM gram a JOIN gram b USING (s) WHERE a.rid < b.rid GROUP BY 1, 2),
edge AS (SELECT x, y FROM shared JOIN size a ON a.rid = x JOIN size b ON b.rid = y WHERE 100 * n_both >= 85 * (a.n + b.n - n_both)),
both_ways AS (SELECT x, y FROM edge UNION ALL SELECT y, x FROM edge),
reach(x, y) AS (SELECT rid, rid FROM doc UNION SELECT r.x, e.y FROM reach r JOIN both_ways e ON r.y = e.x),
first AS (SELECT r.x AS rid, min(d.doc_id) AS component_id FROM reach r JOIN doc d ON d.rid = r.y GROUP BY r.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM doc LEFT JOIN size USING (rid) JOIN first USING (rid)"""
