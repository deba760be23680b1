import collections
import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from lexloom.llm import graph, jaccard_join, suffix_dedup
from lexloom.llm.common import materialise

from .fixtures import SCHEMA, benchmark, documents

ROWS = documents(2)


def brute_cut(texts, length):
    seen, data = collections.Counter(), [(t or "").encode() for t in texts]
    for b in data:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), len(re.findall("1+", "".join("1" if g else "0" for g in gone))), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("length", [400, 120])
def test_suffix_dedup(spark, length):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    want = brute_cut([r[1] for r in ROWS], length)
    got = sorted(tuple(r) for r in suffix_dedup.digest(df, length).collect())
    assert got == sorted((r[0], *w[:4]) for r, w in zip(ROWS, want, strict=True))
    if length == 400:
        cut = suffix_dedup.strip(df, length)
        assert cut.columns == df.columns
        by_id = {r["doc_id"]: r for r in cut.collect()}
        for r, w in zip(ROWS, want, strict=True):
            assert by_id[r[0]]["text"] == (None if r[1] is None else w[4].decode("utf-8", "ignore"))
        assert suffix_dedup.digest(df.limit(0), length).count() == 0


def test_suffix_dedup_on_overlaps(spark):
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh ij") for _ in range(1500))
    texts = [base]
    for _ in range(40):  # pieces of the base at every phase, cut near the threshold
        lo, n = rng.randrange(900), rng.choice([395, 399, 400, 401, 407, 430, 520])
        texts.append("".join(rng.choice("klmnop") for _ in range(rng.randrange(50))) + base[lo : lo + n] + "".join(rng.choice("qrstuv") for _ in range(rng.randrange(300))))
    texts += ["z" * 900, "z" * 401, "yx" * 350]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in suffix_dedup.digest(df, 400).collect())
    assert got == [(i, *w[:4]) for i, w in enumerate(brute_cut(texts, 400))]


def test_anchor_blocks():
    rng = random.Random(9)
    data = bytes(rng.choice(b"abcdef") for _ in range((1 << 20) + 5000))
    stretch = suffix_dedup._stretch(400)
    at = suffix_dedup.anchors(suffix_dedup.Bytes(data), stretch)
    assert np.diff(at).max() <= stretch and at[0] < stretch
    cut = (1 << 20) - 3000
    part = suffix_dedup.anchors(suffix_dedup.Bytes(data[cut:]), stretch) + cut
    assert [x for x in at if x > cut + stretch] == [x for x in part if x > cut + stretch]


def sets_of(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    return out


def brute_link(rows):
    sets, parent = sets_of([r[1] for r in rows]), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                if a != b:
                    parent[a] = b
    least = collections.defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    return sorted((r[0], len(sets[i]), min(least[find(i)])) for i, r in enumerate(rows))


def near_copies(rng, n):
    rows = []
    for family in range(n):
        base = [f"w{family}_{k}" for k in range(rng.choice([3, 4, 6, 20, 60, 130]))]
        for _ in range(rng.randint(2, 14)):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randint(0, 2)] = [f"x{rng.randrange(10**6)}"] * rng.randint(0, 1)
            rows.append((len(rows), " ".join(w) + (" common passage of many words that a great many texts share" if rng.random() < 0.5 else "")))
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_jaccard_join(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(random.Random(block), 14)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in jaccard_join.link(df).collect()) == brute_link(rows)


def test_jaccard_join_awkward(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert sorted(tuple(r) for r in jaccard_join.link(df).collect()) == brute_link(ROWS)
    kept = jaccard_join.keep_first(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for d, _, c in brute_link(ROWS) if d == c}
    assert jaccard_join.link(df.limit(0)).count() == 0


def test_keep_first_keeps_one_row(spark):
    a, b = " ".join(f"w{i}" for i in range(120)), " ".join(f"v{i}" for i in range(90))
    near = a.replace("w60", "x")
    rows = [(1, a), (1, a), (2, near), (None, near), (None, a), (None, b), (None, b), (3, None), (3, None), (None, ""), (None, ""), (4, "lone"), (4, "other")]
    kept = jaccard_join.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = [(1, a), (None, b), (3, None), (None, ""), (None, ""), (4, "lone"), (4, "other")]
    assert collections.Counter(tuple(r) for r in kept) == collections.Counter(want)


def test_prefix_guarantees():
    for n in range(1, 400):
        assert jaccard_join.extra(n) <= jaccard_join.overlap(n) and jaccard_join.prefix_size(n) <= n
        for m in range(n, n * 100 // 85 + 1):
            assert jaccard_join.required(m) <= min(jaccard_join.extra(n), jaccard_join.extra(m))
            assert jaccard_join.required(n) <= jaccard_join.extra(n)


def test_components(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(200, 240)] + [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(300, k) for k in range(301, 400)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, tmp_path):
    """The stages' own rules: 5-word shingles at 80/100, repeats of 51 words or 400 bytes."""
    from .test_pipeline_stages import brute_strip, first_of_groups
    from .test_text_operators import brute_hits

    docs = spark.createDataFrame(ROWS, SCHEMA)
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    items = benchmark(ROWS)
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "token_ids"]
    rows = list({r[0]: r for r in ROWS if re.search(r"[^\W\d_]", r[1] or "")}.values())
    keep = set(first_of_groups([r[:2] for r in rows]))
    rows = [r for r in rows if r[0] in keep]
    want = []
    for r, t in zip(rows, brute_strip([r[1] for r in rows]), strict=True):
        words, hit, _ = brute_hits(t, items)
        if not (hit and 20 * len(hit) >= len(words)):
            want.append((r[0], t))
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted(want)
    stage = docs
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = materialise(f(spark, stage, str(tmp_path)), "t")
        assert stage.columns == docs.columns


def test_repeated_passages_are_counted(spark):
    """n_passages: maximal runs of 51 words or more that stand elsewhere, by brute force."""
    texts, seen = [r[1] or "" for r in ROWS], collections.Counter()
    words = [re.findall(r"[^ \t-\r]+", t) for t in texts]
    for w in words:
        seen.update(tuple(w[i : i + 51]) for i in range(len(w) - 50))
    want = []
    for r, w in zip(ROWS, words, strict=True):
        hit = [False] * len(w)
        for i in range(len(w) - 50):
            if seen[tuple(w[i : i + 51])] > 1:
                hit[i : i + 51] = [True] * 51
        want.append((r[0], len(re.findall("1+", "".join("01"[h] for h in hit)))))
    got = suffix_dedup.digest(spark.createDataFrame(ROWS, SCHEMA).repartition(3), 400, words=51)
    assert sorted((r["doc_id"], r["n_passages"]) for r in got.collect()) == sorted(want)
    assert sum(n for _, n in want) > 10


def test_word_hashes():
    words = [b"a", b"b", b"ab", b"ba", b"x" * 64, b"x" * 65, b"x" * 200, "ж".encode() * 40]
    h = suffix_dedup.word_hashes(b" \t".join(words) + b"\n a")
    assert len(set(h.tolist())) == len(words) and h[0] == h[-1]
    assert suffix_dedup.word_hashes(b"").size == suffix_dedup.word_hashes(b" \n").size == 0
