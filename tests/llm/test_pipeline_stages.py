import collections
import random
import re

import corpus_pipeline
from lexloom.llm import jaccard_join

from .fixtures import SCHEMA, documents
from .test_duplicates import near_copies


def linked(x, y):
    words = (re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in (x, y))
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words)
    return 100 * len(x & y) >= 80 * len(x | y)


def first_of_groups(rows):
    """The least id of every group of rows that 5-word shingles link at 80/100, by brute force."""
    label = {d: d for d, _ in rows}
    for d, x in rows:
        for e, y in rows:
            if d < e and label[d] != label[e] and linked(x, y):
                a, b = sorted((label[d], label[e]))
                label = {k: a if v == b else v for k, v in label.items()}
    return sorted(set(label.values()))


def test_stage_drops_copies_with_a_tenth_replaced(spark):
    base = [f"w{i}" for i in range(150)]
    near = base[:70] + [f"x{i}" for i in range(12)] + base[82:]  # 5 words: 130 of 162; 4 words: 132 of 162, under 85/100
    far = base[:70] + [f"y{i}" for i in range(20)] + base[90:]
    rows = [(0, " ".join(base)), (1, " ".join(near)), (2, " ".join(far)), *((i + 10, t) for i, t in near_copies(random.Random(5), 10))]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert linked(rows[0][1], rows[1][1]) and not linked(rows[0][1], rows[2][1])
    assert sorted(r["doc_id"] for r in kept.collect()) == first_of_groups(rows)


def test_prefix_guarantees_at_80():
    for n in range(1, 400):
        assert jaccard_join.prefix_size(n, 80) <= n
        for m in range(n, n * 100 // 80 + 1):
            assert jaccard_join.required(m, 80) <= min(jaccard_join.extra(n), jaccard_join.extra(m))


def brute_strip(texts):
    """The texts without the bytes of 51 repeated words or 400 repeated bytes."""
    seen, data = collections.Counter(), [(t or "").encode() for t in texts]
    words = [[(m[0], *m.span()) for m in re.finditer(rb"[^ \t-\r]+", b)] for b in data]
    windows = [[tuple(x[0] for x in w[i : i + 51]) for i in range(len(w) - 50)] for w in words]
    for b, w in zip(data, windows, strict=True):
        seen.update(b[i : i + 400] for i in range(len(b) - 399))
        seen.update(w)
    out = []
    for b, w, v in zip(data, words, windows, strict=True):
        gone = bytearray(len(b))
        spans = [(i, i + 400) for i in range(len(b) - 399) if seen[b[i : i + 400]] > 1]
        spans += [(w[i][1], w[i + 50][2]) for i, x in enumerate(v) if seen[x] > 1]
        if seen and data.count(b) > 1 and spans:
            spans = [(0, len(b))]
        for lo, hi in spans:
            gone[lo:hi] = b"\1" * (hi - lo)
        out.append(bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def test_stage_cuts_repeats_by_words(spark):
    rng = random.Random(4)

    def some(n):
        return [f"{rng.randrange(10**4)}" for _ in range(n)]

    passage, rows = some(80), []
    for n in (49, 50, 51, 52, 60, 80):  # 51 words of it are some 250 bytes
        at = rng.randrange(81 - n)
        rows.append((len(rows), rng.choice(["\n ", "\t", ""]).join([" ".join(some(30)) + " ", " ".join(passage[at : at + n]) + "  ", " ".join(some(40))])))
    lone = some(50)
    rows += [(len(rows) + i, " ".join(some(9) + lone + some(9))) for i in range(2)]
    rows += [(len(rows) + i, " ".join(some(60 + i) + passage[:51] + some(60))) for i in range(2)]
    rows += [(len(rows), "z " * 300), (len(rows) + 1, "no word borders" + "ж" * 500), (len(rows) + 2, "x" + "ж" * 500), (len(rows) + 3, None)]
    got = dict(corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect())
    assert [got[d] or "" for d, _ in rows] == brute_strip([t for _, t in rows])
    assert len(got[6].split()) == 68 and len(got[8].split()) == 120
    rows = documents(2)
    cut = corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in cut) == sorted(zip((r[0] for r in rows), brute_strip([r[1] for r in rows]), strict=True))


def test_stage_without_labels_keeps_letters(spark):
    rows = [(0, "some words", None), (1, "12 !", None), (2, "ж", None), (3, None, None), (4, "", None)]
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_stage_drops_languages_not_learnt(spark):
    rng, syllables = random.Random(9), {"en": ["th", "er", "on", "an", "re", "ing"], "de": ["sch", "ü", "ein", "ß", "keit", "zu"], "es": ["que", "lá", "do", "mo", "pu", "va"], None: ["łó", "wcz", "yk", "dzi", "ją", "mp"]}
    rows = [(i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(40)), lang) for i, lang in enumerate(["en", "de", "es", None] * 40)]
    rows += [(1000, "12 !", "en"), (1001, None, "en")]
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert sorted(map(tuple, kept.collect())) == [r for r in rows if r[0] < 1000 and r[2]]
