import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from lexloom.llm import byte_bpe, chat_format, chroma, decontaminate, interleave, language_id, sstable, token_counts

from .fixtures import SCHEMA, benchmark, documents

ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_token_counts(docs, empty):
    path = P.path("byte_bpe_50k.json")
    tok = token_counts.load_tokenizer(path)
    want = sorted(((r[0], len((r[1] or "").encode()), n := len(tok.encode(r[1] or "", add_special_tokens=False).ids), n > 512) for r in ROWS), key=str)
    assert rows(token_counts.count_tokens(docs, path, P.PATTERN), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(empty, path, P.PATTERN).count() == 0


def test_byte_bpe(docs, empty):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.load_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in ROWS:
        ids = enc.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert rows(byte_bpe.encode_digests(docs, path, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    got = {r["doc_id"]: r["token_ids"] for r in byte_bpe.encode_ids(docs, path, P.PATTERN).collect()}
    assert got == {r[0]: enc.encode_ordinary(r[1] or "") for r in ROWS}
    assert byte_bpe.encode_digests(empty, path, P.PATTERN).count() == 0
    rng = random.Random(4)
    for n in (1, 5, 64, 65, 700, 5000):
        word = bytes(rng.choice(b"aabther ng\xc3\xa9") for _ in range(n))
        assert byte_bpe._fold_long(word, ranks) == enc._encode_single_piece(word)
        assert byte_bpe.fold_merges(word, ranks) == enc._encode_single_piece(word)


def test_higher_order_fold(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"th": 256, b"he": 257, b"the": 258, b"re": 259, b"there": 260, b"er": 261}
    words = [b"", b"t", b"there", b"thethe", b"hhere", b"rerere", b"x\xc3\xa9"]
    df = spark.createDataFrame([(w,) for w in words], "w binary")
    got = [r[0] for r in df.select(byte_bpe.higher_order_encode(F.col("w"), ranks)).collect()]
    assert got == [byte_bpe.fold_merges(w, ranks) if w else [] for w in words]
    ranks = {k: r for k, r in byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")).items() if r < 3000}
    rng = random.Random(6)
    words = [w for w in {bytes(rng.choice(b"etaoin shr\xc3\xa9\xd0\xb0") for _ in range(rng.randint(1, 24))) for _ in range(300)}]
    df = spark.createDataFrame([(w,) for w in words], "w binary")
    for r in df.select("w", byte_bpe.higher_order_encode(F.col("w"), ranks).alias("ids")).collect():
        assert r["ids"] == byte_bpe.fold_merges(bytes(r["w"]), ranks)


def test_sstable(spark, docs, empty):
    path = P.path("word_bpe_49k.json")
    tok = token_counts.load_tokenizer(path)
    got = rows(sstable.store_and_read(docs, path), "start", "doc_id", "n_tokens", "ids_crc32")
    start, want = 0, []
    for r in sorted(ROWS, key=lambda r: (r[0], r[1] or "")):
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((start, r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want, key=str)
    assert sstable.store_and_read(empty, path).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (-5, "b"), (7, "c")], "doc_id long, text string")
    assert [r[0] for r in sstable.store_and_read(nulls, path).orderBy("start").collect()] == [None, -5, 7]


def test_sstable_lookup(spark, docs):
    from lexloom.llm.common import fresh_path

    path = P.path("word_bpe_49k.json")
    tok = token_counts.load_tokenizer(path)
    manifest = sstable.write_shards(docs, path, fresh_path(spark, "sst"), 2, shard_bytes=4000).collect()
    assert len(manifest) > 3
    shards = [(m, sstable.Reader(m["path"])) for m in manifest]
    assert all(s.verify() and s.rows == m["rows"] and s.ids == m["ids"] for m, s in shards)
    by_id = collections.defaultdict(list)
    for r in ROWS:
        by_id[r[0]].append([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2])
    for doc_id in [*by_id, 1, -9, 10**12]:
        assert sorted(x for _, s in shards for x in s.lookup(doc_id)) == sorted(by_id.get(doc_id, []))


def brute_hits(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def low(x):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))

    words, hit, found = low(text), set(), set()
    for name, item in items:
        w = low(item)
        for k in range(max(1, len(w) - 12)) if w else []:
            window = w[k : k + 13]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(name))
    return words, hit, sorted(found)


def test_decontamination(spark, docs, empty):
    items = benchmark(ROWS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = [(1, "zero ONE, two three"), (2, "two"), (3, "one x two")]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = []
    for doc_id, text in [*((r[0], r[1]) for r in ROWS), *extra]:
        words, hit, found = brute_hits(text, items)
        want.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    assert rows(decontaminate.digest(more, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want, key=str)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    dirty = {w[0] for w in want if w[-1]}
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in ROWS} - dirty
    cut = {r["doc_id"]: r["text"] for r in decontaminate.strip_spans(docs, bench).collect()}
    for r in ROWS:
        assert not brute_hits(cut[r[0]], [i for i in items if i[0] >= 10])[1]
    assert decontaminate.digest(empty, bench).count() == 0
    assert decontaminate.digest(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_chat_format(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "</s>[INST] ok [/INST]\\"), (1, 2, "assistant", "[\\INST] <s>\\\\ é"), (2, 0, "assistant", None), (2, 1, None, "x"), (3, 1, "user", ""), (3, 1, "user", ""), (None, 0, "tool<s>", "q")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chats(df)
    form = chat_format.Template()
    for r in formatted.collect():
        assert not form.holds_control(r["segments"][1]["text"])
    got = {r["conv_id"]: r for r in chat_format.read_chats(formatted).collect()}
    for conv in (1, 2, 3, None):
        own = [t for t in turns if t[0] == conv]
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [got[c]["valid"] for c in (1, 2, 3, None)] == [True, False, False, False]
    assert chat_format.read_chats(chat_format.format_chats(df.limit(0))).count() == 0
    rng = random.Random(6)
    for _ in range(2000):
        s = "".join(rng.choice(["<s>", "[", "INST]", "\\", "<<", "SYS>>", "</s>", "a", "<", "/"]) for _ in range(rng.randint(0, 8)))
        assert form.unescape(form.escape(s)) == s and not form.holds_control(form.escape(s))


def test_interleave(docs, empty):
    got = interleave.interleave(docs, 7, bucket_rows=5).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    shards = collections.defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    assert sorted(shards) == list(range(7)) and all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    mixed = collections.Counter((r["shard"], r["source"]) for r in got)
    sizes = collections.Counter(r["source"] for r in got)
    assert all(abs(mixed[s, x] - sizes[x] / 7) < 2 for s in range(7) for x in sizes)
    again = interleave.interleave(docs.repartition(5), 7, bucket_rows=1000).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    assert interleave.interleave(empty, 7).count() == 0


def test_language_id(spark, docs, empty):
    model = language_id.train(docs, 200, 32)
    got = language_id.predict(docs, model).collect()
    truth = {r[0]: (r[1], r[2]) for r in ROWS}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        if not re.search(r"[^\W\d_]", truth[r["doc_id"]][0] or ""):
            assert r["lang_pred"] == "und"
    clear = [r for r in got if len((truth[r["doc_id"]][0] or "").split()) > 20]
    assert sum(r["lang_pred"] == truth[r["doc_id"]][1] for r in clear) >= 0.95 * len(clear)
    assert language_id.keep_known(docs, model).count() == sum(bool(re.search(r"[^\W\d_]", r[1] or "")) for r in ROWS)
    assert language_id.predict(empty, model).count() == 0
    none = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}


def test_chroma(spark):
    rng = np.random.default_rng(3)

    def tune(n, seed):
        g = np.random.default_rng(seed)
        t = np.arange(400) / chroma.SHORT.rate
        return np.concatenate([np.sin(2 * np.pi * 220 * 2 ** (g.integers(0, 30) / 12) * t) for _ in range(n)])

    def pcm(x):
        return ((np.clip(x, -1, 1) * 120) + 128).astype(np.uint8).tobytes()

    whole = tune(60, 1)
    media = [(1, pcm(whole)), (2, pcm(whole)), (3, pcm(whole[chroma.SHORT.hop * 40 :])), (4, pcm(whole + rng.normal(0, 0.01, len(whole)))), (5, pcm(tune(60, 2))), (6, None), (7, b""), (8, b"abc"), (9, pcm(whole)), (9, pcm(whole))]
    df = spark.createDataFrame(media, "doc_id long, pcm binary")
    got = {r["doc_id"]: r for r in chroma.match(df, "pcm").collect()}
    assert got[2]["class_id"] == got[9]["class_id"] == 1 and got[2]["codes_crc32"] == got[1]["codes_crc32"]
    assert got[3]["match_id"] == 1 and got[3]["match_offset"] == 40 and got[3]["bit_error"] == 0 and got[3]["aligned"]
    assert got[4]["aligned"] and got[4]["match_offset"] == 0 and not got[5]["aligned"]
    assert [got[i]["n_codes"] for i in (6, 7, 8)] == [0, 0, 0] and got[6]["match_id"] is None
    assert chroma.match(df.limit(0), "pcm").count() == 0
    image = chroma.chroma(whole / 1.0)
    codes = chroma.codes_of(image)
    for at in (0, 17, len(codes) - 1):  # the integral image against plain sums
        code = 0
        for kind, y, height, width in chroma.filters():
            part, half, mid, third = image[at : at + width], width // 2, y + height // 2, max(1, width // 3)
            top = y + height
            s = lambda x0, x1, y0, y1: int(part[x0:x1, y0:y1].sum())
            a, b = [(s(0, width, y, mid), s(0, width, mid, top)), (s(0, half, y, top), s(half, width, y, top)), (s(0, half, y, mid) + s(half, width, mid, top), s(0, half, mid, top) + s(half, width, y, mid)), (s(third, width - third, y, top), s(0, third, y, top) + s(width - third, width, y, top))][kind]
            ratio = np.log((chroma.SCALE + a) / (chroma.SCALE + b))
            code = code << 2 | [0, 1, 3, 2][int(ratio > -0.25) + int(ratio > 0) + int(ratio > 0.25)]
        assert code == codes[at]
    x, y = rng.integers(0, 5, 60).astype(np.uint32), rng.integers(0, 5, 40).astype(np.uint32)
    seed = chroma.SEED
    x, y = np.tile(x[:20], 4), np.concatenate([y, x[5:25]])
    votes = collections.Counter(i - j for i in range(len(x) - seed + 1) for j in range(len(y) - seed + 1) if (x[i : i + seed] == y[j : j + seed]).all())
    assert chroma.align(x, y)[0] == max(votes.values())
    assert chroma.fingerprint(pcm(tune(400, 3)), chroma.Shape(8000, 1024, 256, 8))[0] == 1 + (160_000 - 1024) // 256


def brute_groups(media):
    """The least id of every group of recordings linked by the rule, by all pairs."""
    codes, label = {d: chroma.fingerprint(x)[1] for d, x in media}, {d: d for d, _ in media}
    for d, x in media:
        for e, y in media:
            if d < e and label[d] != label[e]:
                votes, _, wrong, overlap = chroma.align(codes[d], codes[e])
                if x and x == y or len(codes[d]) and (codes[d].tobytes() == codes[e].tobytes() or votes and chroma.linked(codes[d], codes[e], votes, wrong, overlap)):
                    a, b = sorted((label[d], label[e]))
                    label = {k: a if v == b else v for k, v in label.items()}
    return label


def test_chroma_groups_by_brute_force(spark):
    rng = random.Random(12)
    syllables = ["th", "er", "on ", "an", "re", "ing "]
    base = ["".join(rng.choice(syllables) for _ in range(700)) for _ in range(3)]
    texts = [*base, base[0], None, "", "short"]
    for i in range(40):  # clips, copies with a stretch replaced, clips of two recordings in a row
        x, y = rng.choice(base), rng.choice(base)
        lo = rng.randrange(20) * 32
        clip = x[lo : lo + rng.randrange(640, 1700)]
        at = rng.randrange(len(clip) - 40)
        texts.append([clip, clip[:at] + "#" * 40 + clip[at + 40 :], clip + y[: rng.randrange(800)], "~" * rng.randrange(40) + clip][i % 4])
    texts += ["\0" * 900, "\0" * 1500, "ab" * 700, "ab" * 400]
    media = [(i * 2 + 1, x if x is None else x.encode()) for i, x in enumerate(texts)]
    df = spark.createDataFrame([(d, x, "c", 1) for d, x in media], "doc_id long, pcm binary, codes string, Recording int").repartition(3)
    got = {r["doc_id"]: r for r in chroma.match(df, "pcm").collect()}
    want = brute_groups(media)
    assert {d: r["group_id"] for d, r in got.items()} == want
    data = {d: chroma.fingerprint(x)[1] for d, x in media}
    for d, r in got.items():
        if r["aligned"]:
            votes, offset, wrong, overlap = chroma.align(data[r["match_id"]], data[d])
            assert (votes, offset) == (r["match_votes"], r["match_offset"]) and want[d] == want[r["match_id"]] and abs(wrong / 32 / overlap - r["bit_error"]) < 1e-5
    assert sum(r["aligned"] for r in got.values()) > 15


def test_decontaminate_in_blocks(spark, docs, monkeypatch):
    bench = spark.createDataFrame([*benchmark(ROWS), (13, ROWS[1][1]), (13, ROWS[1][1])], "item_id long, text string").coalesce(1)
    want = rows(decontaminate.digest(docs, bench), "*")
    clean = rows(decontaminate.drop_contaminated(docs, bench), "doc_id")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 25)
    assert len(list(decontaminate.blocks(bench, 13))) > 5
    assert rows(decontaminate.digest(docs, bench), "*") == want
    assert rows(decontaminate.drop_contaminated(docs, bench), "doc_id") == clean


def test_chroma_classes_short_recordings(spark):
    short = bytes(range(100, 200)) * 6
    media = [(3, short), (1, short), (2, short[:-1]), (4, b"ab"), (5, b"ab"), (6, b""), (7, b""), (8, None), (9, short + bytes(8))]
    got = {r["doc_id"]: r for r in chroma.match(spark.createDataFrame(media, "doc_id long, pcm binary"), "pcm").collect()}
    assert {d: r["class_id"] for d, r in got.items()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9}
    assert [got[d]["n_codes"] for d in (1, 3, 9)] == [0, 0, 1] and got[3]["match_id"] is None and not got[3]["aligned"]


def test_ranks_file_is_whole():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        assert byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")) == {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
