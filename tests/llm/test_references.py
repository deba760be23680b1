"""Operators held against plain reference solutions and under tokenizer rules that no shortcut knows."""

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from lexloom.llm import byte_bpe, chat_format, interleave, language_id, sstable, token_counts

from .fixtures import SCHEMA, documents

ROWS = documents()
TEXTS = [r[1] or "" for r in ROWS]


def test_interleave_by_plain_sort(spark):
    """Every row's place, from one sort of each source and one of all rows."""
    sources: dict = {}
    for r in ROWS:
        text = (r[1] or "").encode()
        row = (r[0], len(text) + 8, zlib.crc32(text))
        key = int(hashlib.md5("|".join(map(str, (7, row[0], row[2], row[1]))).encode()).hexdigest()[:15], 16)
        sources.setdefault(r[3] or "", []).append((key, row[0], row[2], row[1]))
    order = sorted(((rank + 0.5) / len(rows), source, row) for source, rows in sources.items() for rank, row in enumerate(sorted(rows)))
    want, n = [], len(order)
    for at, (_, source, (_, doc_id, crc, size)) in enumerate(order):
        shard = at * 5 // n
        want.append((doc_id, size, crc, shard, at - (shard * n + 4) // 5, source))
    for bucket_rows in (3, 2048):
        got = interleave.interleave(spark.createDataFrame(ROWS, SCHEMA), 5, bucket_rows=bucket_rows)
        assert sorted(map(tuple, got.select("doc_id", "size", "text_crc32", "shard", "slot", "source").collect())) == sorted(want)


def test_ridge_against_the_dual_solution():
    """With every sample a landmark, Nyström features are exact: the scores are those of kernel ridge."""
    rng = random.Random(3)
    alphabets = {"a": "abcde fgh", "b": "efgh ijkl", "c": "mnop abq"}
    names = [lang for lang, n in (("a", 30), ("b", 20), ("c", 10)) for _ in range(n)]
    texts = ["".join(rng.choice(alphabets[lang]) for _ in range(60)) for lang in names]
    seen = np.zeros((len(texts), 1 << language_id.BITS), np.uint8)
    for row, text in zip(seen, texts, strict=True):
        language_id.presence(text, row)
    model = language_id.fit([(lang, np.packbits(v).tobytes()) for lang, v in zip(names, seen, strict=True)], len(texts), 1e-2)
    unit = seen / np.sqrt(seen.sum(axis=1, keepdims=True))
    kernel = unit @ unit.T
    languages = sorted(set(names))
    y = np.where(np.array(names)[:, None] == np.array(languages), 1.0, -1.0)
    weight = np.array([1 / names.count(lang) for lang in names])
    weight /= weight.mean()
    alpha = np.linalg.solve(kernel + 1e-2 * len(texts) / 100 * np.diag(1 / weight), y)
    asked = ["".join(rng.choice(rng.choice(list(alphabets.values()))) for _ in range(80)) for _ in range(40)]
    for text, (lang, score) in zip(asked, model.predict(asked), strict=True):
        language_id.presence(text, v := np.zeros(1 << language_id.BITS, np.uint8))
        scores = (unit @ (v / np.sqrt(v.sum()))) @ alpha
        assert score == pytest.approx(np.clip((scores.max() + 1) / 2, 0, 1), abs=1e-3)
        assert scores[languages.index(lang)] == pytest.approx(scores.max(), abs=2e-3)


def test_turns_are_parsed_from_their_marks():
    form, rng = chat_format.Template(), random.Random(8)
    signs = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>", "\\", "\n", " ", "<", "[", "a", "é"]
    for _ in range(3000):
        role = rng.choice(["system", "user", "assistant", "", "".join(rng.choices(signs, k=3))])
        text = "".join(rng.choices(signs, k=rng.randint(0, 7)))
        assert form.parse("".join(x for x, _ in form.segments(role, text))) == (role, text)


@pytest.fixture
def changed(tmp_path):
    """A copy of a tokenizer file with other rules."""

    def make(name: str, **rules):
        with open(P.path(name), encoding="utf-8") as f:
            spec = json.load(f)
        spec.update(rules)
        path = tmp_path / name
        path.write_text(json.dumps(spec), encoding="utf-8")
        return str(path)

    return make


def test_other_rules_go_to_the_library(changed):
    texts = [*TEXTS, "A b  c", "don't STOP\n\nnow 12345", "x" * 5000]
    bytes_path = changed("byte_bpe_50k.json", pre_tokenizer={"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": False})
    tok = token_counts.load_tokenizer(bytes_path)
    want = [len(tok.encode(x, add_special_tokens=False).ids) for x in texts]
    assert token_counts.Counter(bytes_path, P.PATTERN, token_counts.whole_tokens(bytes_path, P.PATTERN)).count(texts) == want
    words_path = changed("word_bpe_49k.json", normalizer={"type": "NFD"})
    tok, own = token_counts.load_tokenizer(words_path), sstable.WordIds(words_path)
    for x in texts:
        assert np.frombuffer(own.encode(x), f"<u{own.width}").tolist() == tok.encode(x, add_special_tokens=False).ids


def test_other_pattern_is_not_cut():
    import tiktoken

    path, pattern = P.path("byte_bpe_50k.tiktoken"), r"\w+ \w+|\s+|[^\s]"
    ranks = byte_bpe.load_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.Codec(ranks, pattern)
    for x in TEXTS:
        assert own.encode(x) == enc.encode_ordinary(x)
        assert own.digests(x)[0] == len(enc.encode_ordinary(x))
    assert max(map(len, own.heads.known)) <= own.heads.longest < max(map(len, TEXTS))
