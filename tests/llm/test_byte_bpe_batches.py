"""The lockstep fold and the memo of pieces against the plain fold, and what they may cost."""

import random
import time

import numpy as np
import public_tokenizers as P
import pytest

from lexloom.llm import byte_bpe


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))


def folded(ranks, words):
    ids, n = byte_bpe.Merges(ranks).fold(words)
    assert ids.dtype == np.int32 and len(n) == len(words)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_lockstep_fold_equals_plain_fold(ranks):
    rng = random.Random(8)
    words = [bytes(rng.choice(b" aabether ng\xc3\xa9\xd0\xb0,09\n") for _ in range(rng.choice([1, 2, 5, 6, 9, 23, 40, 63, 64, 65, 300]))) for _ in range(3000)]
    words += [b"a" * n for n in range(1, 70)] + [bytes([b, b]) for b in range(256)]
    words = [w for w in words if w not in ranks]
    assert folded(ranks, words) == [byte_bpe.fold_merges(w, ranks) for w in words]
    # a table that is no merge list: a later join may rank before the one that made it possible, and ids have gaps
    odd = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 50, b"bc": 40, b"abc": 3, b"aa": 7, b"aaa": 5, b"cab": 2, b"bcab": 9000}
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    words = [w for w in words if w not in odd]
    assert folded(odd, words) == [byte_bpe.fold_merges(w, odd) for w in words]
    # not every byte is a token of its own
    some = {b"a": 0, b"b": 1, b"ab": 2, b"xy": 3}
    assert folded(some, [b"abab", b"xy", b"axyb"] * 9) == [[2, 2], [3], [0, 3, 1]] * 9


def test_texts_together_are_as_texts_alone(ranks, monkeypatch):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(9)
    signs = ["a", "Zq", "été", "ж", "7", "42", "!", "'s", "'", " ", "  ", "\t", "\n", " ", "　", "\u0085", "\U0001f600", "é", "x" * 70, "y" * 1200]
    texts = ["", " ", "  ", "a ", " a", "\n a", *("".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(1500))]
    own = byte_bpe.Codec(ranks, P.PATTERN)
    own.rest.limit = 100  # so that the memo is cut again and again
    want = [enc.encode_ordinary(x) for x in texts]
    for size in (1, 7, 400):
        for lo in range(0, len(texts), size):
            ids, n = own.ids_of(texts[lo : lo + size])
            assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want[lo : lo + size]
            assert len(own.rest.known) == len(own.rest.n) <= 100 and max(map(len, own.rest.known), default=0) <= own.rest.longest
            assert len(own.rest.pool) == own.rest.n.sum()
    assert own.digests_of([]) == [] and own.ids_of([])[0].tolist() == []


def test_unseen_words_cost_little(ranks):
    """A word seen for the first time took over ten microseconds, most of a run's time."""
    rng = random.Random(10)
    texts = [" ".join("".join(rng.choices("etaoinshrdlucmfw", k=rng.randint(5, 11))) for _ in range(500)) for _ in range(120)]
    own = byte_bpe.Codec(ranks, P.PATTERN)
    own.digests_of(texts[:20])
    began = time.process_time()
    own.digests_of(texts[20:])
    took = time.process_time() - began
    began = time.process_time()
    for w in {w for x in texts[20:] for w in x.split(" ")}:
        byte_bpe.fold_merges(b" " + w.encode(), ranks)
    assert took < 0.8 * (time.process_time() - began)
