"""Operator 8: token counts by the whole-token shortcut.

Offline proof: every vocabulary string is encoded once by the library itself; those that come back
as exactly one token, and that the pre-token pattern leaves whole, form the whole-token table (its
size is that of the vocabulary, so shipping it to executors is bounded).  A pre-token found in the
table counts as one token without any merging; only the others go through the library's merges,
each distinct one once per worker cache.  One map over the rows: no shuffle.

Defined cases: null and empty texts have 0 bytes and 0 tokens; texts that hold a special string
are encoded whole by the library, as its default treats them, and so are all texts if the file's
rules or the pattern are not the ones that the shortcut is proven for; repeated rows give repeated rows;
other columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordCache, batch, small_batches, worker_own
from .pretokens import PATTERN, pieces, rules

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


#: Fixed value: the rules of a tokenizer file under which its pre-tokens are those of ``PATTERN``.
RULES = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "dropout": None}


def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_chars() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(path: str, pattern: str) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as one token and to be one pre-token."""
    import regex

    tok, chars, split = load_tokenizer(path), byte_chars(), regex.compile(pattern)
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    texts = {}
    for name, i in tok.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(chars[c] for c in name).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if text not in special and split.findall(text) == [text]:
            texts[text] = i
    names = list(texts)
    encoded = tok.encode_batch(names, add_special_tokens=False)
    return frozenset(t for t, e in zip(names, encoded, strict=True) if e.ids == [texts[t]])


class Counter:
    def __init__(self, path: str, pattern: str, whole: frozenset[str]):
        import regex

        self.tok, self.split, self.whole = load_tokenizer(path), regex.compile(pattern), whole
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.proven = pattern == PATTERN and rules(path) == RULES
        self.chars = {b: c for c, b in byte_chars().items()}
        self.merged = WordCache(self.merge)
        self.heads = WordCache(self.of_parts, 100_000)
        self.rest = WordCache(lambda words: self.of_parts([" " + w for w in words]))

    def merge(self, words: list[str]) -> list[int]:
        """Tokens of pre-tokens by the library's own merges over their bytes."""
        return [len(self.tok.model.tokenize("".join(map(self.chars.__getitem__, w.encode())))) for w in words]

    def of_parts(self, parts: list[str]) -> list[int]:
        """Tokens of texts that encode by themselves: whole tokens count one, the rest is merged."""
        split = [self.split.findall(p) for p in parts]
        rest = list({t for s in split for t in s if t not in self.whole})
        known = dict(zip(rest, self.merged.of(rest), strict=True))
        return [sum(1 if t in self.whole else known[t] for t in s) for s in split]

    def count(self, texts: list[str]) -> list[int]:
        counts = [0] * len(texts)
        cut = []
        for i, text in enumerate(texts):
            if not self.proven or any(s in text for s in self.special):
                counts[i] = len(self.tok.encode(text, add_special_tokens=False).ids)
            else:
                cut.append((i, *pieces(text)))
        for i, head, rest in cut:
            counts[i] = sum(self.rest.of(rest)) + (self.heads.of([head])[0] if head else 0)
        return counts


def worker_counter(path: str, pattern: str, whole: frozenset[str]) -> Counter:
    return worker_own(("counter", path, pattern), lambda: Counter(path, pattern, whole))


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(whole_tokens(path, pattern))

    def run(batches):
        counter = worker_counter(path, pattern, shared.value)
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            counts = counter.count(texts)
            yield batch(OUT, doc_id=b.column("doc_id"), n_bytes=[len(x.encode()) for x in texts], n_tokens=counts, over_limit=[n > limit for n in counts])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
