"""Operator 9: byte-level BPE encoding and decoding from a table of ranks.

``fold_merges`` folds the ranked merges over the bytes of one pre-token: again and again the
adjacent pair with the lowest rank is joined.  ``Merges`` does the same fold on many pre-tokens in
lockstep, a join of each at every step.  Only distinct pieces are folded, once per worker
cache; a text's ids are the cached ids in order and its decoding is the concatenation of the
binary tokens, looked up by id.  ``higher_order_encode`` is the same fold as one Spark SQL
expression (``aggregate`` over the byte array with a literal rank map, dealt into small maps by
checksum); it gives the same ids, but some thirty times the time a word keeps it out of the budget
on whole tables (figures: README), so the query runs the Python fold.  One map over the rows: no shuffle.

Defined cases: null and empty texts have no ids (digests of the empty string); repeated rows give
repeated rows; other columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordCache, batch, groups_of_bytes, small_batches, worker_own
from .pretokens import cutter

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def fold_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token.  A heap of pairs keeps very long pre-tokens near-linear."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n > 64:
        return _fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(n)]
    far = 2**31 - 1  # ranks may have gaps
    costs = [ranks.get(parts[i] + parts[i + 1], far) for i in range(n - 1)]
    while costs:
        low = min(costs)
        if low == far:
            break
        i = costs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i < len(costs):
            costs[i] = ranks.get(parts[i] + parts[i + 1], far)
        if i:
            costs[i - 1] = ranks.get(parts[i - 1] + parts[i], far)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    import heapq

    n = len(word)
    end = list(range(1, n + 1))  # part i is word[i:end[i]]
    before, alive = list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n:
            continue
        j = end[i]
        if end[j] != stop:
            continue  # one of the two has grown since
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of small maps, a part's map at the crc32 of its hex string.

    The optimizer folds it into a constant once; a look-up is a checksum, an index and a map of a few entries."""
    maps: list[dict[str, int]] = [{} for _ in range(1 << max(4, len(ranks).bit_length()))]
    for k, r in ranks.items():
        name = k.hex().upper()
        maps[zlib.crc32(name.encode()) % len(maps)][name] = r
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")


def higher_order_encode(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a binary pre-token column by Spark's higher-order functions alone.

    State: the array of parts as hex strings.  Each step of the outer fold, one per byte, finds the
    lowest-ranked adjacent pair and joins its first place; steps after the last merge do nothing."""
    table, slots = rank_table(ranks), F.lit(1 << max(4, len(ranks).bit_length()))
    far = F.lit(2**31 - 1)
    text = F.hex(word)
    size = F.length(word)
    parts = F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(text, i * 2 - 1, F.lit(2)))).otherwise(F.array().cast("array<string>"))

    def look_up(x: Column) -> Column:
        return F.try_element_at(F.get(table, (F.crc32(x.cast("binary")) % slots).cast("int")), x)

    def rank(p: Column, i: Column) -> Column:
        return F.coalesce(look_up(F.concat(F.element_at(p, i), F.element_at(p, i + 1))), far)

    def step(p: Column, _: Column) -> Column:
        costs = F.when(F.size(p) > 1, F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: rank(p, i))).otherwise(F.array().cast("array<int>"))
        # the costs are named once: an array of one is folded over
        return F.aggregate(F.array(costs), p, lambda p, costs: joined(p, costs, F.coalesce(F.array_min(costs), far)))

    def joined(p: Column, costs: Column, low: Column) -> Column:
        at = F.array_position(costs, low).cast("int")
        both = F.concat(F.slice(p, F.lit(1), at - 1), F.array(F.concat(F.element_at(p, at), F.element_at(p, at + 1))), F.slice(p, at + 2, F.size(p)))
        return F.when(low < far, both).otherwise(p)

    merged = F.transform(F.aggregate(parts, parts, step), look_up)
    whole = look_up(text)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(merged)


def spread(pool: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The slices pool[start : start + n], one after the other."""
    return pool[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Merges:
    """The fold of many pre-tokens in lockstep: each step joins every word's lowest-ranked pair, the leftmost of equals."""

    FAR, EMPTY, SPIN = np.int32(2**31 - 1), np.uint64(2**64 - 1), np.uint64(0x9E3779B97F4A7C15)
    #: Words up to these lengths share a matrix; longer ones are folded alone.
    WIDTHS, ROWS = (5, 7, 9, 12, 16, 24, 40, 64), 4096

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.none = max(ranks.values(), default=0) + 1  # no part's id: stands before and after a word
        pairs = ((a, b, r) for w, r in ranks.items() for k in range(1, len(w)) if (a := ranks.get(w[:k])) is not None and (b := ranks.get(w[k:])) is not None)
        found = np.fromiter(chain.from_iterable(pairs), np.int64).reshape(-1, 3)
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, self.EMPTY), np.full(1 << bits, self.FAR, np.int32)
        keys, values = self._key(found[:, 0], found[:, 1]), found[:, 2]
        slot = self._slot(keys)
        while len(keys):  # open addressing: who finds its slot taken tries the next
            free = np.flatnonzero(self.keys[slot] == self.EMPTY)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            keys, values, slot = np.delete(keys, won), np.delete(values, won), (np.delete(slot, won) + 1) & self.mask

    def _key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) * (self.none + 1) + b).astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * self.SPIN >> self.shift).astype(np.int64)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of what pairs of parts make together, FAR for none."""
        keys = self._key(a, b)
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], self.FAR)
        on = np.flatnonzero((there != keys) & (there != self.EMPTY))
        while len(on):
            slot[on] = (slot[on] + 1) & self.mask
            there = self.keys[slot[on]]
            hit = there == keys[on]
            out[on[hit]] = self.values[slot[on[hit]]]
            on = on[~hit & (there != self.EMPTY)]
        return out

    def _matrix(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word) of words of at most that many bytes."""
        m, w = len(words), width + 2
        size = np.fromiter(map(len, words), np.int64, m)[:, None]
        parts = np.full((m, w), self.none, np.int32)
        parts[:, 1:-1] = self.single[np.frombuffer(b"".join([x.ljust(width, b"\0") for x in words]), np.uint8).reshape(m, width)]
        parts[np.arange(w)[None, :] > size] = self.none
        costs = np.full((m, w), self.FAR)
        costs[:, 1:-1] = self.joined(parts[:, 1:-1].ravel(), parts[:, 2:].ravel()).reshape(m, width)
        part, cost = parts.reshape(-1), costs.reshape(-1)
        after, before = np.arange(1, m * w + 1), np.arange(-1, m * w - 1)
        rows = np.arange(m)
        while len(rows):
            now = costs[rows]
            at = now.argmin(1)
            low = now[np.arange(len(rows)), at]
            on = low < self.FAR
            rows, low = rows[on], low[on]
            i = rows * w + at[on]
            j = after[i]
            stop, h = after[j], before[i]
            part[i], part[j], cost[j] = low, -1, self.FAR
            after[i], before[stop] = stop, i
            cost[i], cost[h] = self.joined(low, part[stop]), self.joined(part[h], low)
        left = (parts >= 0) & (parts != self.none)
        return parts[left], left.sum(1)

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word): what fold_merges says of words that are not in the table themselves."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        alone = len(words) < 16 or (self.single < 0).any()
        pool, n, start, base = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        for i in range(len(words)) if alone else np.flatnonzero(size > self.WIDTHS[-1]).tolist():
            ids = fold_merges(words[i], self.ranks)
            pool.append(np.array(ids, np.int32))
            n[i], start[i], base = len(ids), base, base + len(ids)
        least = 0
        for width in () if alone else self.WIDTHS:
            some = np.flatnonzero((size > least) & (size <= width))
            least = width
            for lo in range(0, len(some), self.ROWS):
                at = some[lo : lo + self.ROWS]
                ids, each = self._matrix([words[i] for i in at.tolist()], width)
                pool.append(ids)
                n[at], start[at], base = each, base + np.cumsum(each) - each, base + len(ids)
        return spread(np.concatenate(pool), start, n) if pool else np.zeros(0, np.int32), n


class Pieces:
    """Bounded memo from a piece to its ids, which lie one after the other in one array.

    ``trim`` ends the work on some texts: pieces of over ``longest`` signs are forgotten, and when the
    memo is over its limit the half learnt first stays."""

    def __init__(self, fill, limit: int, longest: int = 1000):
        self.fill, self.limit, self.longest, self.known = fill, limit, longest, {}
        self.start, self.n, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.kept = 0

    def places(self, wanted: list[str]) -> np.ndarray:
        """Where the distinct pieces stand in ``start`` and ``n``."""
        found = list(map(self.known.get, wanted))
        at = [i for i, x in enumerate(found) if x is None]
        if at:
            at.sort(key=lambda i: len(wanted[i]) > self.longest)
            missing = [wanted[i] for i in at]
            ids, n = self.fill(missing)
            for k, i in enumerate(at, len(self.n)):
                found[i] = k
            self.kept = len(self.n) + sum(len(x) <= self.longest for x in missing)
            self.known.update(zip(missing[: self.kept - len(self.n)], range(len(self.n), self.kept)))
            self.start, self.n, self.pool = np.append(self.start, len(self.pool) + np.cumsum(n) - n), np.append(self.n, n), np.append(self.pool, ids)
        return np.array(found, np.int64)

    def trim(self) -> None:
        keep = self.kept
        if keep > self.limit:
            keep = self.kept = self.limit // 2
            self.known = dict(islice(self.known.items(), keep))
        if keep < len(self.n):
            self.pool = self.pool[: self.start[keep]].copy()
            self.start, self.n = self.start[:keep].copy(), self.n[:keep].copy()


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.split, self.pieces, self.merges = regex.compile(pattern), cutter(pattern), Merges(ranks)
        self.binary = {i: b for b, i in ranks.items()}
        self.whole = {}
        for b, i in ranks.items():
            try:
                self.whole[b.decode()] = i
            except UnicodeDecodeError:
                pass
        every = range(max(self.binary, default=-1) + 1)
        self.decimal = pa.array([f"{i} " for i in every], pa.large_binary())
        self.table = pa.array([self.binary.get(i, b"") for i in every], pa.large_binary())
        self.heads = WordCache(self.of_heads, 20_000)
        self.rest = Pieces(self.of_rest, 250_000)

    def of_tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens, ids per pre-token): those in the vocabulary are looked up, the others folded once each."""
        found = list(map(self.whole.get, tokens))
        at = [i for i, x in enumerate(found) if x is None]
        n = np.ones(len(tokens), np.int64)
        if not at:
            return np.array(found, np.int32), n
        number = {t: k for k, t in enumerate(dict.fromkeys(tokens[i] for i in at))}
        ids, each = self.merges.fold([t.encode() for t in number])
        which = np.array([number[tokens[i]] for i in at])
        for i in at:
            found[i] = 0
        start = np.arange(len(tokens))
        n[at], start[at] = each[which], len(tokens) + (np.cumsum(each) - each)[which]
        return spread(np.append(np.array(found, np.int32), ids), start, n), n

    def of_heads(self, heads: list[str]) -> list[tuple[int, ...]]:
        """The ids of texts that encode by themselves."""
        split = [self.split.findall(x) for x in heads]
        ids, n = self.of_tokens(list(chain.from_iterable(split)))
        ends = np.append(0, np.cumsum(n))[np.cumsum([0, *map(len, split)])].tolist()
        return [tuple(ids[lo:hi].tolist()) for lo, hi in zip(ends, ends[1:])]

    def of_rest(self, rest: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids per piece): joined by single spaces they split as they do alone."""
        tokens = self.split.findall(" " + " ".join(rest))
        ids, n = self.of_tokens(tokens)
        ends = np.searchsorted(np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens))), np.cumsum([len(x) + 1 for x in rest]), "right")
        return ids, np.diff(np.append(0, np.cumsum(n))[ends], prepend=0)

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        heads, rest = zip(*map(self.pieces, texts), strict=True)
        found = self.heads.of([x for x in heads if x])
        head_ids, head_n = np.fromiter(chain.from_iterable(found), np.int32), np.zeros(len(texts), np.int64)
        head_n[[i for i, x in enumerate(heads) if x]] = list(map(len, found))
        flat = pa.array(list(chain.from_iterable(rest)), pa.large_string()).dictionary_encode()
        at = self.rest.places(flat.dictionary.to_numpy(zero_copy_only=False).tolist())[flat.indices.to_numpy()]
        counts = np.fromiter(map(len, rest), np.int64, len(texts))
        first = np.cumsum(counts) - counts + np.arange(len(texts))  # a text's head stands before its rest
        start, n, later = np.empty(len(at) + len(texts), np.int64), np.empty(len(at) + len(texts), np.int64), np.ones(len(at) + len(texts), bool)
        later[first] = False
        start[later], n[later] = self.rest.start[at], self.rest.n[at]
        start[first], n[first] = len(self.rest.pool) + np.cumsum(head_n) - head_n, head_n
        ids = spread(np.append(self.rest.pool, head_ids), start, n)
        self.rest.trim()
        return ids, np.add.reduceat(n, first)

    def encode(self, text: str) -> list[int]:
        return self.ids_of([text])[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.binary.__getitem__, ids))

    def digests_of(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, digest of the ids in decimal, digest of the decoded ids) of each text."""
        ids, n = self.ids_of(texts)
        ends, at = np.append(0, np.cumsum(n)), pa.array(ids)
        written, decoded = self._in_row(self.decimal.take(at), ends), self._in_row(self.table.take(at), ends)
        return [(k, hashlib.sha256(a[:-1]).hexdigest(), hashlib.sha256(b).hexdigest()) for k, a, b in zip(n.tolist(), written, decoded, strict=True)]

    @staticmethod
    def _in_row(values: pa.Array, ends: np.ndarray):
        """The bytes of the values between two ends, for each two."""
        _, offsets, data = values.buffers()
        data = memoryview(data or b"")
        edges = np.frombuffer(offsets, np.int64)[ends].tolist() if len(values) else [0] * len(ends)
        return [data[lo:hi] for lo, hi in zip(edges, edges[1:])]

    def digests(self, text: str) -> tuple[int, str, str]:
        return self.digests_of([text])[0]


#: Signs of text that are encoded at once.
GROUP = 1_000_000


def codec(path: str, pattern: str, ranks: dict[bytes, int] | None = None) -> Codec:
    return worker_own(("codec", path, pattern), lambda: Codec(ranks or load_ranks(path), pattern))


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(path))  # bounded: the vocabulary

    def run(batches):
        own = codec(path, pattern, shared.value)
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            found = [x for lo, hi in groups_of_bytes(texts, GROUP) for x in own.digests_of(texts[lo:hi])]
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            yield batch(OUT, doc_id=b.column("doc_id"), n_tokens=n, ids_sha256=ids, decoded_sha256=decoded)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def encode_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The documents with their token ids in a column ``token_ids``; a column of that name, whatever the case of its letters, is replaced."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    kept = [c for c in docs.columns if c.lower() != "token_ids"]

    def run(batches):
        own = codec(path, pattern, shared.value)
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            for lo, hi in groups_of_bytes(texts, GROUP):
                ids, n = own.ids_of(texts[lo:hi])
                every = pa.ListArray.from_arrays(np.append(0, np.cumsum(n)).astype(np.int32), pa.array(ids))
                for at in range(lo, hi, 100):
                    part = b.slice(at, min(100, hi - at))
                    yield pa.RecordBatch.from_arrays([*part.columns, every.slice(at - lo, part.num_rows)], names=[*part.schema.names, "token_ids"])

    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("token_ids", T.ArrayType(T.IntegerType()))
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
