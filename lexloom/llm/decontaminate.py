"""Operator 4: benchmark decontamination with a generalised suffix automaton.

Items are read as a stream and dealt to blocks of at most ``BLOCK_WORDS`` words; a longer item is cut
into pieces that overlap by a window less a word.  Each block makes one automaton, whose size is at
most twice the block's words, and is broadcast alone: neither the driver nor an executor ever holds
more than two blocks, however many items there are.  With several blocks the documents pass through
one after the other, written between passes, and carry the hits found so far.

A text's words stream through the automaton and the longest suffix that is a substring of an item
is tracked.  Where it reaches the window, the last ``window`` words are hit and the state on the
suffix path that stands for exactly that many words names the items.  An item shorter than the
window counts where it occurs whole.  Words outside the items' vocabulary, and neighbouring pairs
of words that no item has, reset the automaton, so only stretches of known pairs as long as the
shortest window are streamed; the search for those is vectorised.  One map over the rows per block.

Defined cases: null texts and texts without words have no words, no hits and are clean; items that
are null, have no words or have no id are ignored; repeated items each count; repeated rows give
repeated rows; other columns, whatever their names, pass through ``drop_contaminated`` and
``strip_spans`` and are ignored by ``digest``; an empty table gives an empty result; with no items
nothing is contaminated."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batch, materialise, small_batches, unused

BLOCK_WORDS = 100_000
#: Bytes to words: A-Z become a-z, every other ASCII byte but digits and a-z becomes a space.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with what matching needs per state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.items = [(name, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for name, words in items if words]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        seen: list[set[int]] = [set()]
        for k, (_, words) in enumerate(self.items):
            last = 0
            for c in words:
                last = self._extend(last, c)
            state = 0
            for c in words:  # every prefix's state ends here in item k
                state = self.next[state][c]
                while len(seen) <= max(state, len(self.link) - 1):
                    seen.append(set())
                seen[state].add(k)
        while len(seen) < len(self.link):
            seen.append(set())
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                seen[self.link[s]] |= seen[s]
        short: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(self.items):
            if len(words) < window:
                state = 0
                for c in words:
                    state = self.next[state][c]
                short.setdefault(state, []).append((len(words), k))
        #: per state: the items of the window that ends here, and the short items on its suffix path
        self.at_window: list[tuple[int, ...]] = [()] * len(self.link)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= window:
                self.at_window[s] = self.at_window[up] if self.length[up] >= window else tuple(seen[s])
            self.short[s] = self.short[up] + tuple(short.get(s, ()))
        self.least = min([window, *(len(w) for _, w in self.items)])
        pairs = {a << 32 | b for _, words in self.items for a, b in zip(words, words[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Slices of the words that can hold a window: all words known and all pairs known."""
        known = ids >= 0
        if self.least == 1 or not len(ids):
            joined = known[1:] & known[:-1]
        else:
            joined = known[1:] & known[:-1]
            at = np.flatnonzero(joined)
            codes = ids[at].astype(np.int64) << 32 | ids[at + 1]
            place = np.searchsorted(self.pairs, codes)
            place[place == len(self.pairs)] = 0
            joined[at] = self.pairs[place] == codes if len(self.pairs) else False
        if self.least == 1:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], known.astype(np.int8), [0]))))
            return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], joined.astype(np.int8), [0]))))
        lo, hi = edges[::2], edges[1::2]
        wide = hi - lo >= self.least - 1
        return list(zip(lo[wide].tolist(), (hi[wide] + 1).tolist(), strict=True))

    def match(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit slices of the words, and the items whose windows occur."""
        spans, found, w = [], set(), self.window
        for lo, hi in self.stretches(ids):
            state = size = 0
            for i, c in enumerate(ids[lo:hi].tolist(), lo):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                following = self.next[state].get(c)
                if following is None:
                    state = size = 0
                    continue
                state, size = following, size + 1
                if size >= w:
                    spans.append((i + 1 - w, i + 1))
                    found.update(self.at_window[state])
                for n, k in self.short[state]:
                    if n <= size:
                        spans.append((i + 1 - n, i + 1))
                        found.add(k)
        return spans, found


def blocks(items: DataFrame, window: int) -> Iterator[Automaton]:
    """The automata of the benchmark, one bounded block of items at a time.

    An item is named by its place and id, so that its pieces in several blocks count once."""
    rows = items.selectExpr("cast(item_id as string) as item", "text").where("text is not null and item_id is not null").toLocalIterator()
    held, size = [], 0
    for k, r in enumerate(rows):
        words = words_of(r["text"])
        step = max(1, BLOCK_WORDS - window + 1)
        for at in range(0, max(1, len(words) - window + 1), step):
            piece = words[at : at + step + window - 1]
            if size and size + len(piece) > BLOCK_WORDS:
                yield Automaton(held, window)
                held, size = [], 0
            held.append((f"{k}:{r['item']}", piece))
            size += len(piece)
    if size:
        yield Automaton(held, window)


class Found:
    """What is known of a text: its number of words, which are hit, and the items that occur."""

    def __init__(self, text: str | None, hit: bytes | None = None, names: list[str] | None = None):
        self.words = words_of(text)
        self.hit = np.zeros(len(self.words), bool) if hit is None else np.unpackbits(np.frombuffer(hit, np.uint8), count=len(self.words)).astype(bool)
        self.names = set(names or ())

    def add(self, automaton: Automaton) -> None:
        get = automaton.vocab.get
        spans, found = automaton.match(np.fromiter(map(get, self.words, [-1] * len(self.words)), np.int32, len(self.words)))
        for lo, hi in spans:
            self.hit[lo:hi] = True
        self.names.update(automaton.items[k][0] for k in found)

    def items(self) -> list[str]:
        return sorted(x.split(":", 1)[1] for x in self.names)

    def contaminated(self) -> bool:
        return contaminated(len(self.words), int(self.hit.sum()))


def scan(docs: DataFrame, items: DataFrame, window: int, finish: Callable[[pa.RecordBatch, list[Found]], pa.RecordBatch], schema) -> DataFrame:
    """``finish`` of every batch of documents and what the whole benchmark finds in it."""
    small_batches(docs.sparkSession)
    context, columns = docs.sparkSession.sparkContext, docs.columns
    hit, names = unused(docs, "_hit"), unused(docs, "_items")

    def run(shared, first: bool, last: bool):
        def found_in(b):
            at = b.schema.get_field_index("text")
            before = [(None, None)] * b.num_rows if first else zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)
            for text, (bits, known) in zip(b.column(at).to_pylist(), before, strict=True):
                found = Found(text, bits, known)
                if shared is not None:
                    found.add(shared.value)
                yield found

        def passing(batches):
            for b in batches:
                found = list(found_in(b))
                own = b if first else b.select(range(b.num_columns - 2))
                if last:
                    yield finish(own, found)
                else:
                    more = [pa.array([np.packbits(x.hit).tobytes() for x in found], pa.binary()), pa.array([sorted(x.names) for x in found], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*own.columns, *more], names=[*own.schema.names, hit, names])

        return passing

    rest = blocks(items, window)
    block, carried, first = next(rest, None), docs, True
    between = T.StructType([*docs.schema.fields, T.StructField(hit, T.BinaryType()), T.StructField(names, T.ArrayType(T.StringType()))])
    while True:
        shared = None if block is None else context.broadcast(block)
        block = next(rest, None)
        if block is None:
            return carried.mapInArrow(run(shared, first, True), schema)
        carried = materialise(carried.mapInArrow(run(shared, first, False), between), "benchmark-pass")
        shared.unpersist()
        first = False


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def remove_spans(text: str, hit: np.ndarray) -> str:
    """The text without its hit words (and what separates neighbouring hit words)."""
    data = text.encode("utf-8", "surrogatepass")
    flags = np.frombuffer(data.translate(_TABLE), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    begin, end = edges[::2], edges[1::2]
    out, at, i = [], 0, 0
    while i < len(hit):
        if hit[i]:
            j = i
            while j + 1 < len(hit) and hit[j + 1]:
                j += 1
            out.append(data[at : begin[i]])
            at, i = int(end[j]), j
        i += 1
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])


def digest(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every whole text."""

    def finish(b, found):
        rows = [(len(x.words), int(x.hit.sum()), len(x.names), hashlib.sha256(",".join(x.items()).encode()).hexdigest(), x.contaminated()) for x in found]
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return batch(OUT, doc_id=b.column(0), n_words=cols[0], n_hit=cols[1], n_items=cols[2], items_sha256=cols[3], contaminated=cols[4])

    return scan(docs.selectExpr("cast(doc_id as long) doc_id", "text"), items, window, finish, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The clean documents, all columns as they are.  Documents past the coverage limit go."""
    return scan(docs, items, window, lambda b, found: b.filter(pa.array([not x.contaminated() for x in found], pa.bool_())), docs.schema)


def strip_spans(docs: DataFrame, items: DataFrame, window: int = 13, least_words: int = 1) -> DataFrame:
    """Documents with every hit run of at least ``least_words`` words cut out of the text."""

    def finish(b, found):
        at = b.schema.get_field_index("text")
        texts = []
        for text, x in zip(b.column(at).to_pylist(), found, strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], x.hit.astype(np.int8), [0]))))
            for lo, hi in zip(edges[::2], edges[1::2], strict=True):
                if hi - lo < least_words:
                    x.hit[lo:hi] = False
            texts.append(remove_spans(text, x.hit) if x.hit.any() else text)
        return b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return scan(docs, items, window, finish, docs.schema)


#: The digest in DuckDB SQL, window of 13 words.
ORACLE = r"""WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT * FROM (SELECT row_number() OVER () AS iid, item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0 AND item IS NOT NULL),
item_at AS (SELECT iid, item, w, least(13, len(w)) AS n, unnest(range(greatest(1, len(w) - 12))) AS i FROM item),
item_window AS (SELECT DISTINCT iid, item, n, array_to_string(w[i + 1:i + n], ' ') AS s FROM item_at),
doc_at AS (SELECT rid, w, n, unnest(range(greatest(0, len(w) - n + 1))) AS i FROM doc, (SELECT DISTINCT n FROM item_window)),
hit AS (SELECT rid, d.i, d.n, iid, item FROM (SELECT rid, n, i, array_to_string(w[i + 1:i + n], ' ') AS s FROM doc_at) d JOIN item_window USING (n, s)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, iid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated FROM doc LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)"""
