"""Operator 5: chat formatting by a finite-state machine over roles.

A declarative template gives each role its opening and closing marks, whether its text bears loss,
and the state machine's transitions.  Control strings (all marks of the template) inside texts are
escaped reversibly: every backslash is doubled and a backslash is put after the first character of
each control string, so no control string is left inside a text and unescaping is exact.

Turns are dealt out by conversation, sorted by turn, and streamed: a conversation's state (machine
state, running digests) is a few hundred bytes, so one that holds a third of all rows needs no
more memory than a short one.  Output: one row per turn with its segments and their loss flags.

Defined cases: a null text is empty, a null role is the empty role; roles that the template does
not know are marked by name and make the conversation invalid, as does any turn out of order;
turns that tie are ordered by role and text; a null conv_id is a conversation of its own; repeated
rows are turns of their own; other columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches

TEMPLATE = {
    "roles": {
        "system": {"open": "<<SYS>>\n", "close": "\n<</SYS>>\n", "loss": False},
        "user": {"open": "[INST] ", "close": " [/INST]", "loss": False},
        "assistant": {"open": "<s> ", "close": " </s>", "loss": True},
    },
    "other": {"open": "<<ROLE>>{role}<</ROLE>>\n", "close": "\n<</TURN>>\n", "loss": False},
    "controls": ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>"],
    "start": "start",
    "moves": {"start": {"system": "briefed", "user": "asked"}, "briefed": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}},
    "ends": ["answered"],
}


class Template:
    def __init__(self, spec: dict = TEMPLATE):
        self.spec = spec
        strings = sorted(spec["controls"], key=len, reverse=True)
        self._escape = re.compile(r"\\|" + "|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in strings))
        self._control = re.compile("|".join(map(re.escape, strings)))

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def holds_control(self, text: str) -> bool:
        return self._control.search(text) is not None

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as (formatted text, loss flag) segments."""
        how = self.spec["roles"].get(role) or self.spec["other"]
        return [(how["open"].replace("{role}", self.escape(role)), False), (self.escape(text), how["loss"]), (how["close"], False)]

    def parse(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn, told by its marks alone: openings differ from their first
        signs on, and neither a role nor a text holds a control string."""
        for role, how in self.spec["roles"].items():
            if formatted.startswith(how["open"]):
                return role, self.unescape(formatted[len(how["open"]) : -len(how["close"])])
        before, after = self.spec["other"]["open"].split("{role}")
        role, _, rest = formatted.removeprefix(before).partition(after)
        return self.unescape(role), self.unescape(rest[: -len(self.spec["other"]["close"])])

    def move(self, state: str | None, role: str) -> str | None:
        """The next state, or None once the turn order is broken."""
        return None if state is None else self.spec["moves"].get(state, {}).get(role)


def _turns(batches, names: tuple[str, ...]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in names), strict=True)


def _chunks(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == most:
            yield batch(schema, **dict(zip(schema.names, zip(*held, strict=True), strict=True)))
            held = []
    if held:
        yield batch(schema, **dict(zip(schema.names, zip(*held, strict=True), strict=True)))


SEGMENT = pa.struct([("text", pa.string()), ("loss", pa.bool_())])
FORMATTED = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("state", pa.string()), ("segments", pa.list_(SEGMENT))])


def by_conversation(df: DataFrame, *order: str) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *order)


def format_chats(turns: DataFrame, spec: dict = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, turn_no, machine state (null: broken), segments with loss flags."""
    small_batches(turns.sparkSession)
    cast = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        form = Template(spec)

        def rows():
            current, state, n = object(), None, 0
            for conv, role, text in _turns(batches, ("conv_id", "role", "text")):
                if conv != current:
                    current, state, n = conv, spec["start"], 0
                state = form.move(state, role)
                yield conv, n, state, [{"text": t, "loss": loss} for t, loss in form.segments(role, text)]
                n += 1

        yield from _chunks(rows(), FORMATTED)

    return by_conversation(cast, "turn", "role", "text").mapInArrow(run, "conv_id long, turn_no long, state string, segments array<struct<text:string,loss:boolean>>")


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])


def read_chats(formatted: DataFrame, spec: dict = TEMPLATE) -> DataFrame:
    """Per conversation, from the formatted rows alone: turns parsed out of their marks, loss text by its flags."""
    small_batches(formatted.sparkSession)

    def run(batches):
        form = Template(spec)

        def rows():
            current, held = object(), None
            for conv, state, segments in _turns(batches, ("conv_id", "state", "segments")):
                if conv != current:
                    if held:
                        yield done(held)
                    current, held = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, None]
                role, text = form.parse("".join(s["text"] for s in segments))
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    held[5] += len(s["text"])
                    if s["loss"]:
                        plain = form.unescape(s["text"])
                        held[3] += len(plain)
                        held[4].update(plain.encode())
                held[6] = state
            if held:
                yield done(held)

        def done(h):
            return h[0], h[1], h[2].hexdigest(), h[3], h[4].hexdigest(), h[5], h[6] in spec["ends"]

        yield from _chunks(rows(), DIGESTS)

    return by_conversation(formatted, "turn_no").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


#: DuckDB: what op5 returns.  Each backslash and each control string adds one character.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 20 + 11 + length(role) END
         + length(text) + length(text) - length(replace(text, '\', ''))
         + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<ROLE>>|<</ROLE>>|<</TURN>>')) AS chars,
         coalesce(lag(role) OVER w, 'start') AS before, row_number() OVER w AS k, lead(role) OVER w IS NULL AS final
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
         AND bool_or(final AND role = 'assistant') AS valid
FROM m GROUP BY conv_id
"""
