"""Splitting of text at places where byte-level BPE tokens provably never cross.

The pre-token pattern lets at most one space lead a run of letters, digits or other signs, and a
white-space run always leaves its last space to what follows.  So every single space that is
followed by something other than white space starts a new pre-token, wherever it stands: the text
between two such places encodes alone as it does in the text.  That is a property of one pattern,
so it is looked up when a tokenizer is loaded; with other rules texts are not cut here at all."""

from __future__ import annotations

import json
import re

#: Fixed value: the pre-token pattern that this holds for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_BOUNDARY = re.compile(r"(?= \S)")
_UNEVEN = re.compile(r" (?:\s|\Z)")


def uncut(text: str) -> tuple[str, list[str]]:
    """The text as one piece: for patterns that nothing is proven of."""
    return text, []


def cutter(pattern: str):
    """How texts are cut before the pattern splits them."""
    return pieces if pattern == PATTERN else uncut


def rules(path: str) -> dict:
    """What a tokenizer file says of normalising and splitting, and whether its merges are random."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = dict(spec.get("pre_tokenizer") or {})
    split.pop("trim_offsets", None)
    return {"normalizer": spec.get("normalizer"), "pre_tokenizer": split, "dropout": spec["model"].get("dropout")}


def pieces(text: str) -> tuple[str, list[str]]:
    """(head, rest): the text is ``head + "".join(" " + x for x in rest)`` and each of these parts
    encodes by itself.  In ``rest`` the leading space is left out."""
    if _UNEVEN.search(text):
        head, *rest = _BOUNDARY.split(text)
        return head, [x[1:] for x in rest]
    head, *rest = text.split(" ")
    return head, rest
