"""Alphabets, digraph-aware tokens and sort keys, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import palochka

# Letters of the Avar alphabet written with two characters, and the three alphabets in order.
DIGRAPHS = ["гъ", "гь", "гӏ", "къ", "кь", "кӏ", "лъ", "тӏ", "хъ", "хь", "хӏ", "цӏ", "чӏ"]
AVAR = "а б в г гъ гь гӏ д е ё ж з и й к къ кь кӏ л лъ м н о п р с т тӏ у ф х хъ хь хӏ ц цӏ ч чӏ ш щ ъ ы ь э ю я".split()
RUSSIAN = list("абвгдеёжзийклмнопрстуфхцчшщъыьэюя")
ENGLISH = list("abcdefghijklmnopqrstuvwxyz")
UNKNOWN = 10_000


def alphabet(language: str) -> list[str]:
    return AVAR if language == "av" else ENGLISH if language == "en" else RUSSIAN


def _prepared(c: Column, language: str) -> tuple[Column, str]:
    """(lower-cased text, pattern of a letter)."""
    c = F.lower(F.coalesce(c, F.lit("")))
    return (palochka(c, lowered=True), f"(?s)(?:{'|'.join(DIGRAPHS)})|.") if language == "av" else (c, "(?s).")


def tokens(c: Column, language: str = "av") -> Column:
    """Letters of the lower-cased word; Avar digraphs are one letter, the longest match wins."""
    c, pattern = _prepared(c, language)
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def spaced(c: Column, language: str = "av") -> tuple[Column, Column]:
    """(the tokens of a whole text with one space between them, their number), without an array of letters."""
    c, pattern = _prepared(c, language)
    found = F.regexp_replace(c, pattern, "$0 ")
    number = F.length(found) - F.length(c)  # one space each
    return F.substring(found, F.lit(1), F.length(found) - 1), number.cast("long")


def rank(token: Column, language: str = "av") -> Column:
    """Place in the alphabet from 0; null for other characters."""
    return F.nullif(F.array_position(F.array(*map(F.lit, alphabet(language))), token), F.lit(0).cast("bigint")).cast("int") - 1


def sort_key(found: Column, language: str = "av") -> Column:
    """Array of ranks of a word's tokens: letters in alphabet order, anything else after them."""
    return F.transform(found, lambda t: F.coalesce(rank(t, language), F.lit(UNKNOWN) + F.ascii(t)))


def prefix(found: Column, size: int = 3) -> Column:
    return F.when(F.size(found) > 0, F.array_join(F.slice(found, 1, size), "")).otherwise("?")


def letter(of_prefix: Column, language: str = "av") -> Column:
    """First letter, read from the prefix anew."""
    found = tokens(of_prefix, language)
    return F.when(F.size(found) > 0, F.get(found, F.lit(0))).otherwise("?")
