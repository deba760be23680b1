"""Text functions as Column -> Column; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that a palochka can follow, its glyphs and its Latin look-alikes.
UPPER_BASES, LOWER_BASES = "ТГКХЦЧ", "тгкхцч"
GLYPHS, LOOKALIKES = "Ӏӏ|ǀ", "Iil"
CYRILLIC = "[а-яёА-ЯЁӀӏ]"


def _replace(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, pattern, to)


def palochka(c: Column, lowered: bool = False) -> Column:
    """One palochka after a base letter, digits elsewhere; Latin words are left alone.

    A run of glyphs, look-alikes and ones after an upper (lower) base is one upper (lower) palochka;
    other glyphs are the digit 1; a run of look-alikes between non-Latin characters is ones.
    Every rule begins with a class of characters, which is quicker to look for than a place between them.
    lowered: the text has no upper-case letters, which saves a pass."""
    run = f"[{GLYPHS}{LOOKALIKES}1]+"
    if not lowered:
        c = _replace(c, f"([{UPPER_BASES}]){run}", "$1Ӏ")
    c = _replace(c, f"([{LOWER_BASES}]){run}", "$1ӏ")
    c = _replace(c, f"(?s)[{GLYPHS}](?<![{UPPER_BASES}{LOWER_BASES}].)", "1")
    return _replace(c, f"(?=[{LOOKALIKES}])(?:(?<![A-Za-z])(?=[{LOOKALIKES}]+(?![A-Za-z]))|(?!^)\\G)[{LOOKALIKES}]", "1")


def missing(c: Column) -> Column:
    """Null for what counts as missing: null and the empty string."""
    return F.nullif(c, F.lit(""))


def headword(word: Column, phrase: Column) -> Column:
    return F.coalesce(missing(word), missing(phrase), F.lit(""))


def roman(n: Column) -> Column:
    """Roman numeral; empty for zero, negative and null numbers."""
    # Numerals by decimal place.
    hundreds = ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"]
    tens = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"]
    ones = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
    n = n.cast("int")

    def place(table: list[str], unit: int) -> Column:
        return F.element_at(F.array(*map(F.lit, table)), (F.floor(n / unit) % 10 + 1).cast("int"))

    return F.when(n > 0, F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), place(hundreds, 100), place(tens, 10), place(ones, 1))).otherwise("")


def escape_html(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return F.coalesce(c, F.lit(""))


def url_quote(c: Column) -> Column:
    """Percent-encoding of everything but letters, digits and _.-~"""
    c = F.url_encode(c)
    for found, to in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        c = F.replace(c, F.lit(found), F.lit(to))
    return c


def anchor_base(c: Column) -> Column:
    return F.coalesce(missing(F.translate(c, " /", "__")), F.lit("_"))


def slug_base(c: Column) -> Column:
    return F.coalesce(missing(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")), F.lit("article"))


def collapse_blank_lines(c: Column) -> Column:
    """No white space at line ends, at most one blank line in a row, none around, one final newline."""
    c = _replace(c, r"\R", "\n")
    c = _replace(c, r"(?U)[\s&&[^\n]]+(?=\n|$)", "")
    c = _replace(c, r"\n{3,}", "\n\n")
    return F.concat(_replace(c, r"(?U)\A\s+|\s+\z", ""), F.lit("\n"))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def preview(c: Column, size: int = 160) -> Column:
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("…"))).otherwise(c)


def paragraphs(c: Column) -> Column:
    return F.filter(F.split(c, "\n"), lambda p: p.rlike(r"\S"))


def date_key(c: Column, size: int) -> Column:
    """The first characters of a date kept as text; a missing date is a dash."""
    return F.substring(F.coalesce(missing(c), F.lit("—")), 1, size)


def palochka_count(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, "Ӏӏ", ""))


def kind_label(c: Column, default: str = "файл") -> Column:
    return F.upper(F.coalesce(missing(c), F.lit(default)))


#: What a correction request says, by the kind of thing it is about.
REPORTS = {
    "entry": "Нашёл неточность в источнике {0}: {1}",
    "sentence": "Нашёл неточность в корпусе {0}, глава и предложение {1}",
    "material": "Нашёл неточность в корпусе {0}, материал и предложение {1}",
    "article": "Нашёл неточность в архиве {0}, запись «{1}»",
}


def report(kind: str, site: str, dataset: Column, page: Column, anchor: Column, what: Column) -> Column:
    """A correction request of one of the REPORTS kinds, percent-encoded for a mail or chat link."""
    before, after = REPORTS[kind].split("{0}")
    after, end = after.split("{1}")
    place = F.when(anchor == "", "").otherwise(F.concat(F.lit("#"), anchor))
    return url_quote(F.concat(F.lit(before), dataset, F.lit(after), F.coalesce(what, F.lit("")), F.lit(f"{end}\nссылка: {site}/"), dataset, F.lit("/"), page, place, F.lit("\nДолжно быть: ...")))
