"""Text-cleaning rules as ordered tables of patterns, and the mechanisms for hand-made corrections.

Each rule is a Column -> Column function; ``apply_rules`` runs an ordered table of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import CYRILLIC, palochka

Rule = Callable[[Column], Column]


def regex(pattern: str, to: str) -> Rule:
    return lambda c: F.regexp_replace(c, pattern, to)


# Latin letters and the Cyrillic letters that look the same.  B is left to the
# correction table: it stands for two letters.
LATIN_TWINS, CYRILLIC_TWINS = "xapoeyctkhmrXAPOECTKHM", "хароеусткнмгХАРОЕСТКНМ"

footnote_digits = regex(r"(?<=[а-яёА-ЯЁӀӏ])[0-9]+", "")
# A run after a digit is taken whole: each sign at a digit or where the last match ended.
numeric_palochka = regex(r"[Ӏӏ](?=[0-9Ӏӏ]*[0-9])(?<![а-яёА-ЯЁ].)|(?:(?<=[0-9])|(?!^)\G)[Ӏӏ]", "1")
hyphen_suffix = regex(r"([A-Za-z]{2,})([а-яёӏ]{2,})", "$1-$2")
control_chars = regex(r"[\x00-\x1f\x7f-\x9f]", "")
dot_split = regex(rf"(?<={CYRILLIC}{{4}})\.(?={CYRILLIC})", ". ")
initial_split = regex(rf"([А-ЯЁӀ]\.)({CYRILLIC}{{4,}})", "$1 $2")
inner_underscore = regex(rf"(?<={CYRILLIC})_(?={CYRILLIC})", "")
slash_spaces = regex(r"\s*/\s*", " / ")
optional_spaces = regex(r"\s+", "")


def one_sign_palochka(c: Column) -> Column:
    return F.translate(c, "Ⅰ", "ӏ")


def dzhe(c: Column) -> Column:
    """The single letter U+045F to two letters; the combining breve goes."""
    return F.replace(F.replace(c, F.lit("џ"), F.lit("дж")), F.lit("̆"), F.lit(""))


def stem(c: Column) -> Column:
    """No inner spaces and no combining accents."""
    return F.regexp_replace(c, "[\\s̀́]+", "")


#: Roman numerals and vitamins that palochka rules took for letters; order matters.
ROMAN_REPAIR: list[Rule] = [regex(r"\bХӏХ\b", "ХIХ"), regex(r"\bВӏ\b", "В1"), regex(r"\bӏХ\b", "IХ"), regex(r"\bӀ-", "1-")]
OCR: list[Rule] = [regex(r"вьш", "вып"), regex("<", "("), regex(">", ")"), regex(r"\^", ""), regex(r"\\ ", "; ")]


def apply_rules(c: Column, rules: list[Rule]) -> Column:
    for rule in rules:
        c = rule(c)
    return c


def homoglyphs(c: Column) -> Column:
    """In tokens that mix scripts, look-alike Latin letters become Cyrillic; Latin words stay.

    Only texts that hold such a token are taken apart."""
    def fix(t: Column) -> Column:
        mixed = t.rlike("[A-Za-z]") & t.rlike(CYRILLIC)
        alike = t.rlike(f"^[{LATIN_TWINS}IilǀӀӏ|1]+$") & t.rlike("[xXTKHktчц][Iil|]")
        return F.when(mixed | alike, palochka(F.translate(t, LATIN_TWINS, CYRILLIC_TWINS))).otherwise(t)

    cyrillic, latin = CYRILLIC.strip("[]"), "A-Za-z"
    mixed = f"[^ {latin}{cyrillic}]*+(?:[{latin}][^ {cyrillic}]*+[{cyrillic}]|[{cyrillic}][^ {latin}]*+[{latin}])"
    alike = rf"[{LATIN_TWINS}IilǀӀӏ|1]++\R?(?: |$)"
    return F.when(c.rlike(f"(?:^| )(?:{mixed}|{alike})"), F.array_join(F.transform(F.split(c, " "), fix), " ")).otherwise(c)


def token_filter(c: Column) -> Column:
    """Words without those that start with a slash, have an inner dot or hold Latin letters."""
    words = F.filter(F.split(c, r"\s+"), lambda t: (t != "") & ~t.startswith("/") & ~t.rlike(r"[^.]\.[^.]") & ~t.rlike("[A-Za-z]"))
    return F.array_join(words, " ")


def variants(c: Column) -> Column:
    """``а) X б) Y`` as the array of its variants; text without marks is one variant."""
    parts = F.split(F.regexp_replace(c, r"^\s*а\)\s*", ""), r"[\s;,]*\b[бвг]\)\s*")
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


LABELS = "частица|нареч|межд|союз|предлог|вводн"


def label(c: Column) -> Column:
    """Part-of-speech word at the start, or the empty string."""
    return F.regexp_extract(c, rf"^({LABELS})\.?\s+", 1)


def without_label(c: Column) -> Column:
    return F.regexp_replace(c, rf"^({LABELS})\.?\s+", "")


def with_label(labels: Column, text: Column) -> Column:
    """The sense's labels and the one its text begins with, once."""
    found = label(text)
    return F.array_union(F.coalesce(labels, F.array().cast("array<string>")), F.when(found == "", F.array().cast("array<string>")).otherwise(F.array(found)))


def precomment(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\p{L}+\.)\s+", 1)


def without_precomment(c: Column) -> Column:
    return F.regexp_replace(c, r"^(\p{L}+\.)\s+", "")


def homonym(c: Column) -> tuple[Column, Column]:
    """``word1.`` as (word, 1); other words as (word, null)."""
    found = F.regexp_extract(c, r"^(.*?)(\d+)\.$", 2)
    return F.when(found != "", F.regexp_extract(c, r"^(.*?)(\d+)\.$", 1)).otherwise(c), F.nullif(found, F.lit("")).cast("int")


def gloss(text: Column, comment: Column, new_text: Column, new_comment: Column) -> tuple[Column, Column]:
    """Text and comment after a re-parse: an existing comment comes first."""
    return new_text, F.concat_ws("; ", F.nullif(comment, F.lit("")), F.nullif(new_comment, F.lit("")))


def paired_examples(av: Column, ru: Column) -> Column:
    """Examples joined by // as an array of (av, ru)."""
    return F.arrays_zip(F.split(av, r"\s*//\s*").alias("av"), F.split(ru, r"\s*//\s*").alias("ru"))


def drop_redundant_forms(senses: Column, forms: Column) -> Column:
    """Senses without their own forms where these repeat the entry's."""
    return F.transform(senses, lambda s: F.when(F.size(F.array_except(F.coalesce(s["forms"], F.array().cast("array<string>")), forms)) == 0, s.withField("forms", F.lit(None).cast("array<string>"))).otherwise(s))


def edit_links(links: Column, add: Column, remove: Column) -> Column:
    """See-also links after an edit: removed targets go, added ones come once."""
    return F.array_union(F.array_except(links, remove), add)


def correct(df: DataFrame, column: str, corrections: DataFrame, max_broadcast: int = 1_000_000) -> DataFrame:
    """Replace whole values by a table (wrong, right): broadcast behind a count, else a shuffle join."""
    table = corrections.select("wrong", "right").dropDuplicates(["wrong"])
    side = F.broadcast(table) if table.count() <= max_broadcast else table
    return df.join(side, df[column] == side["wrong"], "left").withColumn(column, F.coalesce("right", column)).drop("wrong", "right")


def correct_tokens(df: DataFrame, column: str, key: str, corrections: DataFrame, max_broadcast: int = 1_000_000) -> DataFrame:
    """Replace words inside a text by a table (wrong, right); other signs and spaces stay as they are.

    key: a column that is unique per row.  Words are letters, digits, palochkas and backslashes in a
    row.  Only words are exploded and joined; rows without a wrong word are not touched."""
    word = r"[\p{L}\p{N}\\|]+"
    table = corrections.select("wrong", "right").dropDuplicates(["wrong"])
    side = F.broadcast(table) if table.count() <= max_broadcast else table
    found = df.select(F.col(key).alias("_key"), F.explode(F.array_distinct(F.regexp_extract_all(column, F.lit(f"({word})"), F.lit(1)))).alias("wrong")).join(side, "wrong")
    found = found.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("wrong", "right"))).alias("_right"))
    pieces = F.regexp_extract_all(column, F.lit(rf"(?s)({word}|[^\p{{L}}\p{{N}}\\|]+)"), F.lit(1))
    fixed = F.array_join(F.transform(pieces, lambda t: F.coalesce(F.try_element_at(F.col("_right"), t), t)), "")
    joined = df.join(found, df[key] == found["_key"], "left")
    return joined.withColumn(column, F.when(F.col("_right").isNull(), F.col(column)).otherwise(fixed)).drop("_key", "_right")


def correct_by_key(df: DataFrame, key: str, column: str, corrections: DataFrame) -> DataFrame:
    """Set a column by a table (key, value): for null headwords by their line, forms by their entry."""
    table = corrections.select(F.col(key), F.col("value").alias("_value"), F.lit(True).alias("_there")).dropDuplicates([key])
    joined = df.join(table, key, "left")
    return joined.withColumn(column, F.when(F.col("_there"), F.col("_value")).otherwise(F.col(column))).drop("_value", "_there").select(df.columns)


def blocklist(df: DataFrame, blocked: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in the list."""
    return df.join(blocked.select(on).distinct(), on, "left_anti")
