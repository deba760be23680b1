"""DuckDB expressions that say independently what the column functions compute."""

from __future__ import annotations

from ..functions import collate

PUA_UP, PUA_LOW = "\ue000", "\ue001"


def avar(x: str) -> str:
    return f"translate({x}, 'tgkhcTGKHCwq', 'тгкхцТГКХЦъь')"


def palochka(x: str) -> str:
    a = f"regexp_replace({x}, '([ТГКХЦЧ])[Ӏӏ|ǀIil1]+', '\\1{PUA_UP}', 'g')"
    b = f"regexp_replace({a}, '([тгкхцч])[Ӏӏ|ǀIil1]+', '\\1{PUA_LOW}', 'g')"
    c = f"translate({b}, 'Ӏӏ|ǀ', '1111')"
    runs = f"list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), lambda r: CASE WHEN regexp_full_match(r, '[Iil]+') THEN repeat('1', length(r)) ELSE r END)"
    return f"translate(array_to_string({runs}, ''), '{PUA_UP}{PUA_LOW}', 'Ӏӏ')"


def tokens(x: str, language: str = "av") -> str:
    low = f"lower(coalesce({x}, ''))"
    if language == "av":
        return f"regexp_extract_all({palochka(low)}, '(?s)(?:{'|'.join(collate.DIGRAPHS)})|.')"
    return f"regexp_extract_all({low}, '(?s).')"


def rank(t: str, language: str = "av") -> str:
    letters = ", ".join(f"'{x}'" for x in collate.alphabet(language))
    return f"(nullif(list_position([{letters}], {t}), 0) - 1)"


def sort_key(found: str, language: str = "av") -> str:
    return f"list_transform({found}, lambda t: coalesce({rank('t', language)}, 10000 + unicode(t))::INT)"


def prefix(found: str) -> str:
    return f"CASE WHEN len({found}) > 0 THEN array_to_string({found}[1:3], '') ELSE '?' END"


def letter(of_prefix: str, language: str = "av") -> str:
    return f"coalesce({tokens(of_prefix, language)}[1], '?')"


def file_name(prefix: str, page: str) -> str:
    return f"{prefix} || CASE WHEN {page} = 0 THEN '' ELSE '-' || ({page} + 1)::VARCHAR END || '.html'"


#: entries -> keyed, counted, paged: what the dictionary queries share
ENTRIES = f"""entries AS (SELECT doc_id AS ordinal, {avar("split_part(text, ' ', 1)")} AS word FROM documents),
keyed AS (SELECT ordinal, word, tk, {prefix('tk')} AS prefix, {sort_key('tk')} AS key FROM (SELECT *, {tokens('word')} AS tk FROM entries)),
lettered AS (SELECT *, {letter('prefix')} AS letter FROM keyed),
buckets AS (SELECT letter, prefix, count(*) AS entries, {sort_key(tokens('prefix'))} AS prefix_key FROM lettered GROUP BY letter, prefix)"""
