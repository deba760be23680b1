"""All registered queries of the library's own operators, with their DuckDB SQL.

Tables stand in for lexicographic data: documents are entries (first word, digraphs by a fixed
translation) and books, conversations are a corpus, orders and pages are articles, nations are
registered datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, collate, text
from ..operators import articles, catalog, corpus, dictionary, diff, render
from . import sql as S

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}
C = F.col


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def avar(c):
    return F.translate(c, "tgkhcTGKHCwq", "тгкхцТГКХЦъь")


def entries(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(C("doc_id").alias("ordinal"), avar(F.split_part("text", F.lit(" "), F.lit(1))).alias("word"))


def docs(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", avar(C("text")).alias("av"), "text")


# --- letters and order ---------------------------------------------------------------------------


@query(f"SELECT doc_id, {S.palochka(S.avar('text'))} AS normal FROM documents")
def palochka_normalize(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.palochka(C("av")).alias("normal"))


@query(f"WITH t AS (SELECT doc_id, {S.tokens(S.avar('text'))} AS tk FROM documents) SELECT doc_id, len(tk)::BIGINT AS n_tokens, md5(array_to_string(tk, ' ')) AS tokens_md5 FROM t")
def digraph_tokens(spark, sf_dir):
    found, number = collate.spaced(C("av"))
    return docs(spark, sf_dir).select("doc_id", number.alias("n_tokens"), F.md5(found).alias("tokens_md5"))


@query(f"WITH t AS (SELECT p_partkey, {S.tokens('p_name', 'en')} AS en, {S.tokens('p_name', 'ru')} AS ru FROM part) SELECT p_partkey, array_to_string({S.sort_key('en', 'en')}, ',') AS en_key, array_to_string({S.sort_key('ru', 'ru')}, ',') AS ru_key FROM t")
def other_alphabets(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", collate.tokens(C("p_name"), "en").alias("en"), collate.tokens(C("p_name"), "ru").alias("ru"))
    return p.select("p_partkey", F.array_join(collate.sort_key(C("en"), "en").cast("array<string>"), ",").alias("en_key"), F.array_join(collate.sort_key(C("ru"), "ru").cast("array<string>"), ",").alias("ru_key"))


@query(f"WITH {S.ENTRIES} SELECT ordinal, word, prefix, array_to_string(key, ',') AS sort_key, (row_number() OVER (PARTITION BY prefix ORDER BY key, word, ordinal) - 1)::INT AS position FROM keyed")
def collation_order(spark, sf_dir):
    return dictionary.paged(entries(spark, sf_dir)).select("ordinal", "word", "prefix", F.array_join(C("key").cast("array<string>"), ",").alias("sort_key"), "position")


@query("SELECT p_partkey, coalesce(nullif(CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE p_name END, ''), nullif(CASE p_partkey % 5 WHEN 0 THEN '' ELSE p_brand END, ''), '') AS headword FROM part")
def headword_coalesce(spark, sf_dir):
    word = F.when(C("p_partkey") % 3 == 0, "").when(C("p_partkey") % 3 == 1, F.lit(None)).otherwise(C("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", text.headword(word, F.when(C("p_partkey") % 5 == 0, "").otherwise(C("p_brand"))).alias("headword"))


# --- dictionary pages ----------------------------------------------------------------------------


@query(f"WITH {S.ENTRIES} SELECT letter, prefix, entries FROM buckets")
def prefix_buckets(spark, sf_dir):
    return dictionary.buckets(entries(spark, sf_dir)).select("letter", "prefix", "entries")


@query(f"WITH {S.ENTRIES} SELECT letter, sum(entries)::BIGINT AS entries, count(*) AS buckets FROM buckets GROUP BY letter")
def letter_counts(spark, sf_dir):
    return dictionary.letters(entries(spark, sf_dir)).select("letter", "entries", "buckets")


@query(f"WITH {S.ENTRIES}, l AS (SELECT DISTINCT letter, coalesce({S.rank('letter')}, 10000)::INT AS letter_rank FROM buckets) SELECT letter, letter_rank, row_number() OVER (ORDER BY letter_rank, letter)::INT AS place FROM l")
def letter_order(spark, sf_dir):
    from pyspark.sql import Window

    return dictionary.letters(entries(spark, sf_dir)).select("letter", "letter_rank", F.row_number().over(Window.orderBy("letter_rank", "letter")).alias("place"))


_PAGED = f"WITH {S.ENTRIES}, placed AS (SELECT *, (row_number() OVER (PARTITION BY prefix ORDER BY key, word, ordinal) - 1)::INT AS position FROM keyed), paged AS (SELECT *, (position // 20)::INT AS page FROM placed)"


@query(f"{_PAGED} SELECT ordinal, word, prefix, position, page, {S.file_name('prefix', 'page')} AS file FROM paged")
def dictionary_pages(spark, sf_dir):
    return dictionary.paged(entries(spark, sf_dir), page_size=20).select("ordinal", "word", "prefix", "position", "page", "file")


@query(f"""WITH {S.ENTRIES}, p AS (SELECT letter, prefix, prefix_key, entries, ceil(entries / 20)::INT AS page_count, unnest(range(0, ceil(entries / 20)::BIGINT))::INT AS page FROM buckets),
f AS (SELECT *, {S.file_name('prefix', 'page')} AS file, coalesce({S.rank('letter')}, 10000) AS letter_rank FROM p)
SELECT letter, prefix, page, file, least(20, entries - page * 20)::BIGINT AS on_page, entries AS in_bucket, page_count, lag(file) OVER w AS prev_file, lead(file) OVER w AS next_file
FROM f WINDOW w AS (ORDER BY letter_rank, letter, prefix_key, prefix, page)""")
def page_navigation(spark, sf_dir):
    return dictionary.navigation(entries(spark, sf_dir), page_size=20)


@query(f"WITH {S.ENTRIES} SELECT letter, string_agg(prefix, ' ' ORDER BY prefix_key, prefix) AS prefixes FROM buckets GROUP BY letter")
def letter_siblings(spark, sf_dir):
    return dictionary.siblings(entries(spark, sf_dir)).select("letter", F.array_join("prefixes", " ").alias("prefixes"))


@query(f"""{_PAGED}, based AS (SELECT *, coalesce(nullif(translate(word, ' /', '__'), ''), '_') AS base FROM paged),
n AS (SELECT *, row_number() OVER (PARTITION BY prefix, page, base ORDER BY position) AS nth FROM based)
SELECT ordinal, prefix, page, CASE WHEN nth = 1 THEN base ELSE base || '-' || nth::VARCHAR END AS anchor FROM n""")
def entry_anchors(spark, sf_dir):
    return dictionary.anchors(entries(spark, sf_dir), page_size=20).select("ordinal", "prefix", "page", "anchor")


# --- corpus --------------------------------------------------------------------------------------


def sentences(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return c.select(
        (C("conv_id") * 1000 + C("turn")).alias("ordinal"), F.when(C("conv_id") % 7 != 3, C("conv_id")).cast("int").alias("chapter"),
        F.when(C("turn") % 4 != 0, C("turn")).cast("int").alias("SentenceNumber"), F.when(C("turn") % 3 != 0, C("turn") + 100).cast("int").alias("sentence"),
        F.when(C("conv_id") % 2 == 0, F.concat(F.lit("T"), C("conv_id").cast("string"))).otherwise("").alias("title"), C("role").alias("author"), avar(C("text")).alias("av"), C("text").alias("ru"),
    )


_SENTENCES = """sentences AS (SELECT conv_id * 1000 + turn AS ordinal, CASE WHEN conv_id % 7 <> 3 THEN conv_id END::INT AS chapter, CASE WHEN turn % 4 <> 0 THEN turn END::INT AS SentenceNumber,
CASE WHEN turn % 3 <> 0 THEN turn + 100 END::INT AS sentence, CASE WHEN conv_id % 2 = 0 THEN 'T' || conv_id::VARCHAR ELSE '' END AS title, role AS author FROM conversations)"""


def _roman_sql(n: str) -> str:
    def place(table: str, unit: int) -> str:
        return f"[{table}][1 + ({n} // {unit}) % 10]"

    return (
        f"CASE WHEN {n} > 0 THEN repeat('M', ({n} // 1000)::BIGINT) || {place(repr(',C,CC,CCC,CD,D,DC,DCC,DCCC,CM'.split(','))[1:-1], 100)} || "
        f"{place(repr(',X,XX,XXX,XL,L,LX,LXX,LXXX,XC'.split(','))[1:-1], 10)} || {place(repr(',I,II,III,IV,V,VI,VII,VIII,IX'.split(','))[1:-1], 1)} ELSE '' END"
    )


_CHAPTERS = f"""WITH {_SENTENCES}, chapters AS (SELECT chapter, count(*) AS sentences, arg_min({{'t': title, 'a': author}}, (coalesce(SentenceNumber, 0), ordinal)) AS f FROM sentences WHERE chapter IS NOT NULL GROUP BY chapter)"""


@query(f"{_CHAPTERS} SELECT chapter, sentences FROM chapters")
def chapter_index(spark, sf_dir):
    return corpus.chapters(sentences(spark, sf_dir)).select("chapter", "sentences")


@query(f"{_CHAPTERS} SELECT chapter, coalesce(nullif(f.t, ''), {_roman_sql('chapter')}) AS title, coalesce(f.a, '') AS author FROM chapters")
def chapter_first_meta(spark, sf_dir):
    return corpus.chapters(sentences(spark, sf_dir)).select("chapter", "title", "author")


@query(f"{_CHAPTERS} SELECT chapter, lag(chapter) OVER (ORDER BY chapter) AS prev_chapter, lead(chapter) OVER (ORDER BY chapter) AS next_chapter FROM chapters")
def chapter_nav(spark, sf_dir):
    return corpus.navigation(sentences(spark, sf_dir)).select("chapter", "prev_chapter", "next_chapter")


@query(f"WITH {_SENTENCES} SELECT ordinal, chapter, row_number() OVER (PARTITION BY chapter ORDER BY coalesce(SentenceNumber, 0), ordinal)::INT AS place, coalesce(nullif(SentenceNumber, 0), nullif(sentence, 0), 0)::INT AS shown FROM sentences WHERE chapter IS NOT NULL")
def sentence_list(spark, sf_dir):
    return corpus.numbered(sentences(spark, sf_dir)).select("ordinal", "chapter", "place", "shown")


@query(f"WITH {_SENTENCES} SELECT count(*) AS entries, count(DISTINCT chapter) AS chapters, count(DISTINCT chapter) + 1 AS pages FROM sentences")
def corpus_stats(spark, sf_dir):
    return corpus.stats(sentences(spark, sf_dir))


@query(f"SELECT o_orderkey, {_roman_sql('(o_orderkey % 5000)')} AS numeral FROM orders")
def roman_numerals(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", text.roman(C("o_orderkey") % 5000).alias("numeral"))


# --- registry ------------------------------------------------------------------------------------


def registry(spark, sf_dir):
    n = C("n_nationkey")

    def doc(k: int):
        return F.struct(F.concat(C("n_name"), F.lit(f" {k}")).alias("title"), F.when(n % 2 == 0, "pdf").otherwise(F.lit(None)).alias("kind"), F.concat(F.lit("docs/"), ((n * 3 + k) % 20).cast("string")).alias("path"))

    documents = F.when(n % 4 == 0, F.array().cast("array<struct<title:string,kind:string,path:string>>")).when(n % 4 == 1, F.array(doc(0))).otherwise(F.array(doc(0), doc(1)))
    kind = F.when(n % 4 == 0, "corpus").when(n % 4 == 1, "articles").when(n % 4 == 2, "lexicon").otherwise(F.lit(None))
    return read(spark, sf_dir, "nation").select(
        C("n_name").alias("id"), n.alias("source_order"), kind.alias("kind"), F.when(n % 5 == 0, n % 2 == 0).alias("monolingual"),
        F.when(n % 3 != 0, "av").alias("language_from"), F.when(n % 3 == 1, "av").when(n % 3 == 2, "ru").alias("language_to"),
        F.when(n % 2 == 0, "слов").alias("unit"), F.when(n % 6 == 0, "test").when(n % 6 == 1, "").alias("status"),
        F.when(n % 8 != 7, F.concat(F.lit("data/"), C("n_name"))).alias("data_path"), documents.alias("documents"),
    )


_SOURCES = """registry AS (SELECT n_name AS id, n_nationkey AS n, CASE n_nationkey % 4 WHEN 0 THEN 'corpus' WHEN 1 THEN 'articles' WHEN 2 THEN 'lexicon' END AS kind,
CASE WHEN n_nationkey % 5 = 0 THEN n_nationkey % 2 = 0 END AS monolingual, CASE WHEN n_nationkey % 3 <> 0 THEN 'av' END AS language_from,
CASE n_nationkey % 3 WHEN 1 THEN 'av' WHEN 2 THEN 'ru' END AS language_to, CASE WHEN n_nationkey % 2 = 0 THEN 'слов' END AS unit,
CASE n_nationkey % 6 WHEN 0 THEN 'test' WHEN 1 THEN '' END AS status, CASE WHEN n_nationkey % 8 <> 7 THEN 'data/' || n_name END AS data_path,
CASE WHEN n_nationkey % 4 = 0 THEN 0 WHEN n_nationkey % 4 = 1 THEN 1 ELSE 2 END AS docs FROM nation),
stats AS (SELECT n.n_name AS id, count(*) AS entries, (count(*) // 10 + 1)::BIGINT AS pages, CASE WHEN any_value(n_nationkey) % 4 = 0 THEN 'предложений' END AS stats_unit
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name),
links AS (SELECT id, n, k::INT AS k, id || ' ' || k::VARCHAR AS title, upper(coalesce(CASE WHEN n % 2 = 0 THEN 'pdf' END, 'файл')) AS kind, 'docs/' || ((n * 3 + k) % 20)::VARCHAR AS path
FROM (SELECT *, unnest(range(0, docs)) AS k FROM registry))"""


def stats(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    s = read(spark, sf_dir, "supplier").join(n, C("s_nationkey") == C("n_nationkey")).groupBy(C("n_name").alias("id"), "n_nationkey").agg(F.count("*").alias("entries"))
    return s.select("id", "entries", (F.floor(C("entries") / 10) + 1).alias("pages"), F.when(C("n_nationkey") % 4 == 0, "предложений").alias("stats_unit"))


@query(f"WITH {_SOURCES} SELECT id, coalesce(monolingual, false) OR language_from IS NOT DISTINCT FROM language_to AS mono FROM registry")
def monolingual_flag(spark, sf_dir):
    return registry(spark, sf_dir).select("id", catalog.is_monolingual(C("monolingual"), C("language_from"), C("language_to")).alias("mono"))


@query(f"WITH {_SOURCES} SELECT id, CASE WHEN kind IN ('corpus', 'articles') THEN kind ELSE 'dictionary' END AS pipeline FROM registry")
def kind_dispatch(spark, sf_dir):
    return registry(spark, sf_dir).select("id", catalog.pipeline_of(C("kind")).alias("pipeline"))


@query(f"WITH {_SOURCES} SELECT id, coalesce(entries, 0)::BIGINT AS entries, coalesce(pages, 0)::BIGINT AS pages, coalesce(stats_unit, unit, 'статей') AS unit, coalesce(nullif(status, ''), 'stable') AS status, coalesce(language_from, 'ru') AS language FROM registry LEFT JOIN stats USING (id)")
def catalog_stats(spark, sf_dir):
    return catalog.with_stats(registry(spark, sf_dir), stats(spark, sf_dir)).select("id", "entries", "pages", "unit", "status", F.coalesce("language_from", F.lit("ru")).alias("language"))


@query(f"WITH {_SOURCES} SELECT count(*) AS datasets, sum(entries)::BIGINT AS entries, sum(pages)::BIGINT AS pages FROM stats")
def build_totals(spark, sf_dir):
    return catalog.totals(stats(spark, sf_dir))


@query(f"WITH {_SOURCES} SELECT s.id, l.k AS n, l.title, l.kind, l.path FROM registry s LEFT JOIN links l USING (id)")
def document_links(spark, sf_dir):
    return catalog.document_links(registry(spark, sf_dir))


@query(f"WITH {_SOURCES} SELECT path, id, k AS n FROM links QUALIFY row_number() OVER (PARTITION BY path ORDER BY links.n, k) = 1")
def document_dedupe(spark, sf_dir):
    links = registry(spark, sf_dir).select("id", "source_order", F.posexplode("documents").alias("n", "d")).select("id", "source_order", "n", "d.path")
    return catalog.first_per_path(links).select("path", "id", "n")


@query(f"WITH {_SOURCES} SELECT 0 AS part, 0::BIGINT AS ordinal, 'catalog.json' AS path UNION ALL SELECT 1, n, data_path FROM registry WHERE data_path IS NOT NULL UNION ALL SELECT 2, n * 1000 + k, path FROM (SELECT * FROM links QUALIFY row_number() OVER (PARTITION BY path ORDER BY links.n, k) = 1)")
def download_list(spark, sf_dir):
    return catalog.downloads(registry(spark, sf_dir))


@query(f"WITH {_SOURCES} SELECT DISTINCT path FROM links WHERE path NOT IN (SELECT 'docs/' || r_regionkey::VARCHAR FROM region)")
def missing_files(spark, sf_dir):
    present = read(spark, sf_dir, "region").select(F.concat(F.lit("docs/"), C("r_regionkey").cast("string")).alias("path"))
    return catalog.missing_files(catalog.document_links(registry(spark, sf_dir)).where("path is not null").select("path").distinct(), present)


# --- articles ------------------------------------------------------------------------------------


def archive(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    date = F.when(C("o_orderkey") % 11 == 0, F.lit(None)).when(C("o_orderkey") % 13 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select(C("o_orderkey").alias("ordinal"), F.concat(C("o_orderpriority"), F.lit(" "), (C("o_custkey") % 50).cast("string")).alias("slug"), date.alias("date"), C("o_orderstatus").alias("title"))


_ARTICLES = "articles AS (SELECT o_orderkey AS ordinal, o_orderpriority || ' ' || (o_custkey % 50)::VARCHAR AS slug, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders)"
_ARTICLE_ORDER = "ORDER BY coalesce(date, '') DESC, slug DESC, ordinal"


@query(f"WITH {_ARTICLES} SELECT ordinal, row_number() OVER ({_ARTICLE_ORDER}) AS place FROM articles")
def article_order(spark, sf_dir):
    return articles.neighbours(archive(spark, sf_dir)).select("ordinal", "place")


@query(f"WITH {_ARTICLES} SELECT ordinal, lag(slug) OVER ({_ARTICLE_ORDER}) AS prev_name, lead(slug) OVER ({_ARTICLE_ORDER}) AS next_name FROM articles")
def article_nav(spark, sf_dir):
    return articles.neighbours(archive(spark, sf_dir)).select("ordinal", "prev_name", "next_name")


@query(f"WITH {_ARTICLES} SELECT substr(coalesce(nullif(date, ''), '—'), 1, 4) AS year, count(*) AS articles FROM articles GROUP BY 1")
def article_years(spark, sf_dir):
    return articles.years(archive(spark, sf_dir)).select("year", "articles")


@query(f"WITH {_ARTICLES}, y AS (SELECT DISTINCT substr(coalesce(nullif(date, ''), '—'), 1, 4) AS year FROM articles) SELECT year, lag(year) OVER (ORDER BY year DESC) AS prev_year, lead(year) OVER (ORDER BY year DESC) AS next_year FROM y")
def year_nav(spark, sf_dir):
    return articles.years(archive(spark, sf_dir)).select("year", "prev_year", "next_year")


@query(f"WITH {_ARTICLES} SELECT min(nullif(date, '')) AS first_date, max(nullif(date, '')) AS last_date, count(*) AS articles FROM articles")
def article_span(spark, sf_dir):
    return articles.span(archive(spark, sf_dir))


_SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'article')"


@query(f"SELECT page_id, {_SLUG.format('url')} AS slug FROM pages")
def slug_base(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.slug_base(C("url")).alias("slug"))


#: Here no name is another's with a number (``x`` and ``x-2``), as the last condition holds; those are tested by brute force.
_BASES = f"based AS (SELECT ordinal, {_SLUG.format('slug')} AS base, row_number() OVER (PARTITION BY {_SLUG.format('slug')} {_ARTICLE_ORDER}) AS nth FROM articles)"


@query(f"WITH {_ARTICLES}, {_BASES} SELECT ordinal::BIGINT AS ordinal, base || CASE nth WHEN 1 THEN '' ELSE '-' || nth::VARCHAR END AS file FROM based WHERE NOT EXISTS (SELECT 1 FROM based b JOIN based c ON c.base = regexp_replace(b.base, '-[0-9]+$', '') AND c.base <> b.base)")
def article_filenames(spark, sf_dir):
    return articles.file_names(archive(spark, sf_dir))


# --- text functions ------------------------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN length(text) > 160 THEN substr(text, 1, 160) || '…' ELSE text END AS preview FROM documents")
def preview_text(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.preview(C("text")).alias("preview"))


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda p: regexp_matches(p, '\\S')))::INT AS n, array_to_string(list_filter(string_split(text, chr(10)), lambda p: regexp_matches(p, '\\S')), '¶') AS joined FROM documents")
def paragraphs(spark, sf_dir):
    p = text.paragraphs(C("text"))
    return docs(spark, sf_dir).select("doc_id", F.size(p).alias("n"), F.array_join(p, "¶").alias("joined"))


@query("SELECT page_id, coalesce(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;'), '') AS escaped FROM pages")
def html_escape(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.escape_html(C("html")).alias("escaped"))


@query(f"SELECT ordinal, url_encode(word || ' *+~/') AS quoted FROM (SELECT doc_id AS ordinal, {S.avar('split_part(text, chr(32), 1)')} AS word FROM documents)")
def url_quote(spark, sf_dir):
    return entries(spark, sf_dir).select("ordinal", text.url_quote(F.concat("word", F.lit(" *+~/"))).alias("quoted"))


@query("SELECT doc_id, format('{:,}', n_chars * 1234) AS shown FROM documents")
def thousands(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.thousands(C("n_chars") * 1234).alias("shown"))


_REPORT = "url_encode('Нашёл неточность в источнике ' || 'av-ru' || ': ' || {0} || chr(10) || 'ссылка: https://example.org/' || 'av-ru' || '/' || {1} || '#' || {2} || chr(10) || 'Должно быть: ...')"


@query(f"{_PAGED} SELECT ordinal, {_REPORT.format('word', S.file_name('prefix', 'page'), 'word')} AS link FROM paged")
def report_link(spark, sf_dir):
    return dictionary.paged(entries(spark, sf_dir), page_size=20).select("ordinal", text.report("entry", "https://example.org", F.lit("av-ru"), C("file"), C("word"), C("word")).alias("link"))


_BLANK = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\\r\\n|\\r', chr(10), 'g'), '[ \\t]+(\\n|$)', '\\1', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') || chr(10)"


@query(f"SELECT doc_id, {_BLANK.format('''replace(text, '. ', '.' || chr(32) || chr(10) || chr(10) || chr(9) || chr(10) || chr(10))''')} AS collapsed FROM documents")
def collapse_blank_lines(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.collapse_blank_lines(F.replace(C("text"), F.lit(". "), F.lit(". \n\n\t\n\n"))).alias("collapsed"))


@query("SELECT source, sum(length(text))::BIGINT AS characters, sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS newlines FROM documents GROUP BY source")
def book_char_stats(spark, sf_dir):
    t = C("text")
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.length(t)).alias("characters"), F.sum(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))).alias("newlines"))


@query(f"SELECT doc_id, (length(p) - length(translate(p, 'Ӏӏ', '')))::INT AS palochkas FROM (SELECT doc_id, {S.palochka(S.avar('text'))} AS p FROM documents)")
def palochka_count(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.palochka_count(text.palochka(C("av"))).alias("palochkas"))


# --- cleaning rules ------------------------------------------------------------------------------

CY = "[а-яёА-ЯЁӀӏ]"
_DOCS = f"SELECT doc_id, {S.avar('text')} AS av, text FROM documents"


def cleaned(name: str, rule, sql: str | None, column="av"):
    def run(spark, sf_dir):
        return docs(spark, sf_dir).select("doc_id", rule(C(column)).alias("cleaned"))

    run.__name__ = name
    query(f"SELECT doc_id, {sql} AS cleaned FROM ({_DOCS})" if sql else None)(run)


cleaned("clean_footnote_digits", lambda c: clean.footnote_digits(F.replace(c, F.lit(" "), F.lit("7 "))), f"regexp_replace(replace(av, ' ', '7 '), '({CY})[0-9]+', '\\1', 'g')")
cleaned("clean_hyphen_suffix", clean.hyphen_suffix, "regexp_replace(av, '([A-Za-z]{2,})([а-яёӏ]{2,})', '\\1-\\2', 'g')")
cleaned("clean_control_chars", clean.control_chars, r"regexp_replace(av, '[\x00-\x1f\x7f-\x9f]', '', 'g')")
cleaned("clean_dot_split", lambda c: clean.dot_split(F.replace(F.translate(c, "aeiourns", "аеиоурнс"), F.lit(" "), F.lit("."))),
        f"regexp_replace(regexp_replace(replace(translate(av, 'aeiourns', 'аеиоурнс'), ' ', '.'), '({CY}{{4}})\\.({CY})', '\\1. \\2', 'g'), '({CY}{{4}})\\.({CY})', '\\1. \\2', 'g')")
cleaned("clean_initial_split", lambda c: clean.initial_split(F.replace(F.translate(c, "aeiourns", "аеиоурнс"), F.lit("Т"), F.lit("Т."))), f"regexp_replace(replace(translate(av, 'aeiourns', 'аеиоурнс'), 'Т', 'Т.'), '([А-ЯЁӀ]\\.)({CY}{{4,}})', '\\1 \\2', 'g')")
cleaned("clean_underscore", lambda c: clean.inner_underscore(F.replace(F.translate(c, "aeiou", "аеиоу"), F.lit("т"), F.lit("_т"))), f"regexp_replace(regexp_replace(replace(translate(av, 'aeiou', 'аеиоу'), 'т', '_т'), '({CY})_({CY})', '\\1\\2', 'g'), '({CY})_({CY})', '\\1\\2', 'g')")
cleaned("clean_slash_spaces", lambda c: clean.slash_spaces(F.replace(c, F.lit(","), F.lit("/"))), "regexp_replace(replace(av, ',', '/'), '\\s*/\\s*', ' / ', 'g')")
cleaned("clean_dzhe", lambda c: clean.dzhe(F.translate(c, "zj", "џ̆")), "replace(replace(translate(av, 'zj', 'џ' || chr(774)), 'џ', 'дж'), chr(774), '')")
cleaned("clean_sign_one", lambda c: clean.one_sign_palochka(F.replace(c, F.lit("i"), F.lit("Ⅰ"))), "replace(replace(av, 'i', 'Ⅰ'), 'Ⅰ', 'ӏ')")
cleaned("clean_ocr", lambda c: clean.apply_rules(F.translate(c, "()", "<>"), clean.OCR), "replace(replace(replace(replace(replace(translate(av, '()', '<>'), 'вьш', 'вып'), '<', '('), '>', ')'), '^', ''), '\\ ', '; ')")
cleaned("stem_cleanup", clean.stem, "regexp_replace(av, '[\\s̀́]+', '', 'g')")
cleaned("token_filter", clean.token_filter,
        "array_to_string(list_filter(regexp_split_to_array(av, '\\s+'), lambda t: t <> '' AND NOT starts_with(t, '/') AND NOT regexp_matches(t, '[^.]\\.[^.]') AND NOT regexp_matches(t, '[A-Za-z]')), ' ')")
_MIXED = "regexp_matches(t, '[A-Za-z]') AND regexp_matches(t, '[а-яёА-ЯЁӀӏ]')"
_ALIKE = f"regexp_full_match(t, '[{clean.LATIN_TWINS}IilǀӀӏ|1]+') AND regexp_matches(t, '[xXTKHktчц][Iil|]')"
cleaned("clean_homoglyphs", clean.homoglyphs, f"array_to_string(list_transform(string_split(av, ' '), lambda t: CASE WHEN ({_MIXED}) OR ({_ALIKE}) THEN {S.palochka(f'''translate(t, '{clean.LATIN_TWINS}', '{clean.CYRILLIC_TWINS}')''')} ELSE t END), ' ')")


def _numbers():
    """Phone-like numbers of the orders with ones written as palochkas."""
    return F.translate(F.concat(C("o_orderkey").cast("string"), F.lit(" "), C("o_custkey").cast("string")), "1", "ӏ")


_NUMBER = "CASE WHEN regexp_matches({0}::VARCHAR, '[02-9]') THEN {0}::VARCHAR ELSE translate({0}::VARCHAR, '1', 'ӏ') END"


@query(f"SELECT o_orderkey, {_NUMBER.format('o_orderkey')} || ' ' || {_NUMBER.format('o_custkey')} AS cleaned FROM orders")
def clean_numeric_palochka(spark, sf_dir):
    """Numbers of palochkas alone stay: nothing tells them from letters."""
    return read(spark, sf_dir, "orders").select("o_orderkey", clean.numeric_palochka(_numbers()).alias("cleaned"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ХIХ' WHEN 1 THEN 'В1' WHEN 2 THEN 'IХ' ELSE '1-себ' END || ' ' || p_name AS cleaned FROM part")
def clean_roman_repair(spark, sf_dir):
    bad = F.when(C("p_partkey") % 4 == 0, "ХӏХ").when(C("p_partkey") % 4 == 1, "Вӏ").when(C("p_partkey") % 4 == 2, "ӏХ").otherwise("Ӏ-себ")
    return read(spark, sf_dir, "part").select("p_partkey", clean.apply_rules(F.concat(bad, F.lit(" "), C("p_name")), clean.ROMAN_REPAIR).alias("cleaned"))


@query("SELECT p_partkey, k::INT AS k, CASE k WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE p_type END AS variant FROM (SELECT *, unnest(range(0, 2 + p_partkey % 2)) AS k FROM part)")
def variant_split(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    raw = F.concat(F.lit("а) "), C("p_name"), F.lit("; б) "), C("p_brand"), F.when(C("p_partkey") % 2 == 1, F.concat(F.lit(" в) "), C("p_type"))).otherwise(""))
    return p.select("p_partkey", F.posexplode(clean.variants(raw)).alias("k", "variant"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'частица' WHEN 1 THEN 'нареч' ELSE '' END AS label, p_name AS rest FROM part")
def label_extract(spark, sf_dir):
    raw = F.concat(F.when(C("p_partkey") % 3 == 0, "частица ").when(C("p_partkey") % 3 == 1, "нареч. ").otherwise(""), C("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", clean.label(raw).alias("label"), clean.without_label(raw).alias("rest"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'мор.' ELSE '' END AS precomment, p_name AS rest FROM part")
def precomment_extract(spark, sf_dir):
    raw = F.concat(F.when(C("p_partkey") % 3 == 0, "мор. ").otherwise(""), C("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", clean.precomment(raw).alias("precomment"), clean.without_precomment(raw).alias("rest"))


@query("SELECT p_partkey, p_name AS text, concat_ws('; ', CASE WHEN p_partkey % 2 = 0 THEN p_brand END, p_type) AS comment FROM part")
def gloss_split(spark, sf_dir):
    t, c = clean.gloss(C("p_type"), F.when(C("p_partkey") % 2 == 0, C("p_brand")).otherwise(""), C("p_name"), C("p_type"))
    return read(spark, sf_dir, "part").select("p_partkey", t.alias("text"), c.alias("comment"))


@query("SELECT p_partkey, p_name AS word, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS homonym FROM part")
def homonym_suffix(spark, sf_dir):
    word, n = clean.homonym(F.when(C("p_partkey") % 2 == 0, F.concat(C("p_name"), C("p_size").cast("string"), F.lit("."))).otherwise(C("p_name")))
    return read(spark, sf_dir, "part").select("p_partkey", word.alias("word"), n.alias("homonym"))


@query("SELECT p_partkey, '(по)' || p_name AS kept FROM part")
def optional_prefix(spark, sf_dir):
    raw = F.concat(F.lit("(по)"), C("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(clean.variants(clean.without_label(clean.without_precomment(raw))), "|").alias("kept"))


@query("SELECT p_partkey, k::INT AS k, [p_name, p_brand][k + 1] AS av, [p_brand, p_type][k + 1] AS ru FROM (SELECT *, unnest([0, 1]) AS k FROM part)")
def example_pairs(spark, sf_dir):
    av, ru = F.concat(C("p_name"), F.lit(" // "), C("p_brand")), F.concat(C("p_brand"), F.lit("//"), C("p_type"))
    return read(spark, sf_dir, "part").select("p_partkey", F.posexplode(clean.paired_examples(av, ru)).alias("k", "e")).select("p_partkey", "k", "e.av", "e.ru")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_type END AS sense_forms FROM part")
def redundant_forms(spark, sf_dir):
    senses = F.array(F.struct(C("p_name").alias("text"), F.array(F.when(C("p_partkey") % 2 == 0, C("p_brand")).otherwise(C("p_type"))).alias("forms")))
    out = clean.drop_redundant_forms(senses, F.array("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(F.get(out, F.lit(0))["forms"], ",").alias("sense_forms"))


@query("SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 2 = 0 THEN p_name END, p_brand, CASE WHEN p_partkey % 3 = 0 THEN p_type END) AS links FROM part")
def link_edits(spark, sf_dir):
    gone = F.when(C("p_partkey") % 2 == 1, F.array("p_name")).otherwise(F.array().cast("array<string>"))
    added = F.when(C("p_partkey") % 3 == 0, F.array("p_type", "p_brand")).otherwise(F.array("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(clean.edit_links(F.array("p_name", "p_brand"), added, gone), ",").alias("links"))


@query("SELECT source, count(*) FILTER (n = 0) AS no_senses, coalesce(sum(empty), 0)::BIGINT AS empty_texts FROM (SELECT source, len(list_filter(string_split(text, chr(10)), lambda x: x <> '')) AS n, len(list_filter(string_split(text, chr(10)), lambda x: x = '')) AS empty FROM documents) GROUP BY source")
def quality_counters(spark, sf_dir):
    parts = F.split("text", "\n")
    d = read(spark, sf_dir, "documents").select("source", F.size(F.filter(parts, lambda x: x != "")).alias("n"), F.size(F.filter(parts, lambda x: x == "")).alias("empty"))
    return d.groupBy("source").agg(F.count_if(C("n") == 0).alias("no_senses"), F.sum("empty").alias("empty_texts"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def blocklist_anti(spark, sf_dir):
    return clean.blocklist(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")


@query("SELECT n_nationkey, coalesce(r_name, n_name) AS word FROM nation LEFT JOIN region ON n_nationkey = r_regionkey * 5")
def correction_join(spark, sf_dir):
    n = read(spark, sf_dir, "nation").withColumnRenamed("n_name", "word")
    table = n.join(read(spark, sf_dir, "region"), C("n_nationkey") == C("r_regionkey") * 5).select(C("word").alias("wrong"), C("r_name").alias("right"))
    return clean.correct(n, "word", table).select("n_nationkey", "word")


_DIFF = """old AS (SELECT p_partkey AS k, p_name AS text, [p_brand, p_type] AS examples FROM part WHERE p_partkey % 5 <> 0),
new AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN p_name || '!' ELSE p_name END AS text, CASE WHEN p_partkey % 4 = 0 THEN [p_brand] ELSE [p_brand, p_type] END AS examples FROM part WHERE p_partkey % 7 <> 0)"""


@query(f"""WITH {_DIFF} SELECT k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change, o.text AS old_text, n.text AS new_text,
coalesce(len(o.examples), 0)::INT AS old_examples, coalesce(len(n.examples), 0)::INT AS new_examples,
array_to_string(list_sort(list_distinct(list_filter(coalesce(n.examples, []), lambda x: NOT list_contains(coalesce(o.examples, []), x)))), chr(10)) AS gained,
array_to_string(list_sort(list_distinct(list_filter(coalesce(o.examples, []), lambda x: NOT list_contains(coalesce(n.examples, []), x)))), chr(10)) AS lost
FROM old o FULL JOIN new n USING (k) WHERE o.k IS NULL OR n.k IS NULL OR o.text <> n.text OR o.examples <> n.examples""")
def entry_diff(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    old = p.where("p_partkey % 5 <> 0").select(C("p_partkey").alias("k"), C("p_name").alias("text"), F.array("p_brand", "p_type").alias("examples"))
    new = p.where("p_partkey % 7 <> 0").select(C("p_partkey").alias("k"), F.when(C("p_partkey") % 3 == 0, F.concat("p_name", F.lit("!"))).otherwise(C("p_name")).alias("text"), F.when(C("p_partkey") % 4 == 0, F.array("p_brand")).otherwise(F.array("p_brand", "p_type")).alias("examples"))
    return diff.entry_diff(old, new, ["k"])


# --- lists on pages --------------------------------------------------------------------------------

_LETTERS = ", ".join(f"('{x}', {k})" for k, x in enumerate(collate.AVAR))


@query(f"""WITH {S.ENTRIES}, c AS (SELECT letter, sum(entries)::BIGINT AS entries FROM buckets GROUP BY letter), a(letter, k) AS (VALUES {_LETTERS})
SELECT letter, coalesce(entries, 0)::BIGINT AS entries, row_number() OVER (ORDER BY coalesce(k, 10000), letter)::INT AS place FROM a FULL JOIN c USING (letter)""")
def alphabet_counts(spark, sf_dir):
    row = dictionary.alphabet(entries(spark, sf_dir)).select(F.posexplode("letters").alias("p", "l"))
    return row.select("l.letter", "l.entries", (C("p") + 1).alias("place"))


_ESC = "replace(replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(f"""WITH {S.ENTRIES}, p AS (SELECT letter, list(prefix ORDER BY prefix_key, prefix) AS every FROM buckets GROUP BY letter)
SELECT prefix, '<nav>' || array_to_string(list_transform(every, lambda x: '<a href="' || url_encode(x || '.html') || '"' || CASE WHEN x = prefix THEN ' aria-current="page"' ELSE '' END || '>' || {_ESC} || '</a>'), ' ') || '</nav>' AS nav FROM buckets JOIN p USING (letter)""")
def sibling_lists(spark, sf_dir):
    b = dictionary.buckets(entries(spark, sf_dir)).join(dictionary.siblings(entries(spark, sf_dir)), "letter")
    return b.select("prefix", render.choices(C("prefixes"), C("prefix"), lambda p: text.url_quote(dictionary.file_name(p, F.lit(0))), lambda p: p).alias("nav"))


@query(f"""{_CHAPTERS}, l AS (SELECT list(chapter ORDER BY chapter) AS every FROM chapters)
SELECT chapter, '<nav>' || array_to_string(list_transform(every, lambda x: '<a href="' || x::VARCHAR || '.html"' || CASE WHEN x = chapter THEN ' aria-current="page"' ELSE '' END || '>' || x::VARCHAR || '</a>'), ' ') || '</nav>' AS nav FROM chapters, l""")
def chapter_lists(spark, sf_dir):
    n = corpus.numbers(sentences(spark, sf_dir))
    return render.with_chapter_list(n, n, True)


# --- books, keyed corrections, change logs -----------------------------------------------------------


@query("SELECT (row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m') DESC, o_orderkey) - 1)::INT AS ordinal, o_orderkey::VARCHAR AS slug, 'books/' || o_orderkey::VARCHAR || '.docx' AS book_path, nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END, '') AS editor FROM orders WHERE o_orderstatus = 'F'")
def books_by_date(spark, sf_dir):
    from ..io import readers

    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").withColumn("file", F.concat(C("o_orderkey").cast("string"), F.lit(".docx")))
    files = o.select(F.concat(F.lit("x/y/"), "file").alias("path"), C("o_orderpriority").alias("text"))
    about = o.select("file", C("o_orderkey").cast("string").alias("slug"), C("o_orderstatus").alias("title"), F.lit("a").alias("author"), F.when(C("o_orderkey") % 2 == 0, "").otherwise(C("o_orderpriority")).alias("editor"), F.date_format("o_orderdate", "yyyy-MM").alias("date"), F.array(F.lit("c")).alias("categories"), C("o_orderkey").alias("ordinal"))
    return readers.book_records(files, about).select("ordinal", "slug", "book_path", "editor")


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda t: CASE t WHEN 'red' THEN 'крас1ный' WHEN 'blue' THEN 'синий' WHEN 'small' THEN 'малый' ELSE t END), ' ') || ', крас1ный' AS name FROM part")
def token_corrections(spark, sf_dir):
    table = spark.createDataFrame([("red", "крас1ный"), ("blue", "синий"), ("small", "малый"), ("re", "no")], "wrong string, right string")
    p = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(", red")).alias("name"))
    return clean.correct_tokens(p, "name", "p_partkey", table)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN o_orderstatus || '!' WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS word FROM orders")
def headword_by_line(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    words = o.select("o_orderkey", F.when(C("o_orderkey") % 3 != 0, C("o_orderpriority")).alias("word"))
    return clean.correct_by_key(words, "o_orderkey", "word", o.where("o_orderkey % 6 = 0").select("o_orderkey", F.concat("o_orderstatus", F.lit("!")).alias("value")))


@query("SELECT p_partkey, array_to_string(CASE WHEN p_partkey % 4 = 0 THEN [p_type, p_brand] ELSE [p_name, p_name] END, ',') AS forms FROM part")
def form_corrections(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    entries_ = p.select("p_partkey", F.array("p_name", "p_name").alias("forms"))
    fixed = clean.correct_by_key(entries_, "p_partkey", "forms", p.where("p_partkey % 4 = 0").select("p_partkey", F.array("p_type", "p_brand").alias("value")))
    return fixed.select("p_partkey", F.array_join("forms", ",").alias("forms"))


@query("SELECT p_partkey, array_to_string(CASE p_partkey % 3 WHEN 0 THEN ['x', 'нареч'] WHEN 1 THEN ['нареч'] ELSE ['y'] END, ',') AS labels FROM part")
def label_union(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    k = C("p_partkey") % 3
    said = F.when(k == 2, C("p_name")).otherwise(F.concat(F.lit("нареч. "), "p_name"))
    labels = F.when(k == 0, F.array(F.lit("x"))).when(k == 1, F.array(F.lit("нареч"))).otherwise(F.array(F.lit("y")))
    return p.select("p_partkey", F.array_join(clean.with_label(labels, said), ",").alias("labels"))


@query("""WITH o AS (SELECT l_orderkey AS k, list(flag ORDER BY l_linenumber, flag) AS a FROM (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS flag FROM lineitem) GROUP BY 1),
n AS (SELECT l_orderkey AS k, list(flag ORDER BY l_linenumber, flag) AS b FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'NEW' ELSE l_returnflag || l_linestatus END AS flag FROM lineitem WHERE l_linenumber < 6) GROUP BY 1),
s AS (SELECT k, a, b, unnest(range(greatest(len(a), len(b)))) AS i FROM o JOIN n USING (k)),
t AS (SELECT k, i, 'text[' || i::VARCHAR || ']: ' || coalesce(a[i + 1], '') || ' -> ' || coalesce(b[i + 1], '') AS line FROM s WHERE a[i + 1] IS DISTINCT FROM b[i + 1]
UNION ALL SELECT k, -1, 'senses: ' || len(a)::VARCHAR || ' -> ' || len(b)::VARCHAR FROM o JOIN n USING (k) WHERE len(a) <> len(b))
SELECT k, string_agg(line, chr(10) ORDER BY i) AS lines FROM t GROUP BY k""")
def sense_changes(spark, sf_dir):
    flag = F.concat("l_returnflag", "l_linestatus")
    li = read(spark, sf_dir, "lineitem").select(C("l_orderkey").alias("k"), "l_linenumber", flag.alias("old"), F.when(C("l_linenumber") % 2 == 0, "NEW").otherwise(flag).alias("new"))

    def senses(df, c):
        return df.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", c))), lambda x: x[c]).alias("senses"))

    return diff.sense_lines(senses(li, "old"), senses(li.where("l_linenumber < 6"), "new"), ["k"]).select("k", F.array_join("lines", "\n").alias("lines"))


# --- rendering (no SQL: Python's JSON layout, HTML of whole pages) --------------------------------


@query()
def json_pretty(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", render.pretty_json("props").alias("pretty"))


@query()
def rendered_pages(spark, sf_dir):
    e = entries(spark, sf_dir).withColumn("raw", F.to_json(F.struct("word")))
    return render.dictionary_pages(e, page_size=20).unionByName(render.dictionary_index(e))


@query()
def rendered_chapters(spark, sf_dir):
    return render.chapter_pages(sentences(spark, sf_dir)).unionByName(render.corpus_index(sentences(spark, sf_dir)))


@query()
def rendered_articles(spark, sf_dir):
    k = C("ordinal") % 4
    url, book = F.when(k < 2, F.concat(F.lit("https://example.org/?n="), k.cast("string"))).otherwise(""), F.when(k > 0, "books/<b>.docx")
    full = archive(spark, sf_dir).select("*", url.alias("url"), book.alias("book_path"), F.when(k != 2, F.array("title", F.lit("a & b"))).alias("categories"), C("slug").alias("text"))
    return render.article_pages(full).unionByName(render.article_index(full)).unionByName(render.archive_index(full))


@query()
def rendered_catalog(spark, sf_dir):
    return render.catalog_page(catalog.with_stats(registry(spark, sf_dir), stats(spark, sf_dir)).withColumn("title", C("id")))
