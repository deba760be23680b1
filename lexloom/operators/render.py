"""Rendering: rows to HTML strings, one row per output file; all but the JSON view are expressions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import escape_html, paragraphs, preview, report, roman, thousands, url_quote
from . import articles as art
from . import corpus, dictionary
from .order import tasks


@F.pandas_udf(T.StringType())
def pretty_json(raw: pd.Series) -> pd.Series:
    """Two-space indent, characters unescaped, keys in their own order."""
    return raw.map(lambda x: None if x is None else json.dumps(json.loads(x), indent=2, ensure_ascii=False))


def page(title: Column, body: Column, depth: int = 1) -> Column:
    up = "../" * depth
    return F.concat(F.lit("<!doctype html>\n<html><head><meta charset=\"utf-8\"><title>"), escape_html(title), F.lit(f"</title><link rel=\"stylesheet\" href=\"{up}assets/styles.css\"></head>\n<body><main>\n"), body, F.lit("\n</main></body></html>\n"))


def link(href: Column, text: Column) -> Column:
    return F.concat(F.lit('<a href="'), href, F.lit('">'), escape_html(text), F.lit("</a>"))


def neighbours(before: Column, after: Column) -> Column:
    def one(c: Column, name: str) -> Column:
        return F.when(c.isNotNull(), F.concat(F.lit(f'<a rel="{name}" href="'), url_quote(c), F.lit(f'">{name}</a>'))).otherwise("")

    return F.concat(F.lit("<nav>"), one(before, "prev"), one(after, "next"), F.lit("</nav>"))


def choices(items: Column, current: Column, href, text, empty=lambda x: F.lit(False)) -> Column:
    """A list of links; the current one is marked, and what is empty is shown without a link."""
    def one(x: Column) -> Column:
        mark = F.when(text(x) == current, ' aria-current="page"').otherwise("")
        return F.when(empty(x), F.concat(F.lit("<span>"), escape_html(text(x)), F.lit("</span>"))).otherwise(F.concat(F.lit('<a href="'), href(x), F.lit('"'), mark, F.lit(">"), escape_html(text(x)), F.lit("</a>")))

    return F.concat(F.lit("<nav>"), F.array_join(F.transform(items, one), " "), F.lit("</nav>"))


def _section(letter: Column) -> Column:
    return F.concat(F.lit("index.html#letter-"), url_quote(letter))


def letter_choices(letters: Column, current: Column) -> Column:
    """letters: array of (letter, entries), those without entries too."""
    return choices(letters, current, lambda x: _section(x["letter"]), lambda x: x["letter"], lambda x: x["entries"] == 0)


def reported(href: Column) -> Column:
    return F.concat(F.lit('<a rel="nofollow" href="'), href, F.lit('">report</a>'))


def entry(anchor: Column, word: Column, raw: Column, report_href: Column | None = None) -> Column:
    return F.concat(F.lit('<section id="word-'), escape_html(anchor), F.lit('"><h2>'), escape_html(word), F.lit("</h2><pre>"), escape_html(raw), F.lit("</pre>"), F.lit("") if report_href is None else reported(report_href), F.lit("</section>"))


def dictionary_pages(entries: DataFrame, language: str = "av", page_size: int = dictionary.PAGE_SIZE, site: str = "", dataset: str = "dictionary") -> DataFrame:
    """(path, html) of every page; an entry shows its record.  A page's entries are at most page_size.

    The letters' list is one row of the alphabet's size, each letter's prefixes one row per letter."""
    placed = dictionary.anchors(entries, language, page_size)
    href = report("entry", site, F.lit(dataset), F.col("file"), F.concat(F.lit("word-"), F.col("anchor")), F.col("word"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", entry(F.col("anchor"), F.col("word"), F.col("raw"), href).alias("html")))), lambda x: x["html"]), "\n")
    nav = dictionary.navigation(entries, language, page_size).join(dictionary.siblings(entries, language), "letter")
    made = placed.groupBy("prefix", "page").agg(body.alias("body")).join(nav, ["prefix", "page"]).crossJoin(F.broadcast(dictionary.alphabet(entries, language)))
    around = F.concat(letter_choices(F.col("letters"), F.col("letter")), choices(F.col("prefixes"), F.col("prefix"), lambda p: url_quote(dictionary.file_name(p, F.lit(0))), lambda p: p))
    pages = choices(F.sequence(F.lit(1), F.col("page_count")).cast("array<string>"), (F.col("page") + 1).cast("string"), lambda i: url_quote(dictionary.file_name(F.col("prefix"), i.cast("int") - 1)), lambda i: i)
    head = F.concat(F.lit("<h1>"), escape_html(F.col("prefix")), F.lit("</h1><p>"), (F.col("page") + 1).cast("string"), F.lit("/"), F.col("page_count").cast("string"), F.lit(", "), F.col("on_page").cast("string"), F.lit(" / "), thousands(F.col("in_bucket")), F.lit("</p>"))
    return made.select(F.col("file").alias("path"), page(F.col("prefix"), F.concat(around, head, pages, F.col("body"), neighbours(F.col("prev_file"), F.col("next_file")))).alias("html"))


def dictionary_index(entries: DataFrame, language: str = "av") -> DataFrame:
    """(path, html): the letters with their counts, and a section of prefixes for each that has entries."""
    b = dictionary.buckets(entries, language)
    item = F.concat(F.lit("<li>"), link(url_quote(dictionary.file_name(F.col("prefix"), F.lit(0))), F.col("prefix")), F.lit(" "), thousands(F.col("entries")), F.lit("</li>"))
    sections = b.groupBy("letter").agg(F.sum("entries").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("prefix_key", "prefix", item.alias("html")))), lambda x: x["html"]), "").alias("list"))
    one = F.concat(F.lit('<details id="letter-'), url_quote(F.col("letter")), F.lit('"><summary>'), escape_html(F.col("letter")), F.lit(" "), thousands(F.col("n")), F.lit("</summary><ul>"), F.col("list"), F.lit("</ul></details>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(dictionary.letter_rank(F.col("letter"), language).alias("rank"), "letter", one.alias("html")))), lambda x: x["html"]), "\n")
    whole = sections.agg(body.alias("body")).crossJoin(F.broadcast(dictionary.alphabet(entries, language)))
    return whole.select(F.lit("index.html").alias("path"), page(F.lit("Index"), F.concat(letter_choices(F.col("letters"), F.lit("")), F.col("body"))).alias("html"))


def with_chapter_list(rows: DataFrame, numbers: DataFrame, monolingual: bool = False) -> DataFrame:
    """Rows of (chapter, ...) with ``nav``, the list of all chapters with their own one marked: by number, or
    by Roman numeral beside a translation.  numbers: the table of chapters, one row each.

    Every list is the unmarked one with the mark put in at a place, so that one is made once and its bytes are
    copied.  Lists are as long as there are chapters: the rows are dealt out before they get theirs."""
    shown = F.col("chapter").cast("string") if monolingual else roman(F.col("chapter"))
    head, tail = F.concat(F.lit('<a href="'), F.col("chapter").cast("string"), F.lit('.html"')), F.concat(F.lit(">"), escape_html(shown), F.lit("</a>"))
    links = numbers.select("chapter", F.concat(head, tail).alias("link"), F.octet_length(head).alias("head"))
    before = F.sum(F.octet_length("link") + 1).over(Window.orderBy("chapter").rowsBetween(Window.unboundedPreceding, -1))
    places = links.select("chapter", (F.coalesce(before, F.lit(0)) + F.col("head") + len("<nav>")).cast("int").alias("_cut"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chapter", "link"))), lambda x: x["link"]), " ")
    whole = links.agg(F.concat(F.lit("<nav>"), joined, F.lit("</nav>")).cast("binary").alias("_list"))
    dealt = rows.join(places, "chapter").repartition(tasks(rows.sparkSession), "_cut").crossJoin(F.broadcast(whole))
    nav = F.concat(F.substring("_list", F.lit(1), F.col("_cut")).cast("string"), F.lit(' aria-current="page"'), F.substring("_list", F.col("_cut") + 1, F.octet_length("_list")).cast("string"))
    return dealt.select(*rows.columns, nav.alias("nav"))


def chapter_pages(sentences: DataFrame, monolingual: bool = False, site: str = "", dataset: str = "corpus") -> DataFrame:
    """(path, html) of every chapter, in parallel or single-language layout."""
    rows = corpus.numbered(sentences)
    place = F.concat(F.col("chapter").cast("string"), F.lit(", "), F.col("shown").cast("string"))
    href = report("material" if monolingual else "sentence", site, F.lit(dataset), F.concat(F.col("chapter").cast("string"), F.lit(".html")), F.concat(F.lit("s-"), F.col("shown").cast("string")), place)
    cells = F.concat(F.lit("<p>"), escape_html(F.col("av")), F.lit("</p>")) if monolingual else F.concat(F.lit("<p>"), escape_html(F.col("av")), F.lit("</p><p>"), escape_html(F.col("ru")), F.lit("</p>"))
    one = F.concat(F.lit('<div id="s-'), F.col("shown").cast("string"), F.lit('">'), cells, reported(href), F.lit("</div>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", one.alias("html")))), lambda x: x["html"]), "\n")
    made = with_chapter_list(rows.groupBy("chapter").agg(body.alias("body")).join(corpus.navigation(sentences), "chapter"), corpus.numbers(sentences), monolingual)

    def name(c: Column) -> Column:
        return F.concat(c.cast("string"), F.lit(".html"))

    head = F.concat(F.lit("<h1>"), escape_html(F.col("title")), F.lit("</h1><p>"), escape_html(F.col("author")), F.lit("</p>"))
    return made.select(name(F.col("chapter")).alias("path"), page(F.col("title"), F.concat(F.col("nav"), head, F.col("body"), neighbours(name(F.col("prev_chapter")), name(F.col("next_chapter"))))).alias("html"))


def corpus_index(sentences: DataFrame, monolingual: bool = False) -> DataFrame:
    """(path, html): all chapters with their counts; with titles and authors where there is no translation."""
    shown = F.concat(F.col("title"), F.when(F.col("author") != "", F.concat(F.lit(", "), F.col("author"))).otherwise("")) if monolingual else roman(F.col("chapter"))
    item = F.concat(F.lit("<li>"), link(F.concat(F.col("chapter").cast("string"), F.lit(".html")), shown), F.lit(" "), thousands(F.col("sentences")), F.lit("</li>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chapter", item.alias("html")))), lambda x: x["html"]), "")
    made = corpus.chapters(sentences).agg(body.alias("body"), F.count("*").alias("n"), F.coalesce(F.sum("sentences"), F.lit(0)).alias("all"))
    head = F.concat(F.lit("<p>"), thousands(F.col("n")), F.lit(" / "), thousands(F.col("all")), F.lit("</p><ul>"))
    return made.select(F.lit("index.html").alias("path"), page(F.lit("Index"), F.concat(head, F.col("body"), F.lit("</ul>"))).alias("html"))


def archive_index(articles: DataFrame) -> DataFrame:
    """(path, html): all years with their counts, newest first, and the span of dates."""
    item = F.concat(F.lit("<li>"), link(F.concat(F.lit("y/"), url_quote(F.col("year")), F.lit(".html")), F.col("year")), F.lit(" "), thousands(F.col("articles")), F.lit("</li>"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("year", item.alias("html"))), asc=False), lambda x: x["html"]), "")
    made = art.years(articles).agg(body.alias("body"), F.count("*").alias("years")).crossJoin(F.broadcast(art.span(articles)))
    dates = F.when(F.col("first_date").isNotNull(), F.concat(F.lit(", "), escape_html(F.col("first_date")), F.lit(" … "), escape_html(F.col("last_date")))).otherwise("")
    head = F.concat(F.lit("<p>"), thousands(F.col("articles")), F.lit(" / "), F.col("years").cast("string"), dates, F.lit("</p><ul>"))
    return made.select(F.lit("index.html").alias("path"), page(F.lit("Index"), F.concat(head, F.col("body"), F.lit("</ul>"))).alias("html"))


def article_pages(articles: DataFrame, site: str = "", dataset: str = "articles") -> DataFrame:
    """(path, html) of every article: origin (url, else book path, else none), tags, paragraphs, neighbours."""
    named = articles.join(art.file_names(articles), "ordinal")
    rows = art.neighbours(named, "file")
    origin = F.coalesce(link(F.nullif(F.col("url"), F.lit("")), F.lit("source")), link(F.nullif(F.col("book_path"), F.lit("")), F.lit("book")), F.lit(""))
    tags = F.array_join(F.transform(F.coalesce("categories", F.array().cast("array<string>")), lambda c: F.concat(F.lit("<li>"), escape_html(c), F.lit("</li>"))), "")
    text = F.array_join(F.transform(paragraphs(F.coalesce("text", F.lit(""))), lambda p: F.concat(F.lit("<p>"), escape_html(p), F.lit("</p>"))), "\n")

    def name(c: Column) -> Column:
        return F.concat(c, F.lit(".html"))

    body = F.concat(F.lit("<h1>"), escape_html(F.col("title")), F.lit("</h1><time>"), F.coalesce(F.substring("date", 1, 10), F.lit("")), F.lit("</time>"), origin, F.lit("<ul>"), tags, F.lit("</ul>"), text, reported(report("article", site, F.lit(dataset), F.concat(F.lit("a/"), F.col("file"), F.lit(".html")), F.lit(""), F.col("title"))), neighbours(name(F.col("prev_name")), name(F.col("next_name"))))
    return rows.select(F.concat(F.lit("a/"), F.col("file"), F.lit(".html")).alias("path"), page(F.col("title"), body, 2).alias("html"))


def article_index(articles: DataFrame) -> DataFrame:
    """(path, html) of one archive page per year with previews."""
    named = art.with_year(articles.join(art.file_names(articles), "ordinal"))
    item = F.concat(F.lit("<li>"), link(F.concat(F.lit("../a/"), F.col("file"), F.lit(".html")), F.col("title")), F.lit("<p>"), escape_html(preview(F.coalesce("text", F.lit("")))), F.lit("</p></li>"))
    order = F.struct(F.coalesce("date", F.lit("")), F.coalesce("slug", F.lit("")), -F.col("ordinal"), item.alias("html"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(order), asc=False), lambda x: x["html"]), "\n")
    years = art.years(articles)
    every = years.agg(F.sort_array(F.collect_list("year"), asc=False).alias("every"))
    made = named.groupBy("year").agg(body.alias("body")).join(years, "year").crossJoin(F.broadcast(every))
    nav = choices(F.col("every"), F.col("year"), lambda y: F.concat(url_quote(y), F.lit(".html")), lambda y: y)
    return made.select(F.concat(F.lit("y/"), F.col("year"), F.lit(".html")).alias("path"), page(F.col("year"), F.concat(nav, F.lit("<ul>"), F.col("body"), F.lit("</ul>"), neighbours(F.col("prev_year"), F.col("next_year"))), 2).alias("html"))


def catalog_page(registry: DataFrame) -> DataFrame:
    """(path, html): the index of all datasets; the registry is one small row per source."""
    card = F.concat(F.lit("<li>"), link(F.concat(F.col("id"), F.lit("/")), F.col("title")), F.lit(" <b>"), escape_html(F.col("status")), F.lit("</b> "), thousands(F.col("entries")), F.lit(" "), escape_html(F.col("unit")), F.lit("</li>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_order", card.alias("html")))), lambda x: x["html"]), "\n")
    return registry.agg(body.alias("body")).select(F.lit("index.html").alias("path"), page(F.lit("Catalog"), F.concat(F.lit("<ul>"), F.col("body"), F.lit("</ul>")), 0).alias("html"))
