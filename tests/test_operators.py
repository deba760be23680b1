import json
import os
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexloom.functions import collate, text
from lexloom.io import readers, schemas, writers
from lexloom.operators import articles, corpus, dictionary, diff, order, render
from lexloom.plans import build
from lexloom.streaming import ingest


def words(spark, n=300):
    rng = random.Random(3)
    return spark.createDataFrame([(i, "".join(rng.choice("гътӏкьаб1I") for _ in range(rng.randint(0, 6)))) for i in range(n)], "ordinal long, word string")


def test_pages_hold_every_entry_once(spark):
    df = words(spark).cache()
    paged = dictionary.paged(df, page_size=7).collect()
    assert sorted(r["ordinal"] for r in paged) == list(range(300))
    pages = {(r["prefix"], r["page"]): r["on_page"] for r in dictionary.pages(df, page_size=7).collect()}
    seen = {}
    for r in paged:
        seen[r["prefix"], r["page"]] = seen.get((r["prefix"], r["page"]), 0) + 1
    assert seen == pages
    assert sum(r["entries"] for r in dictionary.letters(df).collect()) == 300
    nav = {r["file"]: r for r in dictionary.navigation(df, page_size=7).collect()}
    first = [f for f, r in nav.items() if r["prev_file"] is None]
    assert len(first) == 1
    order, at = [], first[0]
    while at:
        assert not order or nav[at]["prev_file"] == order[-1]
        order.append(at)
        at = nav[at]["next_file"]
    assert len(order) == len(nav)
    anchors = [(r["prefix"], r["page"], r["anchor"]) for r in dictionary.anchors(df, page_size=7).collect()]
    assert len(set(anchors)) == len(anchors)


def archive(spark, n=200, seed=5):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a-2", "a-2-2", "A!", "b", "b-3", "ж", ""]), rng.choice(["2020-01-01", "2021-05-06", "", None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "ordinal long, slug string, date string")


def order_of(rows):
    return sorted(sorted(rows, key=lambda r: r[0]), key=lambda r: (r[2] or "", r[1] or ""), reverse=True)


def test_article_order_and_names(spark):
    rows, df = archive(spark)
    expect = order_of(rows)
    got = {r["ordinal"]: r for r in articles.neighbours(df).collect()}
    for i, r in enumerate(expect):
        g = got[r[0]]
        assert g["place"] == i + 1
        assert g["prev_name"] == (expect[i - 1][1] if i else None)
        assert g["next_name"] == (expect[i + 1][1] if i + 1 < len(expect) else None)
    used, names = set(), {}
    for ordinal, slug, _ in expect:
        base = re.sub("[^a-z0-9]+", "-", (slug or "").lower()).strip("-") or "article"
        name, n = base, 2
        while name in used:
            name, n = f"{base}-{n}", n + 1
        used.add(name)
        names[ordinal] = name
    assert {r["ordinal"]: r["file"] for r in articles.file_names(df).collect()} == names


def test_chapters(spark):
    rows = [(0, 1, 2, None, "B", "x"), (1, 1, None, 7, "", "y"), (2, None, 1, 1, "N", "z"), (3, 3, 0, None, "C", None)]
    df = spark.createDataFrame(rows, "ordinal long, chapter int, SentenceNumber int, sentence int, title string, author string")
    got = {r["chapter"]: (r["sentences"], r["title"], r["author"]) for r in corpus.chapters(df).collect()}
    assert got == {1: (2, "I", "y"), 3: (1, "C", "")}
    assert [(r["ordinal"], r["shown"]) for r in corpus.numbered(df).orderBy("chapter", "place").collect()] == [(1, 7), (0, 2), (3, 0)]
    assert corpus.stats(df).first()["entries"] == 4


def test_chapter_lists_are_dealt_out(spark):
    """The list of every chapter is the plain one with its own marked, and no single task makes them all."""
    numbers = [-1, 0, 7, *range(995, 1100)]
    df = spark.createDataFrame([(n,) for n in numbers], "chapter int").repartition(3)
    for monolingual in (True, False):
        lists = render.with_chapter_list(df, df, monolingual)
        shown = {r["chapter"]: r["t"] for r in df.select("chapter", (F.col("chapter").cast("string") if monolingual else text.roman(F.col("chapter"))).alias("t")).collect()}
        want = {c: "<nav>" + " ".join(f'<a href="{n}.html"{" aria-current=" + chr(34) + "page" + chr(34) if n == c else ""}>{shown[n]}</a>' for n in numbers) + "</nav>" for c in numbers}
        assert sorted((r["chapter"], r["nav"]) for r in lists.collect()) == sorted(want.items())
        assert lists.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert render.with_chapter_list(df.limit(0), df.limit(0)).count() == 0


def test_chapter_pages_mark_one_chapter_each(spark):
    """Chapters without a Roman numeral too; pages are dealt out over tasks."""
    rows = [(i, c, 1, None, "", "x", "a", "b") for i, c in enumerate([-2, 0, *range(1, 30)])]
    df = spark.createDataFrame(rows, "ordinal long, chapter int, SentenceNumber int, sentence int, title string, author string, av string, ru string")
    pages = render.chapter_pages(df)
    got = {r["path"]: r["html"] for r in pages.collect()}
    assert sorted(got) == sorted(f"{r[1]}.html" for r in rows)
    for path, html in got.items():
        assert html.count("aria-current") == 1 and f'<a href="{path}" aria-current="page">' in html and html.count("<a href=") == len(rows)
    assert pages.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_diff_is_empty_for_equal_sets(spark):
    df = spark.createDataFrame([("a", "x", ["1"]), ("b", None, None)], "k string, text string, examples array<string>")
    assert diff.entry_diff(df, df, ["k"]).count() == 0
    assert [r["change"] for r in diff.entry_diff(df, df.limit(0), ["k"]).collect()] == ["removed", "removed"]


def test_readers(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"word": "b", "stress": 1}\n\n{"phrase": "a c", "zeta": 1}\n')
    got = readers.jsonl(spark, str(tmp_path / "d.jsonl"), schemas.ENTRY).orderBy("ordinal").collect()
    assert [(r["word"], r["phrase"]) for r in got] == [("b", None), (None, "a c")] and got[1]["raw"].endswith('"zeta": 1}')
    (tmp_path / "bad.jsonl").write_text('{"word": "b"}\n{"word": \n')
    with pytest.raises(Exception):
        readers.jsonl(spark, str(tmp_path / "bad.jsonl"), schemas.ENTRY).collect()
    (tmp_path / "c.json").write_text('[{"chapter": 1, "av": "x"}, {"av": "y"}]')
    assert [r["av"] for r in readers.json_array(spark, str(tmp_path / "c.json"), schemas.SENTENCE).orderBy("ordinal").collect()] == ["x", "y"]
    (tmp_path / "o.json").write_text('{"chapter": 1}')
    with pytest.raises(Exception, match="not a list"):
        readers.json_array(spark, str(tmp_path / "o.json"), schemas.SENTENCE).collect()
    with pytest.raises(FileNotFoundError):
        readers.require_all(spark.createDataFrame([("x",)], "path string"), spark.createDataFrame([("y",)], "path string"))
    (tmp_path / "s.json").write_text(json.dumps({"sources": [{"id": "a", "kind": "corpus"}, {"id": "b"}]}))
    assert [r["id"] for r in readers.catalog(spark, str(tmp_path / "s.json")).orderBy("source_order").collect()] == ["a", "b"]


def test_ordinals_follow_paths_and_places(spark, tmp_path):
    for name, n in (("a", 1), ("b", 3000), ("c", 2), ("d", 400)):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"word": f"{name}{i}"}) + "\n" for i in range(n)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        got = readers.jsonl(spark, str(tmp_path / "*.jsonl"), schemas.ENTRY).select("ordinal", "word").orderBy("ordinal").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r["word"] for r in got] == [f"{name}{i}" for name, n in (("a", 1), ("b", 3000), ("c", 2), ("d", 400)) for i in range(n)]
    assert [r["ordinal"] for r in got] == list(range(3403))
    for name in "xy":
        (tmp_path / f"{name}.json").write_text(json.dumps([{"av": f"{name}{i}"} for i in range(3)]))
    got = readers.json_array(spark, str(tmp_path / "*.json"), schemas.SENTENCE).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["av"]) for r in got] == [(i, x) for i, x in enumerate(["x0", "x1", "x2", "y0", "y1", "y2"])]


def test_books(spark):
    files = spark.createDataFrame([("/b/a.docx", "ta"), ("/b/c.txt", "tc"), ("/b/z.txt", "tz"), ("/b/d.txt", "td")], "path string, text string")
    about = [("a.docx", "a", "A", "x", "", "2001", ["c"], 0), ("c.txt", "c", "C", "y", "ed", "2010", [], 1), ("d.txt", "d", "D", "y", None, "2001", [], 2)]
    schema = "file string, slug string, title string, author string, editor string, date string, categories array<string>, ordinal int"
    got = readers.book_records(files, spark.createDataFrame(about, schema)).orderBy("ordinal").collect()
    assert [(r["slug"], r["book_path"], r["editor"], r["text"]) for r in got] == [("c", "books/c.txt", "ed", "tc"), ("a", "books/a.docx", None, "ta"), ("d", "books/d.txt", None, "td")]
    with pytest.raises(FileNotFoundError, match="q.txt"):
        readers.book_records(files, spark.createDataFrame([("q.txt", *about[0][1:])], schema))


def test_build(spark, tmp_path):
    root, out = tmp_path / "root", tmp_path / "out"
    (root / "data").mkdir(parents=True)
    (root / "data/d.jsonl").write_text('{"word": "тӏад"}\n{"word": "гъоркь"}\n{"word": "абан"}\n')
    (root / "data/c.json").write_text(json.dumps([{"chapter": 1, "SentenceNumber": 1, "av": "x", "ru": "y"}, {"chapter": 2, "SentenceNumber": 1, "av": "z"}]))
    (root / "data/a.jsonl").write_text('{"slug": "s", "title": "t", "date": "2020-01-02", "text": "p", "url": "u", "categories": ["k"]}\n{"slug": "s", "date": "2021"}\n')
    (root / "f.pdf").write_bytes(b"pdf")
    doc = {"title": "f", "path": "f.pdf"}
    (root / "registry.json").write_text(json.dumps({"sources": [
        {"id": "d", "title": "D", "format": "jsonl", "data_path": "data/d.jsonl", "documents": [doc, doc, {"title": "n", "path": "none.pdf"}]},
        {"id": "c", "title": "C", "kind": "corpus", "format": "json", "data_path": "data/c.json", "documents": [doc]},
        {"id": "a", "title": "A", "kind": "articles", "format": "jsonl", "data_path": "data/a.jsonl", "site_path": "arch"},
    ]}))
    out.mkdir()
    (out / "stale.html").write_text("old")
    with pytest.warns(UserWarning, match="none.pdf"):
        assert build.build(spark, str(root), str(out), site="https://example.org") == {"d": (3, 4), "c": (2, 3), "a": (2, 5)}
    made = {str(p.relative_to(out)) for p in out.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert made == {"registry.json", "build.json", "index.html", "f.pdf", "data/d.jsonl", "data/c.json", "data/a.jsonl", "d/index.html", "d/тӏад.html", "d/гъор.html", "d/аба.html", "c/index.html", "c/1.html", "c/2.html", "arch/index.html", "arch/a/s.html", "arch/a/s-2.html", "arch/y/2020.html", "arch/y/2021.html"}
    page = (out / "d/тӏад.html").read_text()
    assert 'aria-current="page">тӏ</a>' in page and "<span>б</span>" in page and "report</a>" in page and 'rel="prev"' in page
    assert 'id="letter-%D0%B0"' in (out / "d/index.html").read_text() and 'href="2.html"' in (out / "c/index.html").read_text()
    assert "2020-01-02 … 2021" in (out / "arch/index.html").read_text() and '<a href="u">' in (out / "arch/a/s-2.html").read_text()
    assert json.loads((out / "build.json").read_text())["stats"]["c"] == {"entries": 2, "pages": 3}
    (root / "data/a.jsonl").unlink()
    with pytest.raises(FileNotFoundError):
        build.build(spark, str(root), str(out))
    assert (out / "index.html").exists()


def test_repeated_headwords_pair_off(spark):
    schema = "w string, place int, text string, examples array<string>"
    old = diff.in_turn(spark.createDataFrame([("a", 1, "x", []), ("a", 2, "y", []), ("b", 3, "z", [])], schema), ["w"], ["place"])
    new = diff.in_turn(spark.createDataFrame([("a", 1, "x", []), ("a", 2, "q", ["e"]), ("a", 3, "n", [])], schema), ["w"], ["place"])
    got = {(r["w"], r["turn"], r["line"], r["gained"]) for r in diff.notation(diff.entry_diff(old, new, ["w", "turn"])).collect()}
    assert got == {("a", 2, "~ text: y -> q", "e"), ("a", 3, "+ n", ""), ("b", 1, "- z", "")}


def test_docx_and_writers(spark, tmp_path):
    books = tmp_path / "books"
    books.mkdir()
    with zipfile.ZipFile(books / "a.docx", "w") as z:
        z.writestr("word/document.xml", "<w:body><w:p><w:r><w:t>т1ок1ав &amp; x  </w:t></w:r></w:p><w:p/><w:p/><w:p><w:t>y</w:t></w:p></w:body>")
    assert [r["text"] for r in readers.books(spark, str(books)).collect()] == ["тӏокӏав & x\n\ny\n"]
    writers.write_files(spark.createDataFrame([("p/ж.html", "<p>ӏ</p>")], "path string, html string"), str(tmp_path / "site"))
    assert (tmp_path / "site/p/ж.html").read_text() == "<p>ӏ</p>"
    assert writers.copy_file(spark, str(tmp_path / "none"), str(tmp_path / "x"), must_exist=False) is False
    writers.write_jsonl(spark.createDataFrame([("a", None)], "a string, b string"), str(tmp_path / "j"))
    assert "".join(p.read_text() for p in (tmp_path / "j").glob("*.json")) == '{"a":"a"}\n'


def test_pretty_json(spark):
    raw = '{"b": 1, "a": ["ӏ", {"c": null}]}'
    df = spark.createDataFrame([(raw,), (None,)], "raw string")
    assert [r[0] for r in df.select(render.pretty_json("raw")).collect()] == [json.dumps(json.loads(raw), indent=2, ensure_ascii=False), None]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"word": "гъоркь"}\n{"phrase": "тӏад"}\n')
    q = ingest.bucket_counts(ingest.entries(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("buckets").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["letter"], r["prefix"], r["count"]) for r in spark.table("buckets").collect()} == {("гъ", "гъор", 1), ("тӏ", "тӏад", 1)}


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.oracle_sql() if not re.match(r"op\d", n)))
def test_query_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    got = __spark_entry__.queries()[name](spark, SF)
    want = con.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def flat(rows):
        return sorted(tuple(map(str, r)) for r in rows)

    assert flat(got.select(columns).collect()) == flat(want.select(*columns).fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).select(F.count("*")).first()[0] > 0


def test_places_in_hot_groups(spark):
    rows = [(i, None if i % 3 else f"g{i % 5}", (i * 7919) % 101) for i in range(3000)]
    df = spark.createDataFrame(rows, "i long, g string, k long")
    got = {r["i"]: r["place"] for r in order.placed(df, ["g"], [F.col("k").desc(), F.col("i")], "place").collect()}
    seen = {}
    for i, g, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        seen[g] = seen.get(g, 0) + 1
        assert got[i] == seen[g]
    assert order.placed(df.limit(0), ["g"], [F.col("i")], "place").collect() == []


def test_names_that_meet(spark):
    rows = [(1, "x"), (2, "x-2"), (3, "x"), (4, "x"), (5, "y 7"), (6, "y 7"), (7, None), (8, "жж"), (9, "x-2-2"), (10, "x-2"), (11, "z-2"), (12, "z-2")]
    df = spark.createDataFrame([(i, s, None if i % 2 else "2020-01-01") for i, s in rows], "ordinal long, slug string, date string")
    used, names = set(), {}
    for i, s in sorted(sorted(rows), key=lambda r: (r[0] % 2 == 0, r[1] or ""), reverse=True):
        base = re.sub("[^a-z0-9]+", "-", (s or "").lower()).strip("-") or "article"
        names[i], n = base, 2
        while names[i] in used:
            names[i], n = f"{base}-{n}", n + 1
        used.add(names[i])
    got = {r["ordinal"]: r["file"] for r in articles.file_names(df).collect()}
    assert len(set(got.values())) == len(rows)
    assert got == names


def test_spaced_tokens(spark):
    words = ["", None, "гъоркь", "Т1ад I к1а", "x\nгь", "ЧIII 1"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found, number = collate.spaced(F.col("w"))
    for r in df.select(collate.tokens(F.col("w")).alias("tk"), found.alias("s"), number.alias("n")).collect():
        assert (r["s"], r["n"]) == (" ".join(r["tk"]), len(r["tk"]))
