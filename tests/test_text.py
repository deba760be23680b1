import random

import pytest
from pyspark.sql import functions as F

from lexloom.functions import clean, collate, text

GOLDEN = {
    "т1ок1ав": "тӏокӏав", "Ӏ993": "1993", "Ӏ классалдаса": "1 классалдаса", "чII": "чӏ", "т11": "тӏ", "тӏӏ": "тӏ", "ГIумру": "ГӀумру",
    "ХIХ": "ХӀХ", "XIX": "XIX", "IT-технологиязул": "IT-технологиязул", "I-себ": "1-себ", "i730-абилел": "1730-абилел", "к1990": "кӏ990",
}


def apply(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("c"))).collect()]


def test_palochka_golden(spark):
    assert apply(spark, text.palochka, GOLDEN) == list(GOLDEN.values())


def test_palochka_properties(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice("тТгкчаIil1|Ӏӏǀ x9Z") for _ in range(rng.randint(0, 9))) for _ in range(400)]
    once = apply(spark, lambda c: text.palochka(F.lower(c)), values)
    assert apply(spark, lambda c: text.palochka(F.lower(c)), once) == once
    tokens = apply(spark, lambda c: collate.tokens(c), values)
    assert ["".join(t) for t in tokens] == once
    for t in (x for ts in tokens for x in ts):
        assert not set(t) & set("|ǀӀ") and ("ӏ" not in t or t in collate.DIGRAPHS)


def test_tokens_and_keys(spark):
    assert apply(spark, collate.tokens, ["гъоркь", "тӏад", "", None]) == [["гъ", "о", "р", "кь"], ["тӏ", "а", "д"], [], []]
    assert apply(spark, lambda c: collate.prefix(collate.tokens(c)), ["гъоркь", "", "а"]) == ["гъор", "?", "а"]
    assert apply(spark, lambda c: collate.letter(collate.prefix(collate.tokens(c))), ["гъоркь", ""]) == ["гъ", "?"]
    assert apply(spark, lambda c: collate.sort_key(collate.tokens(c)), ["агъ-"]) == [[0, 4, 10_000 + ord("-")]]
    assert len(collate.AVAR) == 46 and len(collate.RUSSIAN) == 33 and len(collate.ENGLISH) == 26


def test_collapse_blank_lines(spark):
    def brute(s):
        out, blank = [], 0
        for line in (x.rstrip() for x in s.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            blank = blank + 1 if not line else 0
            if blank <= 1:
                out.append(line)
        return "\n".join(out).strip() + "\n"

    rng = random.Random(2)
    values = ["".join(rng.choice("ab \t\n\r ") for _ in range(rng.randint(0, 14))) for _ in range(300)]
    assert apply(spark, text.collapse_blank_lines, values) == [brute(v) for v in values]


def test_small_functions(spark):
    assert apply(spark, text.escape_html, ["<a href=\"x\">'&", None]) == ["&lt;a href=&quot;x&quot;&gt;&#x27;&amp;", ""]
    assert apply(spark, text.slug_base, ["Hello, World!", "слово", None, "--a--"]) == ["hello-world", "article", "article", "a"]
    assert apply(spark, lambda c: text.roman(c.cast("int")), ["0", "-3", "4", "1994", "3999", None]) == ["", "", "IV", "MCMXCIV", "MMMCMXCIX", ""]
    assert apply(spark, text.anchor_base, ["a b/c", ""]) == ["a_b_c", "_"]
    assert apply(spark, text.url_quote, ["a b*~/ӏ"]) == ["a%20b%2A~%2F%D3%8F"]
    assert apply(spark, lambda c: text.date_key(c, 4), ["2024-01-02", "", None]) == ["2024", "—", "—"]


@pytest.mark.parametrize(
    ("rule", "pairs"),
    [
        (clean.hyphen_suffix, {"UFCялъул": "UFC-ялъул", "COVIDалъул": "COVID-алъул", "YouTubeканалалдасан": "YouTube-каналалдасан"}),
        (clean.footnote_digits, {"кавуда4": "кавуда", "Похъица5": "Похъица"}),
        (clean.numeric_palochka, {"ӏ970": "1970", "202ӏ": "2021", "тӏ2": "тӏ2"}),
        (lambda c: clean.apply_rules(c, [clean.numeric_palochka]), {"ӏ00": "100"}),
        (lambda c: clean.apply_rules(c, clean.ROMAN_REPAIR), {"ХӏХ": "ХIХ", "Вӏ": "В1", "ӏХ": "IХ", "Ӏ-себ": "1-себ"}),
        (clean.dot_split, {"батилилан.ЦӀоралъул": "батилилан. ЦӀоралъул", "с.гӏ.в.": "с.гӏ.в.", "ун.гьел": "ун.гьел"}),
        (clean.inner_underscore, {"чӏужу_ялъги": "чӏужуялъги"}),
        (clean.homoglyphs, {"xIapп": "хӏарп", "TIacaлъугьа": "тӏасалъугьа".replace("т", "Т").replace("ӏ", "Ӏ", 1), "Mapуса": "Маруса", "COVID": "COVID"}),
        (clean.stem, {"АБСТРАКЦИОНИ  СТСК": "АБСТРАКЦИОНИСТСК"}),
        (lambda c: F.array_join(clean.variants(c), "|"), {"а) семь раз, семью б) всемеро": "семь раз, семью|всемеро", "(по)валить": "(по)валить"}),
        (clean.without_label, {"частица не": "не"}),
        (lambda c: clean.homonym(c)[0], {"выставка1.": "выставка"}),
        (lambda c: clean.homonym(c)[1].cast("string"), {"выставка1.": "1", "дом": None}),
    ],
)
def test_cleaning_golden(spark, rule, pairs):
    assert apply(spark, rule, pairs) == list(pairs.values())


def test_numeric_palochka_takes_whole_runs(spark):
    pairs = {"5ӏӏӏӏ": "51111", "20ӏӏӏӏӏӏӏ ӏӏ": "201111111 ӏӏ", "ӏӏӏӏӏ0": "111110", "ӏ0ӏӏӏӏ": "101111", "ӏӏӏӏ": "ӏӏӏӏ", "тӏӏ": "тӏӏ", "7Ӏӏ ӏтӏ": "711 ӏтӏ", "ӏ": "ӏ", "": "", None: None}
    assert apply(spark, clean.numeric_palochka, pairs) == list(pairs.values())


def test_homoglyphs_token_by_token(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("xIкTaцбi|1 \n.K") for _ in range(rng.randint(0, 12))) for _ in range(500)] + ["xI\n", "aab  xIapп", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    whole = {r["i"]: r["x"] for r in df.select("i", clean.homoglyphs(F.col("t")).alias("x")).collect()}
    parts = df.select("i", F.posexplode(F.split("t", " ")).alias("p", "w")).select("i", "p", clean.homoglyphs(F.col("w")).alias("x")).collect()
    for i, t in enumerate(texts):
        assert whole[i] == (None if t is None else " ".join(r["x"] for r in sorted((r for r in parts if r["i"] == i), key=lambda r: r["p"])))
