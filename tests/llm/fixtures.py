"""Small documents with every awkward case: nulls, empties, ties, copies, near copies, shared
passages, long texts, special strings, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tid long, token string, _kept long"


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    syllables = {"en": ["th", "er", "on", "an", "re", "ing"], "de": ["sch", "ü", "ein", "ß", "keit", "er"]}

    def words(k, lang):
        return ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(k)]

    rows, passage = [], " ".join(words(90, "en"))
    for i in range(n):
        lang = rng.choice(["en", "de"])
        w = words(rng.randint(5, 160), lang)
        text = " ".join(w).capitalize() + rng.choice([".", "!\n", "  x", " <|endoftext|>", "\n\n y"])
        if i % 6 == 0:
            text = text + "\n" + passage + " " + " ".join(words(5, lang))
        rows.append((text, lang))
    base = words(140, "en")
    rows.append((" ".join(base), "en"))
    for _ in range(8):
        near = list(base)
        for _ in range(rng.randint(1, 4)):
            near[rng.randrange(len(near))] = rng.choice(words(1, "de"))
        rows.append((" ".join(near), "en"))
    rows += [rows[3], rows[3], rows[len(rows) - 1]]
    rows += [(None, "en"), ("", "en"), (" \t\n", None), ("123 !! 45", "de"), ("a", "en"), ("a b", "en"), ("A B", "en"), ("a\x1cb", "en"), ("'s don't we'll  I'M", "en")]
    rows += [("ж" * 3000, None), ("ab" * 1500, "en"), (" ".join(words(4000, "de")), "de"), ("x<|startoftext|>y   <|endoftext|>", "en"), ("Ὀδυσσεύς ΣΑΣ É é 漢字", "de")]
    out = [(i * 3, t, lang, f"s{i % 3}" if i % 7 else None, len(t or ""), i, "x", None) for i, (t, lang) in enumerate(rows)]
    return [*out, out[10], out[70]]


BENCHMARK = [(0, None), (1, ""), (2, "one two"), (3, "!!"), (4, "two"), (5, "one two")]


def benchmark(rows: list[tuple]) -> list[tuple]:
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 60]
    return [*BENCHMARK, (10, " ".join(texts[0].split()[:20])), (11, " ".join(texts[1].split()[5:18])), (12, " ".join(texts[0].split()[3:30]).upper())]
