"""Explicit, nullable superset schemas of every record kind; nothing is inferred."""

from __future__ import annotations

_LINK = "struct<target:string,kind:string,comment:string>"
_EXAMPLE = "struct<av:string,ru:string,labels:array<string>,comment:string>"
_SENSE = (
    "struct<text:string,comment:string,precomment:string,labels:array<string>,forms:array<string>,masdarfrom:string,forceto:string,"
    f"examples:array<{_EXAMPLE}>,n:int,translation:string,literal:string,etymology:string,equiv:string,see_also:string,see_also_type:string>"
)
ENTRY = (
    "word string, phrase string, stress int, stem string, homonym int, pos string, form string, forms array<string>, gender_forms array<string>, "
    f"variants array<string>, interjection boolean, labels array<string>, page int, senses array<{_SENSE}>, "
    f"examples array<struct<av:string,ru:string,author:string,source:string>>, see_also array<{_LINK}>"
)
SENTENCE = "chapter int, SentenceNumber int, sentence int, title string, author string, av string, ru string"
ARTICLE = "slug string, title string, author string, editor string, date string, categories array<string>, url string, book_path string, text string"
SOURCE = (
    "id string, title string, subtitle string, kind string, status string, description string, format string, data_path string, site_path string, "
    "language_from string, language_to string, based_on string, license string, unit string, monolingual boolean, "
    "documents array<struct<title:string,kind:string,path:string,pdf:string>>, consumers array<string>"
)
KINDS = {"dictionary": ENTRY, "corpus": SENTENCE, "articles": ARTICLE}
