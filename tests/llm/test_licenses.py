from brute import plain_words
from pyspark.sql import functions as F
from corpora import documents, nothing, prepared, texts  # noqa: F401

from accrual.llm.license_index import BASE, TEMPLATES, rare_postings, scan_licenses

TEXTS = [
    "Released under the MIT License. Under the mit license again",
    "under the mit\nlicense, under mit license",
    "Licensed under the Apache License, Version 2.0. CC BY-NC 4.0",
    "GNU General Public License, version 3. the the the license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
    "apache license version 2 apache license version 2",
    "license mit the under by cc nc by",
    "", None, "...", "Éunder the mit license", "word " * 40_000 + "cc by nc",
]


def brute(text):
    words = plain_words(text)
    found = []
    for t in TEMPLATES:
        phrase = t.phrase_words
        found += [(i, t.label, t.base) for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
    base = [f for f in found if f[2]]
    names = lambda x: ",".join(sorted({f[1] for f in x}))
    starts = [f[0] for f in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), names(base), names(found)
    )


def scanned(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, Labels string"))


def test_against_brute_force(spark):
    out = scanned(spark, TEXTS)
    got = {r["doc_id"]: r for r in out.collect()}
    for i, text in enumerate(TEXTS):
        r = got[i]
        values = tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
        assert values == brute(text), text
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        assert [p["start"] for p in r["places"]] == sorted(p["start"] for p in r["places"])
    assert out.columns == [
        "doc_id", "text", "n_words", "places", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    ]


def test_index_takes_the_rarest_words():
    idf = {w: 1.0 for t in TEMPLATES for w in t.text_words} | {"mit": 9.0, "license": 5.0}
    assert rare_postings(BASE[0], idf) == [("mit", 2), ("license", 3)]


def test_every_template_holds_its_phrase():
    assert all(t.phrase_at >= 0 for t in TEMPLATES)


def test_empty(nothing):
    out = scan_licenses(nothing)
    assert out.count() == 0 and "score" in out.columns


def test_repeated_rows(documents):
    out = scan_licenses(documents.withColumn("places", F.lit(1)))
    assert out.count() == documents.count()
