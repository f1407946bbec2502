"""Licence scans with a positional index of rare words.

Templates are short licence notices. Each has a mandatory key phrase, a run of consecutive words
inside it. The index holds, for every template, the rarest words of the key phrase (highest inverse
document frequency over all files) with their positions. A file looks up which indexed words it has;
each occurrence gives a place where the phrase would have to start, the postings of the other rare
words must agree on that place, and the whole phrase is then compared word by word. A file that
holds a key phrase holds its rarest words, so no place is missed.

Everything about a file happens in its own row: the only shuffle is that of the word counts, which has
one row per template word and task.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import free_name, plain_words


@dataclass(frozen=True)
class Template:
    """A notice; ``phrase`` must occur word for word, ``text`` (which holds it) gives the score."""

    label: str
    phrase: str
    text: str = ""
    base: bool = False

    @property
    def phrase_words(self) -> list[str]:
        return _words(self.phrase)

    @property
    def text_words(self) -> list[str]:
        return _words(self.text or self.phrase)

    @property
    def phrase_at(self) -> int:
        """Where the phrase starts in the text."""
        words, phrase = self.text_words, self.phrase_words
        return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def _words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


# The phrases and labels that the query's contract names.
BASE = [
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
]

# Notices of common licences, with the part of each that must be there.
NOTICES = [
    Template("gpl-2", "gnu general public license version 2", "under the terms of the gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3", "licensed under the gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license", "under the terms of the gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "under the terms of the gnu affero general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("apache-2", "licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"),
    Template("mpl-2", "mozilla public license v 2 0", "subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software"),
    Template("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain"),
    Template("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "licensed under the creative commons attribution noncommercial license"),
    Template("cc0", "cc0 1 0 universal"),
]
TEMPLATES = BASE + NOTICES
RARE_WORDS = 2


def document_frequency(words: DataFrame, column: str, vocabulary: list[str]) -> tuple[int, dict]:
    """Number of rows, and for each word of ``vocabulary`` in how many rows' word lists it stands."""
    present = F.array_intersect(F.col(column), F.array(*map(F.lit, vocabulary)))
    # The empty word stands for the row itself.
    counts = (
        words.select(F.explode(F.concat(present, F.array(F.lit("")))).alias("word"))
        .groupBy("word")
        .count()
        .collect()
    )
    found = {r["word"]: r["count"] for r in counts}
    return found.pop("", 0), found


def inverse_frequency(rows: int, counts: dict, vocabulary: list[str]) -> dict[str, float]:
    return {w: math.log((1 + rows) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}


def rare_postings(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of the key phrase (first occurrence of each) and their positions in it."""
    first = {w: i for i, w in reversed(list(enumerate(template.phrase_words)))}
    rare = sorted(first, key=lambda w: (-idf[w], w))[:RARE_WORDS]
    return [(w, first[w]) for w in rare]


def _starts(words: Column, rare: list[tuple[str, int]], phrase: list[str]) -> Column:
    """Places (from 0) at which ``phrase`` stands in ``words``."""

    def offsets(word: str, at: int) -> Column:
        return F.filter(
            F.transform(words, lambda w, i: F.when(w == word, i - at)), lambda i: i.isNotNull()
        )

    places = offsets(*rare[0])
    for other in rare[1:]:
        places = F.array_intersect(places, offsets(*other))
    wanted = F.array(*map(F.lit, phrase))
    return F.filter(
        places, lambda i: (i >= 0) & (F.slice(words, i + 1, F.lit(len(phrase))) == wanted)
    )


def _score(words: Column, starts: Column, template: Template, idf: dict[str, float]) -> Column:
    """Best share, by inverse frequency, of the template's words that stand at their positions."""
    text, at = template.text_words, template.phrase_at
    total = sum(idf[w] for w in text)

    def share(start: Column) -> Column:
        hits = [
            F.when(F.get(words, start + (j - at)) == w, F.lit(idf[w])).otherwise(F.lit(0.0))
            for j, w in enumerate(text)
        ]
        return F.least(F.lit(1.0), sum(hits, F.lit(0.0)) / F.lit(total))

    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def scan_licenses(
    documents: DataFrame, text: str = "text", templates: list[Template] | None = None
) -> DataFrame:
    """All columns of ``documents`` and what the templates find in ``text``.

    Adds ``n_words``, ``places`` (label, base, start and score of each place, by start), ``n_base``,
    ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score`` (the best of any
    place, 0 where there is none); columns of these names are replaced. A NULL or empty text has no
    words and no places. Repeated rows are scanned like others.
    """
    templates = templates or TEMPLATES
    vocabulary = sorted({w for t in templates for w in t.text_words})
    made = ["n_words", "places", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kept = [c for c in documents.columns if c.lower() not in made]
    words, places = free_name(documents, "_words"), free_name(documents, "_places")
    listed = documents.select(*kept, plain_words(F.col(text)).alias(words))
    rows, counts = document_frequency(listed, words, vocabulary)
    idf = inverse_frequency(rows, counts, vocabulary)
    index = [(t, rare_postings(t, idf)) for t in templates]
    none = F.array().cast("array<struct<label:string,base:boolean,start:int,score:double>>")

    def found(template: Template, rare: list[tuple[str, int]]) -> Column:
        starts = _starts(F.col(words), rare, template.phrase_words)
        return F.transform(
            starts,
            lambda i: F.struct(
                F.lit(template.label).alias("label"),
                F.lit(template.base).alias("base"),
                i.alias("start"),
                _score(F.col(words), F.array(i), template, idf).alias("score"),
            ),
        )

    # A template is looked at only where the file has all its indexed words.
    anchors = sorted({w for _, rare in index for w, _ in rare})
    has = F.array_intersect(F.col(words), F.array(*map(F.lit, anchors)))
    present = free_name(documents, "_present")
    looked = [
        F.when(
            F.size(F.array_intersect(F.col(present), F.array(*(F.lit(w) for w, _ in rare))))
            == len(rare),
            found(t, rare),
        ).otherwise(none)
        for t, rare in index
    ]
    order = lambda a, b: (
        F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
        .when(a["label"] < b["label"], -1).when(a["label"] > b["label"], 1).otherwise(0)
    )
    scanned = listed.withColumn(present, has).select(
        *kept,
        F.size(words).cast("long").alias("n_words"),
        F.when(F.size(present) > 0, F.concat(*looked)).otherwise(none).alias(places),
    )
    base = F.filter(places, lambda p: p["base"])
    label_list = lambda p: F.array_join(F.array_sort(F.array_distinct(p["label"])), ",")
    return scanned.select(
        *kept,
        "n_words",
        F.array_sort(F.col(places), order).alias("places"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["start"]).cast("long").alias("first_word"),
        F.array_max(base["start"]).cast("long").alias("last_word"),
        label_list(base).alias("base_labels"),
        label_list(F.col(places)).alias("labels"),
        F.coalesce(F.array_max(F.col(places)["score"]), F.lit(0.0)).alias("score"),
    )
