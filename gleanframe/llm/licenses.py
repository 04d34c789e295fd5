"""License scans by a positional index of rare licence words.

Of each template the index holds its ``ANCHORS`` words of highest inverse document frequency,
which comes from all rows, and the offsets they stand at. A file is looked through once for
those words. Each place says where a template would start; starts that two of a template's
words agree on are intersected, and there the mandatory key phrases are compared. Templates
are few and fixed, so the index is a constant of the expression. All steps take time in
proportion to a file's words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import let, lower_ascii, positions

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are counted, and their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Phrases of the text that must stand at their places.
    key_phrases: tuple[str, ...]


#: Wordings by which licences are stated.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("permission is hereby granted", "this software"),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software",
        ("permission is hereby granted", "this software"),
    ),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ("apache license",),
    ),
    Template("gpl", "licensed under the gnu general public license version", ("general public license",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version",
        ("general public license",),
    ),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use", "binary forms"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        ("redistribution and use", "binary forms"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify",),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be "
        "held liable for any damages arising from the use of this software",
        ("without any express or implied warranty",),
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by",)),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
)
#: Words of templates that tell nothing by themselves.
COMMON = frozenset(
    "the of and to in a is all this under or with for any are by use 2 4 0 nc sa without you may not it can as at that be will no from".split()
)
#: Words of a template that are looked up, its rarest; two of them must agree on where it starts.
ANCHORS = 3
MIN_SHARE = 0.5


def license_words() -> list[str]:
    return sorted({w for t in TEMPLATES for w in t.text.split()} - COMMON)


def file_words(text: Column) -> Column:
    """Maximal runs of digits, letters and characters beyond ASCII, A-Z lower-cased; none for null."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), lambda w: w != "")


def document_frequencies(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Inverse document frequency of each licence word over all rows of ``docs``."""
    vocabulary = license_words()
    present = F.array_distinct(F.filter(file_words(F.col(text_col)), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(F.concat(present, F.array(F.lit(""))))).groupBy("col").count()
    found = {row["col"]: row["count"] for row in counts.collect()}  # a row for each word of the templates at most
    rows = found.get("", 0)
    return {w: math.log((rows + 1) / (found.get(w, 0) + 0.5)) for w in vocabulary}


def _base_places(w: Column) -> Column:
    """(word number, label) of every place of a base phrase."""

    def here(phrase: str, i: Column) -> Column:
        test = F.lit(True)
        for j, word in enumerate(phrase.split()):
            test = test & (F.get(w, i + j) == word)
        return test

    def label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in reversed(BASE_PHRASES):
            out = F.when(here(phrase, i), name).otherwise(out)
        return out

    firsts = sorted({phrase.split()[0] for phrase, _ in BASE_PHRASES})
    starts = F.filter(positions(0, F.size(w) - 1), lambda i: F.get(w, i).isin(firsts))
    places = F.transform(starts, lambda i: F.struct(i.alias("at"), label(i).alias("label")))
    return F.filter(places, lambda p: p["label"].isNotNull())


def anchors(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The template's rarest words, rarest first, and where each stands first in it."""
    text = template.text.split()
    rare = sorted(set(text) - COMMON, key=lambda w: (-idf[w], text.index(w)))[:ANCHORS]
    return [(w, text.index(w)) for w in rare]


def _starts(hits: Column, index: list[tuple[str, int]]) -> Column:
    """Word numbers at which a template would start by two of its words."""

    def by(word: str, at: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["p"] - at)

    def agreed(lists: Column) -> Column:
        pairs = [(i, j) for j in range(len(index)) for i in range(j)]
        out = F.array().cast("array<int>")
        for i, j in pairs:
            out = F.array_union(out, F.array_intersect(lists[i], lists[j]))
        return out

    return let(F.array(*[by(word, at) for word, at in index]), agreed)


def _judged(w: Column, start: Column, template: Template, idf: dict[str, float]) -> Column:
    """(label, score) of a template at a start: the share of its words' weight that stands in place, 0 without a key phrase."""
    text = template.text.split()
    word = lambda at: F.when(start + at >= 0, F.get(w, start + at))
    whole = F.lit(True)
    for phrase in template.key_phrases:
        wanted = phrase.split()
        at = next(i for i in range(len(text)) if text[i : i + len(wanted)] == wanted)
        for j, v in enumerate(wanted):
            whole = whole & F.coalesce(word(at + j) == v, F.lit(False))
    telling = [(v, at, idf[v]) for at, v in enumerate(text) if v not in COMMON]
    total = sum(weight for _, _, weight in telling)
    known = F.array(*[F.struct(F.lit(v).alias("w"), F.lit(at).alias("at"), F.lit(weight).alias("idf")) for v, at, weight in telling])
    held = F.aggregate(known, F.lit(0.0), lambda a, v: a + F.when(word(v["at"]) == v["w"], v["idf"]).otherwise(0.0))
    return F.struct(F.lit(template.label).alias("label"), F.when(whole, F.least(held / total, F.lit(1.0))).otherwise(0.0).alias("score"))


def _found(w: Column, idf: dict[str, float]) -> Column:
    """(label, score) of every template that is verified in a file."""
    index = [(template, anchors(template, idf)) for template in TEMPLATES]
    wanted = sorted({word for _, words in index for word, _ in words})
    places = F.filter(positions(0, F.size(w) - 1), lambda i: F.get(w, i).isin(wanted))
    hits = F.transform(places, lambda i: F.struct(F.get(w, i).alias("w"), i.alias("p")))
    none = F.array().cast("array<struct<label:string,score:double>>")

    def all_templates(h: Column) -> Column:
        judge = lambda template: lambda at: _judged(w, at, template, idf)
        each = [F.transform(_starts(h, words), judge(template)) for template, words in index]
        return F.when(F.size(h) > 1, F.filter(F.concat(*each), lambda f: f["score"] >= MIN_SHARE)).otherwise(none)

    return let(hits, all_templates)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base phrases and licence templates of every row; other columns are left out.

    ``score`` is the best share of a verified template's word weight, 0 without any. Null
    texts are empty: no words, no labels (empty strings), score 0. Rows are judged one by one,
    so repeated rows and null ids need no rule; an empty table gives an empty result.
    """
    idf = document_frequencies(docs, text_col)

    def judged(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), _base_places(w).alias("places"), _found(w, idf).alias("found")
        )

    labels = lambda c, *more: F.array_join(F.sort_array(F.array_distinct(F.concat(c["label"], *more))), ",")
    scanned = docs.select(F.col(id_col).alias("doc_id"), let(file_words(F.col(text_col)), judged).alias("r"))
    places, found = F.col("r.places"), F.col("r.found")
    return scanned.select(
        "doc_id",
        F.col("r.n_words").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places["at"]).cast("long").alias("first_word"),
        F.array_max(places["at"]).cast("long").alias("last_word"),
        labels(places).alias("base_labels"),
        labels(places, found["label"]).alias("labels"),
        F.coalesce(F.array_max(found["score"]), F.lit(0.0)).alias("score"),
    )
