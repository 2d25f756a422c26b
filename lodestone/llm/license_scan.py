"""Licence scan, in DataFrame functions only.

Templates are passages of licences and their notices.  Words are ranked by inverse document frequency
over the whole corpus.  A file's words are looked up in the postings of the templates' rarest words, each
template's own, so that several notices in one file do not compete: a word at position i of the
file and p of the template says that the template begins at i - p.  Where at one beginning enough
of the weight of a template's rarest words stands at their relative positions, its mandatory
phrases are verified, and it gives its label and its share of the weight.

Beside that, fixed phrases are found exactly, wherever their words stand in a row.  A file's score is
the best share of its templates, and at least BASE_SCORE where a fixed phrase stands.

Defined results: a null text is empty; it has no words, no label, score 0.0 and null positions;
repeated rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

#: Words of a text, once A-Z is in lower case, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: (label, passage, mandatory phrases)
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ("above copyright notice and this permission notice", "substantial portions of the software")),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("in compliance with the license", "apache org licenses")),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("required by applicable law", "as is")),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "general public license")),
    ("lgpl", "licensed under the gnu lesser general public license version 3", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license version 3", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use", "source and binary forms")),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistributions of source code", "this list of conditions")),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ("redistributions in binary form", "other materials provided with the distribution")),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ("provided as is", "authors be held liable")),
    ("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use", "hereby granted")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0", "dedicated to the public domain under the cc0 1 0 universal dedication", ("public domain", "cc0")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
)
#: A template's rarest words that are looked up, and the share of their weight that must align.
RAREST, SHARE = 12, 0.6
BASE_SCORE = 0.5
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPLIT = [t.split() for _, t, _ in TEMPLATES]
VOCABULARY = sorted({w for t in _SPLIT for w in t})


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(text: Column) -> Column:
    """The text's words with blanks between and around them; at its ends there may be two."""
    return F.concat(F.lit(" "), F.regexp_replace(F.translate(text, _AZ, _az), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))


def _words(joined: Column) -> Column:
    return F.when(F.trim(joined) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(joined), " "))


def _contains_any(joined: Column, phrases: set[str]) -> Column:
    out = F.lit(False)
    for p in sorted(phrases):
        out = out | joined.contains(f" {p} ")
    return out


class _Template:
    """A template's rarest words (weight, position, word), and the fewest of them that every good place has one of."""

    def __init__(self, t: int, idf: dict[str, float]):
        self.label, _, self.phrases = TEMPLATES[t]
        self.rare = [(x, -p, w) for x, p, w in sorted(((idf[w], -p, w) for p, w in enumerate(_SPLIT[t])), reverse=True)[:RAREST]]
        self.total = math.fsum(x for x, *_ in self.rare)
        n = next(k for k in range(1, len(self.rare) + 1) if math.fsum(x for x, *_ in self.rare[k:]) < SHARE * self.total - 1e-9)
        self.postings = [(p, w) for _, p, w in self.rare[:n]]

    def best(self, ws: Column, joined: Column) -> Column:
        """The greatest share of the weight that stands at one place of the text; -1 if no posting is there or a mandatory phrase is not."""
        words = {w for _, w in self.postings}
        anchors = F.array(*map(F.lit, sorted(words)))
        at = F.filter(F.transform(ws, lambda w, i: F.when(F.array_contains(anchors, w), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())

        def begins(at: Column) -> Column:
            of = lambda p, v: F.transform(F.filter(at, lambda x: x["w"] == v), lambda x: x["i"] - p)
            return F.array_distinct(F.flatten(F.array(*(of(p, v) for p, v in self.postings))))

        def share(begin: Column) -> Column:
            out = F.lit(0.0)
            for x, p, w in self.rare:
                out = out + F.when(F.get(ws, begin + p) == w, F.lit(x)).otherwise(F.lit(0.0))
            return F.least(F.lit(1.0), out / F.lit(self.total))

        verified = F.lit(True)
        for p in self.phrases:
            verified = verified & joined.contains(f" {p} ")
        found = F.coalesce(F.array_max(F.transform(_let(at, begins), share)), F.lit(-1.0))
        return F.when(_contains_any(joined, words), _let(found, lambda x: F.when((x >= SHARE) & verified, x).otherwise(F.lit(-1.0)))).otherwise(F.lit(-1.0))


def document_frequency(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Documents, and how many hold each word of the templates; the result has at most len(VOCABULARY) rows."""
    known = F.array_intersect(_words(_joined(F.coalesce(F.col(text), F.lit("")))), F.array(*map(F.lit, VOCABULARY)))
    counts = docs.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    found = {r["word"]: r["count"] for r in counts}
    return found.pop("", 0), found


def _places(ws: Column, phrase: list[str]) -> Column:
    """Word positions, from 0, where the phrase begins."""
    last = F.size(ws) - len(phrase)
    whole = lambda i: [F.get(ws, i + k if k else i) == w for k, w in enumerate(phrase)]

    def here(i: Column) -> Column:
        out = whole(i)[0]
        for test in whole(i)[1:]:
            out = out & test
        return out

    return F.when(last < 0, F.array().cast("array<int>")).otherwise(F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here))


def scan(docs: DataFrame, text: str = "text", into: str = "licence") -> DataFrame:
    """docs with a struct: n_words, base array<struct<start,label>>, found array<struct<label,score>>."""
    n, df = document_frequency(docs, text)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1e-6 for w in VOCABULARY}
    lines = F.coalesce(F.col(text), F.lit(""))
    templates = [_Template(t, idf) for t in range(len(TEMPLATES))]
    hints = {p for p, _ in BASE} | {w for t in templates for _, w in t.postings}

    def looked_up(ws: Column, joined: Column) -> Column:
        each = [F.struct(F.lit(t.label).alias("label"), t.best(ws, joined).alias("score")) for t in templates]
        return F.filter(F.array(*each), lambda x: x["score"] >= SHARE)

    def base(ws: Column) -> Column:
        def of(phrase: str, label: str) -> Column:
            return F.transform(_places(ws, phrase.split()), lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))

        return F.array_sort(F.flatten(F.array(*(of(p, label) for p, label in BASE))))

    none = F.struct(F.array().cast("array<struct<start:int,label:string>>").alias("base"), F.array().cast("array<struct<label:string,score:double>>").alias("found"))
    # Texts without a base phrase or a posting get no array of words.
    both = lambda j: _let(_words(j), lambda ws: F.struct(base(ws).alias("base"), looked_up(ws, j).alias("found")))

    def found(j: Column) -> Column:
        inner = F.trim(j)
        count = F.when(inner == "", 0).otherwise(F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit(""))) + 1)
        return F.struct(count.cast("long").alias("n_words"), F.when(_contains_any(j, hints), both(j)).otherwise(none).alias("x"))

    return docs.withColumn(into, _let(_let(_joined(lines), found), lambda f: F.struct(f["n_words"].alias("n_words"), f["x"]["base"].alias("base"), f["x"]["found"].alias("found"))))


def labels(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    x = scan(docs.select("doc_id", "text")).select("doc_id", "licence.*")
    start = F.transform("base", lambda b: b["start"].cast("long"))
    base = F.transform("base", lambda b: b["label"])
    found = F.transform("found", lambda b: b["label"])
    distinct = lambda xs: F.array_join(F.array_sort(F.array_distinct(xs)), ",")
    best = F.array_max(F.transform("found", lambda b: b["score"]))
    return x.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        distinct(base).alias("base_labels"),
        distinct(F.concat(base, found)).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
    )
