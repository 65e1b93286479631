"""Licence scan: a positional index of each template's rarest words, relative positions, and mandatory key phrases.

A rare word in a text is an anchor. From it the template's other words are followed to both sides, each to its nearest
place within GAP words, so that words put in or left out do not break a notice. The key phrases must be among what is
found, each in one piece.

Everything is DataFrame functions. A text is scanned in its own row; only how many texts hold each template word is
counted over all rows, at most one row for each word of the templates.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import documents

#: The base phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs between words: ASCII without digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """A notice: its label, its text, and phrases of which all must stand in the document."""

    label: str
    text: str
    keys: tuple[str, ...]


#: Public licence notices, as they are put into files.
TEMPLATES = (
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.", ("gnu general public license",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license",)),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.", ("lesser general public license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0.", ("apache license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction", ("permission is hereby granted", "without restriction")),
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use", "following conditions are met")),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ("creative commons attribution",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0.", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0.", ("cc by sa",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ("waived all copyright",)),
    Template("all-rights-reserved", "All rights reserved.", ("all rights reserved",)),
)

#: A template stands at a place if this share of its words do, in order; so many other words may stand between two.
LEAST_SHARE, GAP = 0.6, 3


def _split(text: str) -> list[str]:
    lower = "".join(_LOWER[_UPPER.index(c)] if c in _UPPER else c for c in text)
    return [w for w in re.split(BETWEEN, lower) if w]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), BETWEEN), "")


def anchors(rows: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> list[list[str]]:
    """For each template its rarest words over all rows of (words), as many as every match must hold one of.

    A match lacks some of the template's places at most; the anchors stand at one place more.
    """
    vocabulary = sorted({w for t in templates for w in _split(t.text)})
    held = rows.select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), F.col("words"))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}  # a row for each template word at most
    chosen = []
    for template in templates:
        words = _split(template.text)
        lacking = max(n for n in range(len(words)) if (len(words) - n) / len(words) >= LEAST_SHARE)
        own: list[str] = []
        for w in sorted(set(words), key=lambda w: (counts.get(w, 0), w)):
            if sum(map(words.count, own)) > lacking:
                break
            own.append(w)
        chosen.append(own)
    return chosen


def _phrase_places(phrases: Mapping[str, str]) -> Column:
    """(place, label) of every place where a phrase's words stand in `words`."""

    def at(phrase: str) -> Column:
        first, *rest = phrase.split()
        here = F.filter(
            F.transform("words", lambda w, i: F.when(w == first, i)),
            lambda i: i.isNotNull() if not rest else i.isNotNull() & (F.slice("words", i + 2, len(rest)) == F.array(*map(F.lit, rest))),
        )
        return F.transform(here, lambda i: F.struct(i.cast("long").alias("place"), F.lit(phrases[phrase]).alias("label")))

    return F.concat(*[at(p) for p in phrases])


def _posted(templates: tuple[Template, ...], chosen: list[list[str]]) -> Column:
    """(t, begin, i, at) for each place `at` of the text with an anchor, which is word i of template t, in this order."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (template, own) in enumerate(zip(templates, chosen, strict=True)):
        for i, w in enumerate(_split(template.text)):
            if w in own:
                postings.setdefault(w, []).append((t, i))
    lists = F.create_map(
        *[x for w, at in postings.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in at]))]
    )
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(F.array_contains(F.col("anchored"), w), F.struct(w.alias("w"), i.alias("i")))),
        lambda h: h.isNotNull(),
    )
    begins = F.transform(
        hits,
        lambda h: F.transform(
            lists[h["w"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["i"]).alias("begin"), p["i"].alias("i"), h["i"].alias("at"))
        ),
    )
    return F.array_sort(F.flatten(begins))


def _first_of_each(posted: str) -> Column:
    """Of anchors with one (t, begin), which lie on one line, only the first is followed."""

    def other(p: Column, k: Column) -> Column:
        before = F.get(F.col(posted), k - 1)
        return (k == 0) | (before["t"] != p["t"]) | (before["begin"] != p["begin"])

    return F.filter(posted, other)


def _chained(templates: tuple[Template, ...], p: Column) -> Column:
    """(t, found) with (i, begin) of each word of the template found in order from an anchor."""
    own = F.get(F.array(*[F.array(*[F.lit(w) for w in _split(t.text)]) for t in templates]), p["t"])
    none = F.array().cast("array<struct<i:int,begin:int>>")

    def follow(places: Column, window: Callable[[Column], Column], sign: int) -> Column:
        def step(state: Column, i: Column) -> Column:
            def reached(at: Column) -> Column:
                to = state["at"] + sign * at
                word = F.struct(i.alias("i"), (to - i).alias("begin"))
                return F.when(at > 0, F.struct(to.alias("at"), F.array_append(state["found"], word).alias("found"))).otherwise(state)

            def place(near: Column) -> Column:
                """The word's place, but 0 for one further on where the template's next word stands here: it is left out."""
                at = F.array_position(near, F.get(own, i)).cast("int")
                return F.when((at > 1) & F.coalesce(F.get(near, F.lit(0)) == F.get(own, i + sign), F.lit(False)), 0).otherwise(at)

            def once(value: Column, use: Callable[[Column], Column]) -> Column:
                """`use` of a value that is worked out once, as the only one of an array."""
                return F.get(F.transform(F.array(value), use), F.lit(0))

            return once(once(window(state["at"]), place), reached)

        return F.aggregate(places, F.struct(p["at"].alias("at"), none.alias("found")), step)["found"]

    def after(at: Column) -> Column:
        return F.slice("words", at + 2, GAP + 1)

    def before(at: Column) -> Column:
        begin = F.greatest(at - GAP - 1, F.lit(0))
        return F.reverse(F.slice("words", begin + 1, at - begin))

    last, no = F.size(own) - 1, F.array().cast("array<int>")
    up = F.when(p["i"] < last, F.sequence(p["i"] + 1, last)).otherwise(no)
    down = F.when(p["i"] > 0, F.sequence(p["i"] - 1, F.lit(0), F.lit(-1))).otherwise(no)
    here = F.array(F.struct(p["i"].alias("i"), p["begin"].alias("begin")))
    found = F.concat(here, follow(up, after, 1), follow(down, before, -1))
    return F.struct(p["t"].alias("t"), found.alias("found"))


def _scored(templates: tuple[Template, ...], p: Column) -> Column:
    """(t, share, keyed): the share of the template's words found, and whether all its key phrases are, in one piece."""
    keys = F.get(F.array(*[F.array(*[F.array(*map(F.lit, places)) for places in _key_places(t)]) for t in templates]), p["t"])
    size = F.get(F.array(*[F.lit(len(_split(t.text))) for t in templates]), p["t"])

    def whole(key: Column) -> Column:
        begins = F.filter(p["found"], lambda x: F.array_contains(key, x["i"]))["begin"]
        return (F.size(begins) == F.size(key)) & (F.size(F.array_distinct(begins)) == 1)

    return F.struct(p["t"].alias("t"), (F.size(p["found"]) / size).alias("share"), F.forall(keys, whole).alias("keyed"))


def _key_places(template: Template) -> list[range]:
    """Which words of a template are those of each key phrase, where it stands first."""
    words, places = _split(template.text), []
    for key in template.keys:
        own = _split(key)
        first = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        places.append(range(first, first + len(own)))
    return places


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of (doc_id, text).

    Places are counted in words from 0. labels has the base labels and those of the templates found; score is the
    largest share of a template's words found where they should be, 1 for a base phrase. A null or empty text has no
    words, empty labels, null places and score 0. Very long texts are scanned whole. Repeated rows are scanned alike,
    and count each in the IDF. An empty table gives no rows. Other columns are left out.
    """
    rows = documents(docs).select("doc_id", words_of(F.col("text")).alias("words"))
    chosen = anchors(rows, templates)
    wanted = F.array(*map(F.lit, sorted({w for own in chosen for w in own})))
    df = rows.withColumn("anchored", F.array_intersect(wanted, F.col("words")))
    first_words = F.array(*[F.lit(p.split()[0]) for p in phrases])
    none = F.array().cast("array<struct<place:bigint,label:string>>")
    df = df.withColumn("base", F.when(F.arrays_overlap(F.col("words"), first_words), _phrase_places(phrases)).otherwise(none))
    df = df.withColumn("posted", F.when(F.size("anchored") > 0, _posted(templates, chosen)))
    df = df.withColumn("lines", _first_of_each("posted"))
    df = df.withColumn("chains", F.transform("lines", lambda p: _chained(templates, p)))
    df = df.withColumn("scored", F.transform("chains", lambda p: _scored(templates, p)))
    verified = F.filter("scored", lambda p: (p["share"] >= LEAST_SHARE) & p["keyed"])
    df = df.withColumn("verified", F.coalesce(verified, F.array().cast("array<struct<t:int,share:double,keyed:boolean>>")))
    labels = F.array(*[F.lit(t.label) for t in templates])
    base = F.array_distinct(F.col("base.label"))
    places = F.col("base.place")
    best = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("verified.share")), F.lit(0.0)))
    return df.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, F.transform("verified", lambda p: F.get(labels, p["t"])))), ",").alias("labels"),
        best.alias("score"),
    )
