"""License scans through a positional rare-token index, in DataFrame operations only.

Fixed phrases are counted wherever they stand. Beyond them, licence templates
are indexed by word and position. Of the words that a file shares with a
template, those that the fewest documents have are looked up; postings that
agree on the relative position of file and template give a place, and the place
counts if enough of the template stands there, its key phrases included.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, and the phrases that are labels by themselves.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as they are published, by label, and phrases that must stand at the place.
TEMPLATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "gpl-3.0": (
        "licensed under the GNU General Public License, version 3",
        ("gnu general public license", "version 3"),
    ),
    "gpl-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        ("gnu general public license", "any later version"),
    ),
    "lgpl": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        ("apache license", "version 2 0"),
    ),
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so",
        ("permission is hereby granted free of charge",),
    ),
    "mit-release": ("Released under the MIT License", ("mit license",)),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution", "4 0"),
    ),
    "cc-by-sa": (
        "licensed under a Creative Commons Attribution-ShareAlike License",
        ("creative commons attribution sharealike",),
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        ("mozilla public license", "2 0"),
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
        ("permission to use copy modify", "hereby granted"),
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        ("unencumbered software", "public domain"),
    ),
    "all-rights-reserved": ("All rights reserved", ("all rights reserved",)),
}

#: Words of a template that are looked up in a file, rarest first.
RARE = 8
#: Looked-up words that must agree on a place (all, if the file has fewer).
AGREE = 3
#: The share of a template's words that must stand at its place, or this near to it.
MATCH, AROUND = 0.7, 3


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def file_words(text: Column) -> Column:
    """The words of a text. Only A to Z change case, so the two letters that lower to ASCII are put aside."""
    plain = F.coalesce(text, F.lit(""))
    odd = ("K", "İ")
    aside = reduce(lambda t, letter: F.replace(t, F.lit(letter), F.lit("ÿ")), odd, plain)
    plain = F.when(reduce(or_, [plain.contains(letter) for letter in odd]), aside).otherwise(plain)
    return F.array_remove(F.split(F.lower(plain), SEPARATORS), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where it is used for every element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def document_frequency(docs: DataFrame, text: str) -> Mapping[str, int]:
    """For each word of the templates, how many documents have it."""
    vocabulary = sorted({w for body, _ in TEMPLATES.values() for w in words_of(body)})
    shared = F.array_intersect(_strings(vocabulary), file_words(F.col(f"`{text}`")))
    counts = docs.select(F.explode(shared).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # At most one row per word of the templates.
    return {r.word: r.n for r in counts.collect()}


def _phrase_places(words: Column, joined: Column, phrase: str) -> dict[str, Column]:
    """How often a phrase stands in a file, and its first and last start."""
    parts = F.split(joined, f" {phrase}(?= )")
    spaces = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))
    there = joined.contains(f" {phrase} ")
    after = spaces(F.element_at(parts, -1)) - 1
    return {
        "n": F.when(there, F.size(parts) - 1).otherwise(0),
        "first": F.when(there, spaces(F.element_at(parts, 1))),
        "last": F.when(there, F.size(words) - after - len(phrase.split())),
    }


def _template_share(words: Column, body: list[str], keys: tuple[str, ...], frequency: Mapping[str, int]) -> Column:
    """The largest share of a template that stands at one place of a file; null where it is not found."""
    size = len(body)
    by_rarity = sorted(set(body), key=lambda w: (frequency.get(w, 0), w))
    distinct = _strings(by_rarity)
    postings = F.create_map(
        *[x for w in by_rarity for x in (F.lit(w), F.array(*[F.lit(i) for i, b in enumerate(body) if b == w]))]
    )

    def starts_of(rare: Column) -> Column:
        """Where the template would start, once for every agreeing word, in order."""
        hits = F.filter(
            F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains(rare, F.element_at(words, i))
        )
        places = F.transform(
            hits, lambda i: F.transform(F.element_at(postings, F.element_at(words, i)), lambda p: i - p)
        )
        return F.array_sort(F.flatten(places))

    def agreed(rare: Column, starts: Column) -> Column:
        """The starts that stand AGREE times in a row."""
        need = F.least(F.lit(min(AGREE, size)), F.size(rare))
        last = F.filter(starts, lambda s, k: F.get(starts, k + need - 1) == s)
        return F.array_distinct(last)

    def share(start: Column) -> Column:
        # Some words around, as words that a file adds or drops move the rest.
        place = F.slice(words, F.greatest(start - AROUND, F.lit(1)), F.lit(size + 2 * AROUND))
        text = F.concat(F.lit(" "), F.array_join(place, " "), F.lit(" "))
        verified = reduce(and_, [text.contains(f" {k} ") for k in keys])
        return F.when(verified, F.size(F.array_intersect(distinct, place)) / len(by_rarity)).otherwise(0.0)

    best = let(
        F.slice(F.array_intersect(distinct, words), 1, RARE),
        lambda rare: let(
            starts_of(rare), lambda starts: F.array_max(F.transform(agreed(rare, starts), share))
        ),
    )
    return let(best, lambda found: F.when(found >= MATCH, found))


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: the key, ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 where a phrase stands, else the largest share of a template
    found, else 0. A null text counts as empty; repeated rows come back as
    often as they came in; an empty table gives an empty table.
    """
    frequency = document_frequency(docs, text)
    body = F.col(f"`{text}`")
    # Only a file with all words of a phrase or of a key phrase can hold it.
    low = F.lower(body)
    needed = [*PHRASES, *[max(keys, key=len) for _, keys in TEMPLATES.values()]]
    hinted = reduce(or_, [reduce(and_, [low.contains(w) for w in phrase.split()]) for phrase in needed])
    files = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.size(file_words(body)).cast("long").alias("n_words"),
        F.when(hinted, body).alias("hinted"),
    )
    files = files.select("key", "n_words", F.when(F.col("hinted").isNotNull(), file_words(F.col("hinted"))).alias("words"))
    words = F.col("words")
    files = files.select("key", "n_words", "words", F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")).alias("joined"))
    places = {label: _phrase_places(words, F.col("joined"), phrase) for phrase, label in PHRASES.items()}
    shares = {}
    maybe = []
    for label, (body, keys) in TEMPLATES.items():
        # A place needs its key phrases, so a file without them has none.
        possible = reduce(and_, [F.col("joined").contains(f" {k} ") for k in keys])
        maybe.append(possible)
        shares[label] = F.when(possible, _template_share(words, words_of(body), keys, frequency))
    found = files.select(
        "key",
        "n_words",
        F.struct(*[F.struct(*[c.alias(n) for n, c in p.items()]).alias(label) for label, p in places.items()]).alias(
            "places"
        ),
        F.when(
            reduce(or_, maybe), F.array(*[F.struct(F.lit(label).alias("label"), s.alias("share")) for label, s in shares.items()])
        ).alias("shares"),
    )
    at = lambda label, name: F.col(f"places.`{label}`.{name}")
    labels = list(PHRASES.values())
    base = F.array_sort(F.array_compact(F.array(*[F.when(at(x, "n") > 0, F.lit(x)) for x in labels])))
    hits = F.coalesce(F.filter("shares", lambda s: s["share"].isNotNull()), F.array().cast("array<struct<label:string,share:double>>"))
    more = F.transform(hits, lambda s: s["label"])
    best = F.array_max(F.transform(hits, lambda s: s["share"]))
    total = reduce(lambda a, b: a + b, [at(x, "n") for x in labels])
    return found.select(
        F.col("key").alias(key),
        "n_words",
        total.cast("long").alias("n_base"),
        F.least(*[at(x, "first") for x in labels]).cast("long").alias("first_word"),
        F.greatest(*[at(x, "last") for x in labels]).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        F.when(total > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
