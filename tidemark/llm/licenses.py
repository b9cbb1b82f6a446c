"""Licence scans by a positional rare-token index, in DataFrame functions only."""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import as_row, from_row

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose every place counts.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Label, the licence's well-known sentence, phrases without which it is not that licence.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    ("gpl", "under the gnu general public license version 3", ("gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    ("mit", "released under the mit license", ("mit license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee", "hereby granted")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms", "are permitted")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", ("waived all copyright",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)

LEAST = 0.6  # share of a sentence's rarity that has to lie in its relative places
#: A proposal (template, place of its first word) as one number: template * SPREAD + OFFSET + place. Places before a text's start are negative.
SPREAD, OFFSET = 1 << 32, 1000
NEW = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


class Template(NamedTuple):
    label: str
    words: list[str]
    keys: tuple
    least: float  # share of its weight from which it counts
    is_base: bool


def templates() -> list[Template]:
    """Base phrases, which count whole, then the licences' sentences."""
    return [Template(label, s.split(), (), 1.0, True) for s, label in BASE] + [Template(label, s.split(), keys, LEAST, False) for label, s, keys in TEMPLATES]


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), NOT_WORD, " "))


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def rarity(docs: DataFrame, text: str) -> dict[str, float]:
    """Inverse document frequency of each word of the phrases and sentences, over all documents, in one pass.

    Each document gives the words of that fixed vocabulary that it has, and the empty word, which counts documents; those counts, one row each, are all
    that comes back.
    """
    vocabulary = sorted({w for t in templates() for w in t.words})
    had = F.array_append(F.array_intersect(_literal(vocabulary), F.split(_spaced(F.col(f"`{text}`")), " ")), F.lit(""))
    counts = {r.word: r.n for r in docs.select(F.explode(had).alias("word"), F.lit(1).alias("one")).groupBy("word").agg(F.sum("one").alias("n")).collect()}
    total = counts.get("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}


class Index(NamedTuple):
    seeds: list[str]  # rarest first
    postings: dict[str, list[tuple[int, int]]]  # template and place in it, of each seed
    places: list[list[tuple[int, str, float]]]  # place, seed and its weight, of each template
    weights: list[list[float]]  # of each template's words, with sum 1
    rest: list[float]  # weight of each template's words that aren't seeds


def build_index(idf: dict[str, float]) -> Index:
    """Postings of each template's rarest words.

    A template's words are taken by rarity until those left over weigh too little to make it count, so a document in
    which it counts has one of them in its place, whatever else was edited.
    """
    known, seeds, weights = templates(), set(), []
    for t in known:
        total = sum(idf[w] for w in t.words)
        weights.append([idf[w] / total for w in t.words])
        left = 1.0
        for w in sorted(set(t.words), key=lambda w: (-idf[w], w)):
            if left < t.least - 1e-9:
                break
            seeds.add(w)
            left -= sum(v for x, v in zip(t.words, weights[-1], strict=True) if x == w)
    postings = {w: [(k, o) for k, t in enumerate(known) for o, x in enumerate(t.words) if x == w] for w in seeds}
    places = [[(o, x, own[o]) for o, x in enumerate(t.words) if x in seeds] for t, own in zip(known, weights, strict=True)]
    rest = [sum(v for x, v in zip(t.words, own, strict=True) if x not in seeds) for t, own in zip(known, weights, strict=True)]
    return Index(sorted(seeds, key=lambda w: (-idf[w], w)), postings, places, weights, rest)


def scan_licenses(docs: DataFrame, text: str = "text", idf: dict[str, float] | None = None) -> DataFrame:
    """Every input row with n_words, n_base, first_word, last_word, base_labels, labels and score appended.

    1. The index has postings (template, place) of the templates' rarest words, by their rarity in the corpus. Documents with none of those words are passed over
       by one look.
    2. In the others, each place of such a word proposes, by each of its postings, the place where that template would begin. There the postings of the
       template are intersected by their relative places: the weights of those that agree, and that of the words without postings, have to suffice.
    3. Words around a proposal that is left are compared: a base phrase's must all agree, a sentence's to LEAST of its weight, and the sentence's key
       phrases must stand in the document too.
    All of it happens within a row: no shuffle, no order among rows.

    score is the largest weight share of a sentence that counts, 1 with any phrase, else 0. Defined cases: null is
    an empty text (no words, no labels, score 0); repeated rows and ties are rows of their own; an empty table gives an empty
    result; columns that clash with appended names are replaced, any other name may occur.
    """
    index, known = build_index(rarity(docs, text) if idf is None else idf), templates()
    rows = docs.select(as_row(docs, NEW), _spaced(F.col(f"`{text}`")).alias("spaced")).withColumn("tokens", F.split("spaced", " "))
    rows = rows.withColumn("n_words", F.when(F.col("spaced") == "", 0).otherwise(F.size("tokens")).cast("long")).withColumn("rare", F.array_intersect(_literal(index.seeds), F.col("tokens")))
    tokens, t_at = F.col("tokens"), lambda table, c: F.element_at(table, c["t"] + 1)
    begin = lambda k, o: F.lit(k * SPREAD + OFFSET - o).cast("long")
    postings = F.map_from_arrays(_literal(index.seeds), F.array(*[F.array(*[begin(k, o) for k, o in index.postings[w]]) for w in index.seeds]))
    seeded = F.array(*[F.array(*[F.struct(F.lit(o).alias("o"), F.lit(w).alias("w"), F.lit(float(v)).alias("v")) for o, w, v in own]) for own in index.places])
    words = F.array(*[_literal(t.words) for t in known])
    weights = F.array(*[F.array(*[F.lit(float(v)) for v in own]) for own in index.weights])
    least, rest, base = (F.array(*[F.lit(x) for x in xs]) for xs in ([t.least - 1e-9 for t in known], [float(x) for x in index.rest], [t.is_base for t in known]))
    places = F.filter(F.transform(tokens, lambda w, i: F.when(F.array_contains("rare", w), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    proposed = F.array_distinct(F.flatten(F.transform(places, lambda x: F.transform(F.element_at(postings, x["w"]), lambda p: p + x["i"]))))
    candidate = F.transform("proposed", lambda k: F.struct(F.shiftright(k, 32).cast("int").alias("t"), (k.bitwiseAND(SPREAD - 1) - OFFSET).cast("int").alias("s")))
    agreed = lambda c: F.aggregate(t_at(seeded, c), F.lit(0.0), lambda a, x: a + F.when(F.get(tokens, c["s"] + x["o"]) == x["w"], x["v"]).otherwise(F.lit(0.0)))
    likely = F.filter(candidate, lambda c: agreed(c) + t_at(rest, c) >= t_at(least, c))

    def share(c: Column) -> Column:
        """The weight of the words that stand where the template has them, if it begins at s."""
        cut = F.greatest(-c["s"], F.lit(0))
        length = F.size(t_at(words, c))
        own = F.zip_with(F.slice(t_at(words, c), cut + 1, length), F.slice(t_at(weights, c), cut + 1, length), lambda w, v: F.struct(w.alias("w"), v.alias("v")))
        matched = F.zip_with(F.slice(tokens, c["s"] + cut + 1, length), own, lambda w, x: F.when(w == x["w"], x["v"]).otherwise(F.lit(0.0)))
        return F.aggregate(matched, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))

    whole = F.concat(F.lit(" "), F.col("spaced"), F.lit(" "))
    has_keys = F.array(*[F.array_compact(F.array(*[F.contains(whole, F.lit(f" {key} ")) for key in t.keys], F.lit(True))) for t in known])
    verified = lambda c: (c["v"] >= t_at(least, c)) & F.forall(t_at(F.col("has_keys"), c), lambda x: x)
    none = F.array().cast("array<struct<t:int,s:int,v:double>>")
    cleared = F.array().cast("array<struct<t:int,s:int>>")
    some = F.size("rare") > 0
    rows = rows.withColumn("proposed", F.when(some, proposed)).withColumn("likely", F.when(some, likely).otherwise(cleared))
    rows = rows.withColumn("has_keys", F.when(F.size("likely") > 0, has_keys))
    found = F.filter(F.transform("likely", lambda c: F.struct(c["t"].alias("t"), c["s"].alias("s"), share(c).alias("v"))), verified)
    rows = rows.withColumn("found", F.when(F.size("likely") > 0, found).otherwise(none))
    label = F.array(*[F.lit(t.label) for t in known])
    in_base = F.filter("found", lambda c: t_at(base, c))
    joined = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda c: t_at(label, c)))), ",")
    starts = F.transform("in_base", lambda c: c["s"])
    return rows.withColumn("in_base", in_base).select(
        *from_row(docs, NEW), "n_words",
        F.size("in_base").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined("in_base").alias("base_labels"), joined("found").alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("found", lambda c: c["v"])), F.lit(0.0))).alias("score"),
    )


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).drop("text")
