"""License scan: positional rare-token index, in DataFrame functions only.

1. Text becomes words (letters and digits, or anything beyond ASCII), joined
   by single spaces.
2. Inverse document frequencies of all template words are counted over the
   whole corpus.  The index holds each template's ``INDEX_WORDS`` words of
   highest IDF, if at least ``RARE`` of the highest, with their positions.
3. Each document looks up all index words it has (the templates bound their
   number): their places are joined with the postings, and word place minus template position
   names the alignment.  The IDF that one alignment gathers, as a share of all
   the template's indexed IDF, is its score; ``MIN_SCORE`` is needed.
4. A template counts only if the document holds its mandatory phrase.

Base labels come from three phrases, counted with their places.  No step uses
Python workers.  What is joined back to the documents is narrow: texts are
not shuffled.  The number of postings is bounded by the templates.

Cases: a null or empty text has no words, no labels and score 0.  Rows are
told apart by doc_id and a hash of the text, so repeated rows each keep one
row; null ids too.  Other columns are not read.  Letters beyond ASCII are
lower-cased as well, which no phrase or template holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and labels (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, mandatory phrase, template (fixed values: wording of public licences).
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "general public license", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation"),
    ("lgpl", "lesser general public license", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met"),
    ("isc", "with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
)
RARE = 0.5
INDEX_WORDS = 8
MIN_SCORE = 0.6
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal(text: Column) -> Column:
    """The words of a text joined by single spaces ('' for none)."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _BREAKS, " "))


def _spaces(col: Column) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), normal(F.col("text")).alias("norm"))


def _words(col: str = "norm") -> Column:
    return F.split(col, " ")


def postings(docs: DataFrame) -> list[tuple[str, int, int, float]]:
    """(word, template number, position, idf) of the index, from corpus counts.

    One row per template word is collected: as many as the templates have.
    """
    vocabulary = sorted({w for *_, t in TEMPLATES for w in t.split()})
    words = _keyed(docs).select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), _words())).alias("word"))
    counts = words.groupBy("word").count().collect()
    df, n = {r["word"]: r["count"] for r in counts}, docs.count()
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 0.5)) for w in vocabulary}
    out = []
    for t, (_, _, text) in enumerate(TEMPLATES):
        rare = sorted(((-idf[w], i, w) for i, w in enumerate(text.split())))[:INDEX_WORDS]
        out += [(w, t, i, -x) for x, i, w in rare if x <= RARE * rare[0][0]]
    return out


def _aligned(docs: DataFrame, index: list[tuple[str, int, int, float]]) -> DataFrame:
    """(doc_id, text_hash, template, score): the best alignment of each template."""
    spark = docs.sparkSession
    indexed = sorted({w for w, *_ in index})
    rows = ", ".join(f"('{w}', {t}, {i}, {x!r}D)" for w, t, i, x in index)
    table = spark.sql(f"SELECT * FROM VALUES {rows} AS t(word, template, at, idf)")
    chosen = _keyed(docs).withColumn("own", F.array_intersect(F.array(*map(F.lit, indexed)), _words()))
    places = chosen.where(F.size("own") > 0).select("doc_id", "text_hash", "own", F.posexplode(_words()).alias("place", "word"))
    places = places.where("array_contains(own, word)").select("doc_id", "text_hash", "place", "word")
    own = ("doc_id", "text_hash", "template")
    hits = places.join(F.broadcast(table), "word").select(*own, (F.col("place") - F.col("at")).alias("start"), "at", "idf")
    totals = {t: sum(x for _, u, _, x in index if u == t) for t in {u for _, u, _, _ in index}}
    total = F.element_at(F.create_map(*(F.lit(y) for t, x in sorted(totals.items()) for y in (t, x))), F.col("template"))
    lines = hits.groupBy(*own, "start", "at").agg(F.max("idf").alias("idf")).groupBy(*own, "start").agg((F.sum("idf") / F.first(total)).alias("score"))
    return lines.groupBy(*own).agg(F.max("score").alias("score")).where(F.col("score") >= MIN_SCORE)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    and ``matches``: array of (label, template, score) of verified templates."""
    index = postings(docs)
    pad = F.concat(F.lit(" "), F.col("norm"), F.lit(" "))
    has = F.col("norm").contains("license")
    keyed = _keyed(docs).withColumn("n_words", F.when(F.col("norm") == "", 0).otherwise(_spaces(F.col("norm")) + 1).cast("long"))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES:
        at = F.instr(pad, F.lit(f" {phrase} "))
        found = has & (at > 0)
        counts.append(F.when(has, F.regexp_count(pad, F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(found, _spaces(F.substring(pad, F.lit(1), at)) - 1))
        lasts.append(F.when(found, F.col("n_words") - _spaces(F.substring_index(pad, f" {phrase} ", -1)) - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    present = F.array_compact(F.array(*(F.when(pad.contains(f" {phrase} "), F.lit(t)) for t, (_, phrase, _) in enumerate(TEMPLATES))))
    base = keyed.select("doc_id", "text_hash", "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"),
                        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
                        F.array_compact(F.array(*labels)).alias("base"), present.alias("present"))
    found = _aligned(docs, index).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("template", "score")).alias("aligned"))
    right = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "aligned")
    joined = base.join(right, base["doc_id"].eqNullSafe(right["_id"]) & (base["text_hash"] == right["_hash"]), "left")
    names = F.array(*(F.lit(label) for label, _, _ in TEMPLATES))
    verified = F.transform(F.filter(F.coalesce("aligned", F.array().cast("array<struct<template:int,score:double>>")),
                                    lambda a: F.array_contains("present", a["template"])),
                           lambda a: F.struct(F.get(names, a["template"]).alias("label"), a["template"].alias("template"), a["score"].alias("score")))
    out = joined.withColumn("matches", F.array_sort(verified))
    text = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", text(F.col("base")).alias("base_labels"),
                      text(F.concat("base", F.col("matches.label"))).alias("labels"),
                      F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.least(F.lit(1.0), F.coalesce(F.array_max("matches.score"), F.lit(0.0)))).alias("score"),
                      "matches")
