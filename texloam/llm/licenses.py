"""Licences: phrases in place, and an exact set-similarity join with templates.

A template is a set of words, and a text block a window of consecutive words about
twice as long as the template, whatever the lines: windows overlap by half, so that
a notice lies whole in one of them however it is wrapped, and words far apart are in
none.  A block meets a template if it has at least ``CONTAINED`` of its words.
Words are ordered by how many documents of the corpus have them, rarest first; a
block that meets a template must share one of the template's first words (its
prefix), have enough words, and have enough of them left after the first one
shared.  So blocks are joined with templates by prefix word, and only pairs that
pass the length and position filters are compared in full.

Templates are fixed values, their words a few hundred, so their side of the join
and the word counts have a fixed bound.  Texts are cut into words once; after that
a text is the places of its template words, and a block the ranks of its own.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texloam.functions.core import bind
from texloam.llm.common import ascii_lower, durable, table, whole

#: The words of a text, and the phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "mit": ("mit", "license"),
    "apache": ("apache", "license"),
    "gpl": ("general", "public", "license"),
}
CONTAINED = 0.8
#: Templates by label.
TEMPLATES = {
    "mit-notice": "released under the MIT License",
    "apache-notice": "licensed under the Apache License, Version 2.0",
    "gpl-notice": "this work is licensed under the GNU General Public License, version 3",
    "creative-commons-notice": "licensed under CC BY 4.0",
    "bsd-notice": "licensed under the BSD 3-Clause License",
    "mpl-notice": "this source code is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain-notice": "this is free and unencumbered software released into the public domain",
    "rights-reserved": "all rights reserved",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions"
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "apache-text": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version"
    ),
}
_PLACES = "array<struct<start:bigint,label:string>>"
#: Least distance of windows; it doubles up to a template's length.
LEAST_STEP = 4


def words_of(text: Column) -> Column:
    """Words of an ASCII-lower-cased text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def template_words() -> dict[str, list[str]]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {label: re.findall(WORD, text.translate(lower)) for label, text in TEMPLATES.items()}


def step_of(words: int) -> int:
    """Distance of the windows in which a template of so many words is looked for; they are twice as long."""
    step = LEAST_STEP
    while step < words:
        step *= 2
    return step


def _measured(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """id, whole (hash of the text), n_words, places, found: array<struct<at, word>> of words of the vocabulary, by number.

    Rows that repeat id and text are one key.
    """
    text = whole(text_col)
    number = F.create_map(*(F.lit(x) for i, w in enumerate(vocabulary) for x in (w, i)))

    def measure(words: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(vocabulary))
        found = F.transform(
            places, lambda i: F.struct(i.alias("at"), F.element_at(number, F.get(words, i)).alias("word"))
        )
        none = F.array().cast("array<struct<at:int,word:int>>")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            # All phrases have this word.
            F.when(F.array_contains(words, "license"), phrase_starts(words))
            .otherwise(F.array().cast(_PLACES))
            .alias("places"),
            F.when(F.size(words) > 0, found).otherwise(none).alias("found"),
        )

    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("whole"), bind(words_of(ascii_lower(text)), measure).alias("m")
    )
    return rows.select("id", "whole", "m.*")


def _order(rows: DataFrame, vocabulary: list[str]) -> list[int]:
    """Rank of every word, rarest in the corpus first, ties by the word."""
    words = rows.select(F.explode(F.array_distinct(F.col("found")["word"])).alias("word"))
    counts = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}
    ordered = sorted(range(len(vocabulary)), key=lambda i: (counts.get(i, 0), vocabulary[i]))
    rank = [0] * len(vocabulary)
    for place, i in enumerate(ordered):
        rank[i] = place
    return rank


def _matches(rows: DataFrame, vocabulary: list[str], contained: float) -> DataFrame:
    """(id, whole, label, containment) of each template that a block of the row's text meets, best block."""
    rank = _order(rows, vocabulary)
    prefixes, openings, steps = [], set(), {}
    for label, words in template_words().items():
        ranks = sorted({rank[vocabulary.index(w)] for w in words})
        need, step = math.ceil(contained * len(ranks) - 1e-9), step_of(len(words))
        for r in ranks:
            steps.setdefault(r, set()).add(step)
        for place in range(len(ranks) - need + 1):
            openings.add(ranks[place])
            prefixes.append((step, ranks[place], label, ranks, need, len(ranks) - place - 1))
    spark = rows.sparkSession
    index = spark.createDataFrame(
        prefixes, "step int, rank int, label string, template array<int>, need int, left int"
    )
    rank_of = F.array(*map(F.lit, rank))
    steps_of = F.array(*(F.array(*map(F.lit, sorted(steps[r]))) for r in range(len(rank))))
    words = rows.select(
        "id",
        "whole",
        F.transform("found", lambda f: F.struct(f["at"].alias("at"), F.get(rank_of, f["word"]).alias("rank"))).alias("f"),
    )
    # A text without any prefix word has no such block.
    words = words.filter(F.exists("f", lambda f: f["rank"].isin(sorted(openings))))
    words = words.select("id", "whole", F.explode("f").alias("f")).select("id", "whole", "f.*")
    words = words.select("id", "whole", "at", "rank", F.explode(F.get(steps_of, F.col("rank"))).alias("step"))
    window = F.expr("explode(array(at div step - 1, at div step))").alias("window")
    blocks = (
        words.select("id", "whole", "rank", "step", window)
        .groupBy("id", "whole", "step", "window")
        .agg(F.array_sort(F.collect_set("rank")).alias("ranks"))
    )
    opened = blocks.select("id", "whole", "step", "ranks", F.posexplode("ranks").alias("place", "rank"))
    after = F.size("ranks") - F.col("place") - 1
    met = opened.join(F.broadcast(index), ["step", "rank"]).filter(
        (F.size("ranks") >= F.col("need")) & (1 + F.least(F.col("left"), after) >= F.col("need"))
    )
    shared = F.size(F.array_intersect("ranks", "template"))
    met = met.withColumn("shared", shared).filter(F.col("shared") >= F.col("need"))
    return met.groupBy("id", "whole", "label").agg(
        F.max(F.col("shared") / F.size("template")).alias("containment")
    )


def phrase_starts(words: Column) -> Column:
    """array<struct<start, label>> of the places where a phrase's words stand one after the other."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin([p[0] for p in PHRASES.values()])
    )

    def label(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, phrase in PHRASES.items():
            here = F.lit(True)
            for k, word in enumerate(phrase):
                here = here & (F.coalesce(F.get(words, i + k), F.lit("")) == word)
            found = F.when(here, F.lit(name)).otherwise(found)
        return F.struct(i.cast("long").alias("start"), found.alias("label"))

    none = F.array().cast(_PLACES)
    places = F.filter(F.transform(starts, label), lambda p: p["label"].isNotNull())
    return F.when(F.size(words) > 0, places).otherwise(none)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", contained: float = CONTAINED
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, places, base_labels, labels, score.

    ``places`` are the phrases in order of their first word; ``base_labels`` and
    ``labels`` are distinct and sorted, the second with the templates met.
    ``score`` is the best containment, 1 with a phrase, 0 without labels.  Null
    counts as the empty text, which has no words.  Repeated rows and null ids
    each give their row; an empty table gives none.
    """
    vocabulary = sorted(set().union(*template_words().values()))
    measured = durable(_measured(docs, id_col, text_col, vocabulary))
    rows = measured.select("id", "whole", "n_words", "places").alias("d")
    met = _matches(measured, vocabulary, contained).groupBy("id", "whole").agg(
        F.collect_list("label").alias("met"), F.max("containment").alias("best")
    )
    same = F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.whole") == F.col("m.whole"))
    joined = rows.join(met.alias("m"), same, "left")
    base = F.array_sort(F.array_distinct(F.col("places")["label"]))
    found = F.coalesce("met", F.array().cast("array<string>"))
    return joined.select(
        F.col("d.id").alias(id_col),
        "n_words",
        "places",
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, found)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def query(spark, sf):
    """Licences of every document."""
    found = scan_licenses(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places")["start"]).alias("first_word"),
        F.array_max(F.col("places")["start"]).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
