"""Licence notices in documents, by Dice coefficient over word bigrams."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import let

#: Notices by which works are put under a licence.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
THRESHOLD_PERCENT = 80


def _words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def size_bounds(size: int, percent: int = THRESHOLD_PERCENT) -> tuple[int, int]:
    """Bigram counts with which ``size`` bigrams can reach the threshold.

    With n and m bigrams at most min(n, m) are shared, so Dice is at most 2 min / (n + m).
    """
    return -(-percent * size // (200 - percent)), (200 - percent) * size // percent


def template_table(df: DataFrame, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """A row for each template and each number of bigrams it can be compared with."""
    rows = []
    for license_id, text in templates:
        words = _words(text)
        low, high = size_bounds(len(words) - 1, percent)
        rows.append((license_id, " ".join(words), max(1, low), high))
    table = df.sparkSession.createDataFrame(rows, "license_id string, words string, low int, high int")
    return table.select(
        "license_id", bigrams(F.col("words")).alias("template"), F.explode(F.sequence("low", "high")).alias("n")
    )


def bigrams(passage: Column) -> Column:
    """64-bit hashes of a passage's bigrams, with the number of the occurrence in them.

    So sets of them count repeats. Passages without a repeated bigram, nearly all, need
    no count.
    """
    def tagged(pairs: Column) -> Column:
        def occurrence(g: Column, i: Column) -> Column:
            return F.xxhash64(g, F.size(F.filter(F.slice(pairs, 1, i + 1), lambda other: other == g)))

        plain = F.transform(pairs, lambda g: F.xxhash64(g, F.lit(1)))
        return F.when(F.size(F.array_distinct(pairs)) == F.size(pairs), plain).otherwise(
            F.transform(pairs, occurrence)
        )

    def hashed(words: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(words[i], words[i + 1])
        )
        return let(pairs, tagged)

    return let(F.split(passage, " "), hashed)


def normalised(text: Column) -> Column:
    """Words of a-z and 0-9, lower-cased, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]++", " "))


def passages(text: Column) -> Column:
    """Distinct normalised passages of a text: its lines, its paragraphs and the whole.

    Every line is normalised once; paragraphs (between blank lines) and the whole are
    joined from the lines. Nested lambdas keep each array from being computed again.
    """
    def joined(words: Column) -> Column:
        return F.array_join(F.array_remove(words, ""), " ")

    def paragraphs(lines: Column, words: Column) -> Column:
        def blank(i: Column) -> Column:
            return F.length(F.trim(F.get(lines, i), F.lit(" \t\r"))) == 0

        starts = F.filter(
            F.transform(lines, lambda _, i: F.when(~blank(i) & F.coalesce(blank(i - 1), F.lit(True)), i)),
            lambda i: i.isNotNull(),
        )
        return let(starts, lambda s: F.transform(s, lambda at, k: joined(F.slice(
            words, at + 1, F.coalesce(F.get(s, k + 1), F.size(lines)) - at
        ))))

    def parts(lines: Column) -> Column:
        return let(F.transform(lines, normalised), lambda words: F.array_union(
            words, F.array_union(paragraphs(lines, words), F.array(joined(words)))
        ))

    return let(F.split(F.coalesce(text, F.lit("")), "\n"), parts)


def matches(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES, percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """(doc_id, passage, license_id, dice): passages that reach the threshold with a template.

    At least 2 n / 3 of a passage's n bigrams must be a template's (at 0.8), and k different
    words that no template has spoil k bigrams or more, so passages with too many such words
    are dropped first. The number of a passage's bigrams selects the templates whose size bounds admit it:
    passages beyond all bounds are dropped before rows are made of them, the others
    are equi-joined with a broadcast table of a few hundred rows that doesn't depend on the
    data. A licence with several templates counts
    once, with the best of them.
    """
    table = template_table(df, templates, percent)
    sizes = [len(_words(t)) - 1 for _, t in templates]
    low, high = max(1, size_bounds(min(sizes), percent)[0]), size_bounds(max(sizes), percent)[1]

    def sized(words: Column) -> Column:
        blanks = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
        return F.struct(words.alias("passage"), blanks.cast("int").alias("n"))

    known = F.array(*[F.lit(w) for w in sorted({w for _, t in templates for w in _words(t)})])

    def possible(p: Column) -> Column:
        strange = F.size(F.array_except(F.split(p["passage"], " "), known))
        return p["n"].between(low, high) & (strange * (200 - percent) <= p["n"] * (200 - 2 * percent))

    fitting = F.transform(
        F.filter(F.transform(passages(F.col(text_col)), sized), possible),
        lambda p: F.struct(p["passage"].alias("passage"), p["n"].alias("n"), bigrams(p["passage"]).alias("grams")),
    )
    shared = F.size(F.array_intersect("grams", "template"))
    dice = 2 * shared / (F.size("grams") + F.size("template"))
    return (
        df.select(F.col(id_col).alias("doc_id"), F.explode(fitting).alias("p"))
        .select("doc_id", "p.*")
        .join(F.broadcast(table), "n")
        .withColumn("dice", dice).where(100 * F.col("dice") >= percent)
        .groupBy("doc_id", "passage", "license_id").agg(F.max("dice").alias("dice"))
    )


def scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES, percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """(doc_id, license_id, dice, n_passages): licences found in each document.

    A passage counts for the licence it is most like (ties: the first by name); dice is the
    best passage's. Documents without a match, with null or empty text have no row. Repeated
    rows of an id count once. Other columns of ``df`` are not read.
    """
    best = (
        matches(df, id_col, text_col, templates, percent).groupBy("doc_id", "passage")
        .agg(F.min(F.struct((-F.col("dice")).alias("less"), "license_id")).alias("top"))
        .select("doc_id", F.col("top.license_id").alias("license_id"), (-F.col("top.less")).alias("dice"))
    )
    return best.groupBy("doc_id", "license_id").agg(
        F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_passages")
    )
