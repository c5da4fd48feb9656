"""Licence scans: TF-IDF cosine of lines and whole texts to templates, then inheritance by directory.

A text's lines, and the text as a whole, are compared with short notices, and
the text as a whole with whole licence texts. A text that resembles one of them
as a whole is a licence file; a line that does is a header. A file without either takes the licence of the nearest directory
above it that holds a licence file, found by joins on paths.

Words weigh ``tf * (ln((1 + N) / (1 + df)) + 1)`` with counts over all texts of
the table; a word that no template holds weighs as much as one that occurs
nowhere. A line is only scored if it holds a salient word: the salient words are
the fewest of the rarer ones such that no line without them can reach
``LEAST``, whatever else it holds, so nothing is lost by it. Against whole
licence texts each distinct word counts once (``tf`` is 1), with the same
weights over the words of these texts.

Defined results: NULL and empty text has no licence of its own; a NULL path has
no directory and inherits nothing; of equal scores the name that sorts first
wins; several licence files in a directory give the best of them; an empty
table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm import words
from spanledger.llm.columns import let
from spanledger.session import stored

LEAST = 0.6

# Short notices by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
]

# Whole licence texts by SPDX name, without the holder's line; read on the driver only.
TEXTS = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]


def template_words(text: str) -> Counter:
    return Counter(w for w in re.split(words.SEPARATORS, text.lower()) if w)


def _list(terms: list[str]) -> Column:
    """Words as a constant array, made of one literal so that plans stay small."""
    return F.split(F.lit(" ".join(terms)), " ")


def document_counts(texts: Column, docs: DataFrame, terms: list[str]) -> tuple[int, dict[str, int]]:
    """Number of rows, and in how many each of the terms occurs. One row a term reaches the driver."""
    held = F.array_intersect(words.words(texts), _list(terms))
    rows = docs.select(F.explode_outer(F.array_append(held, F.lit(""))).alias("term")).groupBy("term").count().collect()
    counts = {r["term"]: r["count"] for r in rows}
    return counts.get("", 0), counts


def weights(n: int, counts: dict[str, int], terms: list[str]) -> dict[str, float]:
    return {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in terms}


def salient(idf: dict[str, float], templates: list[Counter], least: float) -> list[str]:
    """Words of which a text must hold one to reach ``least`` with any template."""
    total = [sum((c * idf[t]) ** 2 for t, c in x.items()) for x in templates]
    free, left = [0.0] * len(templates), []
    for t in sorted(idf, key=lambda t: (idf[t], t)):
        grown = [f + (x.get(t, 0) * idf[t]) ** 2 for f, x in zip(free, templates, strict=True)]
        if all(g < (least * 0.999) ** 2 * s for g, s in zip(grown, total, strict=True)):
            free = grown
        else:
            left.append(t)
    return sorted(left)


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for t in sorted(values) for x in (t, values[t])])


def _dot(terms: Column, own: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x["w"] * F.coalesce(F.try_element_at(own, x["t"]), F.lit(0.0)))


def _best(text: Column, idf: dict[str, float], other: float, templates: list[tuple[str, Counter]]) -> Column:
    """The best template of a text: struct of the negative score and the name."""
    known = _map(idf)
    parts = []
    for name, x in templates:
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in x.items()))
        parts.append((name, _map({t: c * idf[t] / norm for t, c in x.items()})))

    def over(tokens: Column) -> Column:
        own = F.filter(tokens, lambda t: F.map_contains_key(known, t))
        rest = _squares(F.array_sort(F.filter(tokens, lambda t: ~F.map_contains_key(known, t)))) * F.lit(other * other)
        return let(F.struct(own.alias("own"), rest.alias("rest")), lambda x: let(_weighed(x["own"], known), lambda terms: best(terms, x["rest"])))

    def best(terms: Column, rest: Column) -> Column:
        norm = F.sqrt(F.aggregate(terms, rest, lambda a, x: a + x["w"] * x["w"]))
        scores = []
        for name, own in parts:
            cosine = F.coalesce(F.try_divide(_dot(terms, own), norm), F.lit(0.0))
            scores.append(F.struct((-cosine).alias("less"), F.lit(name).alias("name")))
        return F.array_min(F.array(*scores))

    return let(words.words(text), over)


def _like_texts(text: Column, idf: dict[str, float], other: float, texts: list[tuple[str, set[str]]], least: float) -> Column:
    """The best whole licence text of a text, as ``_best``; NULL if it holds too few of their words to reach ``least``."""
    squares = {t: w * w for t, w in idf.items()}
    known = F.map_from_arrays(_list(sorted(squares)), _list([repr(squares[t]) for t in sorted(squares)]).cast("array<double>"))
    fewest, parts = [], []
    for name, x in texts:
        whole = sum(squares[t] for t in x)
        left, k = (least * 0.999) ** 2 * whole, 0
        for w in sorted((squares[t] for t in x), reverse=True):
            if left <= 0:
                break
            left, k = left - w, k + 1
        fewest.append(k)
        parts.append((name, _list(sorted(x)), math.sqrt(whole)))

    def total(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda a, t: a + F.element_at(known, t))

    def over(held: Column) -> Column:
        def score(own: Column) -> Column:
            rest = (F.size(held["all"]) - F.size(own)).cast("double") * other**2
            norm = F.sqrt(total(own) + rest)
            scores = [F.struct((-total(F.array_intersect(own, x)) / (norm * y)).alias("less"), F.lit(name).alias("name")) for name, x, y in parts]
            return F.when(F.size(own) >= min(fewest), F.array_min(F.array(*scores)))

        return let(F.array_intersect(held["all"], _list(sorted(idf))), score)

    return let(F.struct(F.array_distinct(words.words(text)).alias("all")), over)


def _weighed(tokens: Column, idf: Column) -> Column:
    """Each distinct one of a few words with its weight, in their order."""

    def weight(t: Column) -> Column:
        count = F.size(F.filter(tokens, lambda x: x == t)).cast("double")
        return F.struct(t.alias("t"), (count * F.element_at(idf, t)).alias("w"))

    return F.transform(F.array_sort(F.array_distinct(tokens)), weight)


def _squares(ordered: Column) -> Column:
    """Sum of the squared counts of the words of a sorted array, in one pass."""
    start = F.struct(F.lit("").alias("word"), F.lit(0).cast("bigint").alias("run"), F.lit(0.0).alias("sum"))

    def step(a: Column, t: Column) -> Column:
        run = F.when(t == a["word"], a["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        return F.struct(t.alias("word"), run.alias("run"), (a["sum"] + (run * 2 - 1).cast("double")).alias("sum"))

    return F.aggregate(ordered, start, step, lambda a: a["sum"])


def scan(docs: DataFrame, path: Column, text: str = "text", least: float = LEAST, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``doc_id``, ``path``, and the text's own ``licence``, ``score`` and ``kind`` (file, header or NULL), stored."""
    counted = [(name, template_words(t)) for name, t in templates]
    terms = sorted({t for _, x in counted for t in x})
    texts = [(name, set(template_words(t))) for name, t in TEXTS]
    text_terms = sorted({t for _, x in texts for t in x})
    n, counts = document_counts(F.col(text), docs, sorted({*terms, *text_terms}))
    idf = weights(n, counts, terms)
    other = math.log(1 + n) + 1
    some = salient(idf, [x for _, x in counted], least)
    pattern = "(?i)(?<![a-z0-9\\x{80}-\\x{10FFFF}])(?:" + "|".join(map(re.escape, some)) + ")(?![a-z0-9\\x{80}-\\x{10FFFF}])"
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(pattern))
    none = F.struct(F.lit(0.0).alias("less"), F.lit(None).cast("string").alias("name"))
    scored = F.when(
        full.rlike(pattern),
        F.struct(
            _best(full, idf, other, counted).alias("whole"),
            F.coalesce(F.array_min(F.transform(lines, lambda x: _best(x, idf, other, counted))), none).alias("line"),
        ),
    )
    like = _like_texts(full, weights(n, counts, text_terms), other, texts, least)
    rows = stored(docs.select("doc_id", path.alias("path"), scored.alias("s"), like.alias("like")))
    best = F.least("s.whole", "like")
    rows = rows.select("doc_id", "path", F.struct(best.alias("whole"), F.col("s.line").alias("line")).alias("s"))
    file, line = F.coalesce(-F.col("s.whole.less") >= least, F.lit(False)), -F.col("s.line.less") >= least
    kind = F.when(file, F.lit("file")).when(line, F.lit("header"))
    licence = F.when(file, F.col("s.whole.name")).when(line, F.col("s.line.name"))
    score = F.when(file, -F.col("s.whole.less")).when(line, -F.col("s.line.less"))
    return rows.select("doc_id", "path", licence.alias("licence"), score.alias("score"), kind.alias("kind"))


def directory(path: Column) -> Column:
    """The path up to its last slash; NULL for NULL, empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The directory and all above it, as structs of depth and name."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")))


def inherit(files: DataFrame) -> DataFrame:
    """``files`` with the licence that holds, how it came (file, header, inherited, none) and from which directory.

    Distinct directories are expanded to those above them, not files. Directories with their licence
    are stored before the join, so that it can be split where one directory holds many files.
    """
    kept = files.withColumn("folder", directory(F.col("path")))
    own = kept.where((F.col("kind") == "file") & F.col("folder").isNotNull())
    best = F.min(F.struct(-F.col("score"), F.col("licence").alias("given")))
    licensed = own.groupBy(F.col("folder").alias("above")).agg(best["given"].alias("given"))
    folders = kept.where(F.col("folder").isNotNull()).select("folder").distinct()
    up = folders.select("folder", F.inline(ancestors(F.col("folder"))))
    nearest = up.join(stored(licensed), "above").groupBy("folder").agg(F.max_by(F.struct("given", "above"), F.col("depth")).alias("near"))
    near = stored(nearest.select("folder", "near.given", "near.above"))
    how = F.when(F.col("kind").isNotNull(), F.col("kind")).when(F.col("given").isNotNull(), F.lit("inherited")).otherwise(F.lit("none"))
    from_folder = F.when(F.col("kind").isNull(), F.col("above"))
    return kept.join(near, "folder", "left").select(
        "doc_id", "path", F.coalesce("licence", "given").alias("licence"), "score", how.alias("how"), from_folder.alias("licensed_by")
    )


def source_path(width: int = 64) -> Column:
    """A path for a document of a crawl: its source, then directories of so many documents, in turn in directories."""
    number = F.col("doc_id")
    parts = [F.col("source"), F.expr(f"doc_id div {width * width}"), F.expr(f"doc_id div {width}"), number]
    return reduce(lambda a, b: F.concat(a, F.lit("/"), b), [p.cast("string") for p in parts])
