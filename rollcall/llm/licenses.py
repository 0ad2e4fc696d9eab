"""Licences of files: TF-IDF cosine to templates, then the nearest ancestor directory's licence.

A file's units are its lines that could name a licence, those lines together, and, for a licence
file, its whole text. Equal units are scored once. Term weights come from counts over all texts.
A line can only reach the least cosine if it has an anchor: the anchors of a template are its
heaviest terms, as many as it takes until the other terms alone can't reach it. Files without a
licence of their own get that of the nearest directory above them that has a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import bound, landed

LEAST = 0.6
#: Names of files that license their directory.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.\-_][^/]*)?$"

# How files name their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MIT short": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    "BSD-3-Clause short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0 short": "Licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights under Creative Commons CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _terms(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


VOCABULARY = sorted({t for text in TEMPLATES.values() for t in _terms(text)})


def term_array(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _vocabulary() -> Column:
    return F.array(*map(F.lit, VOCABULARY))


def term_weights(files: DataFrame) -> dict[str, float]:
    """Smoothed inverse document frequency of each template term over all texts."""
    own = F.array_intersect(term_array(F.coalesce(F.col("text"), F.lit(""))), _vocabulary())
    found = files.select(F.explode(own).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["term"]: r["n"] for r in found.collect()}  # at most the vocabulary
    n = files.count()
    return {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in VOCABULARY}


def template_vectors(weights: dict[str, float]) -> dict[str, dict[str, float]]:
    """Unit vectors of the templates."""
    vectors = {}
    for name, text in TEMPLATES.items():
        own = {t: n * weights[t] for t, n in Counter(_terms(text)).items()}
        norm = math.sqrt(sum(w * w for w in own.values()))
        vectors[name] = {t: w / norm for t, w in own.items()}
    return vectors


def anchors(vectors: dict[str, dict[str, float]], least: float = LEAST) -> set[str]:
    """Terms of which any text with a cosine of ``least`` to a template has at least one.

    Without them the cosine is at most the norm of the template's other terms.
    """
    found = set()
    for vector in vectors.values():
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < least * least * 0.999:
                break
            found.add(term)
            rest -= weight * weight
    return found


def _units(text: Column, whole: Column, marks: set[str]) -> Column:
    """The units of a text, without repeats."""
    pattern = r"(?i)(?<![A-Za-z0-9])(" + "|".join(sorted(marks)) + r")(?![A-Za-z0-9])"
    some = F.filter(F.split(text, "\n"), lambda line: line.rlike(pattern))
    lines = bound(
        some,
        lambda x: F.concat(x, F.when(F.size(x) > 1, F.array(F.concat_ws(" ", x))).otherwise(F.array().cast("array<string>"))),
    )
    return F.array_distinct(F.concat(lines, F.when(whole & text.rlike(pattern), F.array(text)).otherwise(F.array().cast("array<string>"))))


def _cosines(units: DataFrame, weights: dict[str, float], vectors: dict[str, dict[str, float]]) -> DataFrame:
    """(unit, score, licence) of the best template of each unit that reaches LEAST."""
    spark = units.sparkSession
    # Terms that no template has weigh as the average one.
    other = sum(weights.values()) / len(weights)
    terms = (
        units.select(F.xxhash64("unit").alias("unit"), F.explode(term_array(F.col("unit"))).alias("term"))
        .groupBy("unit", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    idf = F.broadcast(_rows(spark, [(t, w) for t, w in weights.items()], "term string, idf double"))
    rows = [(t, n, w) for n, v in vectors.items() for t, w in v.items()]
    template = F.broadcast(_rows(spark, rows, "term string, template string, weight double"))
    weighted = terms.join(idf, "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(other)))
    norms = weighted.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighted.join(template, "term").groupBy("unit", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, "unit").select("unit", "template", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    best = F.max(F.struct("score", F.regexp_replace("template", " short$", "").alias("licence"))).alias("best")
    return scored.filter(F.col("score") >= LEAST).groupBy("unit").agg(best).select("unit", "best.score", "best.licence")


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table as literals, so that no Python runs on executors."""
    names = [f.split()[0] for f in schema.split(", ")]
    one = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in rows))
    return spark.range(1).select(F.explode(one).alias("r")).select("r.*")


def own_licences(files: DataFrame) -> DataFrame:
    """(row, path, licence, score): the best unit of each file; nulls if no template reaches LEAST.

    ``files`` has row, path and text. Rows are told apart by a hash of all three, not by ``row``
    alone: files that share a row, or have none, keep their own licence each, equal ones the same.
    """
    weights = term_weights(files)
    vectors = template_vectors(weights)
    whole = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    text = F.coalesce(F.col("text"), F.lit(""))
    # A null takes no part in the hash, so what is null is hashed as well.
    nulls = [F.col(c).isNull() for c in ("row", "path", "text")]
    key = F.xxhash64("row", "path", "text", *nulls).alias("key")
    units = landed(files.select(key, F.explode(_units(text, whole, anchors(vectors))).alias("unit")), "units")
    scores = _cosines(units.select("unit").distinct(), weights, vectors)
    keyed = units.select("key", F.xxhash64("unit").alias("unit"))
    best = F.max(F.struct("score", "licence")).alias("best")
    found = keyed.join(scores, "unit").groupBy("key").agg(best).select("key", "best.score", "best.licence")
    return files.select("row", "path", key).join(found, "key", "left").select("row", "path", "licence", "score")


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(owned: DataFrame) -> DataFrame:
    """``owned`` with how (own, inherited or null) and from_directory; a licence is inherited from
    the nearest directory above, or the file's own, with a licence file. Files without a path
    inherit nothing. Of several licence files in a directory the best score counts, then the last name.
    """
    licence_files = owned.filter(F.col("licence").isNotNull() & F.col("path").rlike(LICENCE_FILE))
    best = F.max(F.struct("score", "licence")).alias("best")
    given = landed(licence_files.groupBy(_directory(F.col("path")).alias("above")).agg(best).select("above", "best.licence"), "directories")
    # Directories, not files, climb: each once, however many files it has.
    needy = owned.filter(F.col("licence").isNull() & F.col("path").isNotNull()).select(_directory(F.col("path")).alias("directory")).distinct()
    steps = F.split("directory", "/")
    up = bound(
        steps, lambda s: F.concat(F.array(F.lit("")), F.transform(s, lambda _, i: F.concat_ws("/", F.slice(s, F.lit(1), i + 1))))
    )
    climbing = needy.select("directory", F.posexplode(F.array_distinct(up)).alias("depth", "above"))
    nearest = climbing.join(given, "above").groupBy("directory").agg(F.max(F.struct("depth", "above", "licence")).alias("n"))
    near = nearest.select("directory", F.col("n.above").alias("from_directory"), F.col("n.licence").alias("near_licence"))
    placed = owned.withColumn("directory", _directory(F.col("path"))).join(near, "directory", "left")
    own = F.col("licence").isNotNull()
    how = F.when(own, "own").when(F.col("near_licence").isNotNull(), "inherited")
    return placed.select(
        "row",
        "path",
        F.coalesce("licence", "near_licence").alias("licence"),
        "score",
        how.alias("how"),
        F.when(~own, F.col("from_directory")).alias("from_directory"),
    )


def file_licences(files: DataFrame) -> DataFrame:
    """row, path, licence, score, how and from_directory of every file (row, path, text).

    Rows may repeat or be null; each file has its own result. Null and empty texts have no licence of their own. Other columns are
    left out; an empty table gives no rows.
    """
    return inherited(own_licences(files.select("row", "path", "text")))
