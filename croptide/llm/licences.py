"""Licence scan: TF-IDF cosine of header blocks to templates, then inheritance by directory."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croptide.llm.skew import join_by_weight
from croptide.llm.storage import stage

THRESHOLD = 0.75

#: The licences' usual statements, headers, titles and first sentences.
TEMPLATES = (
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by "
                 "the Free Software Foundation, either version 3 of the License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors "
                     "may be used to endorse or promote products derived from this software"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free "
                "Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the "
                 "Free Software Foundation; either version 3 of the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
)
BLOCK = 3  # consecutive lines that are compared together at most


#: What separates terms besides blanks; a dot does before a blank or at the end.
SEPARATORS = "\t\x0b\x0c!\"#$%&'()*+,-/:;<=>?@[\\]^_`{|}~"


def terms(line: Column) -> Column:
    """Lower-case words and numbers of a line, in order (``2.0`` is one term).

    Plain replacements and a split at blanks: no pattern runs over the corpus.
    """
    flat = F.translate(F.lower(line), SEPARATORS, " " * len(SEPARATORS))
    flat = F.replace(F.concat(flat, F.lit(" ")), F.lit(". "), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def template_table(spark, templates=TEMPLATES) -> DataFrame:
    """``(license, statement, term, tf)`` of the templates: a table of fixed size."""
    table = spark.createDataFrame([(name, k, line) for k, (name, line) in enumerate(templates)],
                                  "license string, statement int, line string")
    return table.select("license", "statement", F.explode(terms(F.col("line"))).alias("term")
                        ).groupBy("license", "statement", "term").agg(
        F.count(F.lit(1)).alias("tf"))


def _split(text: Column) -> Column:
    return F.split(text, "\\r\\n|[\\n\\r]")


def term_counts(files: DataFrame) -> DataFrame:
    """``(term, df)``: in how many lines of all files each term is, as a stage.

    The empty term stands for the number of lines that have any.
    """
    lines = files.select(F.explode(_split(F.col("text"))).alias("line")).select(
        F.array_distinct(terms(F.col("line"))).alias("terms")).where(F.size("terms") > 0)
    return stage(lines.select(F.explode(F.array_append("terms", F.lit(""))).alias("term"))
                 .groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")


def _blocks(files: DataFrame, telling: list[str]) -> DataFrame:
    """``(path, line_no, n_lines, terms)``: runs of up to ``BLOCK`` lines with a telling term.

    Only runs with such a line are made, so a text is copied once for each of its
    lines of that kind, however long it is.
    """
    words = F.array(*map(F.lit, telling))
    cut = files.select("path", _split(F.col("text")).alias("lines")).withColumn(
        "hits", F.filter(F.transform("lines", lambda x, i: F.when(
            F.arrays_overlap(terms(x), words), i)), lambda i: i.isNotNull()))
    runs = [(first, size) for size in range(1, BLOCK + 1) for first in range(1 - size, 1)]

    def around(hit: Column) -> Column:
        return F.array(*(F.struct((hit + first).alias("line_no"), F.lit(size).alias("n_lines"))
                         for first, size in runs))

    near = F.array_distinct(F.filter(
        F.flatten(F.transform("hits", around)),
        lambda r: (r["line_no"] >= 0) & (r["line_no"] + r["n_lines"] <= F.size("lines"))))
    made = cut.where(F.size("hits") > 0).withColumn("runs", near).select(
        "path", F.explode(F.transform("runs", lambda r: F.struct(
            r["line_no"].alias("line_no"), r["n_lines"].alias("n_lines"),
            F.array_join(F.slice("lines", r["line_no"] + 1, r["n_lines"]), " ").alias("block"))))
        .alias("r"))
    return made.select("path", "r.line_no", "r.n_lines", terms(F.col("r.block")).alias("terms"))


def _telling(vectors: dict[int, dict[str, float]], idf: dict[str, float], threshold: float
             ) -> list[str]:
    """Terms of which a block needs one to reach ``threshold`` with any template.

    Without them the rest of a template's vector is too short: a cosine is at
    most the length of the shared part over that of the template. The rarest
    terms are taken, so that few blocks have one.
    """
    out = set()
    for vector in vectors.values():
        whole = left = sum(w * w for w in vector.values())
        for term in sorted(vector, key=lambda t: (-idf[t], t)):
            if left < 0.999 * threshold * threshold * whole:
                break
            out.add(term)
            left -= vector[term] * vector[term]
    return sorted(out)


def own_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD
                 ) -> DataFrame:
    """``(path, license, score, line_no, n_lines)``: the best template of each file's blocks.

    ``files`` has ``path, text``. Every run of up to ``BLOCK`` lines of the whole
    text is compared, so a header may be wrapped. Weights are ``tf * idf`` with
    ``idf = 1 + ln((1 + N) / (1 + df))`` over all lines of all files. Files whose
    best cosine is below ``threshold`` are left out; ties (to 12 digits) go to the
    first licence by name, the first line and the shortest block.
    """
    spark = files.sparkSession
    table = template_table(spark, templates)
    counts = term_counts(files)
    wanted = F.broadcast(table.select("term").distinct().unionByName(
        spark.createDataFrame([("",)], "term string")))
    known = {r["term"]: r["df"] for r in counts.join(wanted, "term").collect()}
    total = known.get("", 0)

    def idf(df: Column) -> Column:
        return 1.0 + F.log((1.0 + F.lit(total)) / (1.0 + F.coalesce(df, F.lit(0))))

    vectors: dict[int, dict[str, float]] = {}
    names: dict[int, str] = {}
    rarity: dict[str, float] = {}
    for r in table.collect():
        names[r["statement"]] = r["license"]
        rarity[r["term"]] = 1.0 + math.log((1.0 + total) / (1.0 + known.get(r["term"], 0)))
        vectors.setdefault(r["statement"], {})[r["term"]] = r["tf"] * rarity[r["term"]]
    side = F.broadcast(spark.createDataFrame(
        [(names[k], k, t, w / math.sqrt(sum(x * x for x in v.values())))
         for k, v in vectors.items() for t, w in v.items()],
        "license string, statement int, term string, side double"))

    block = ["path", "line_no", "n_lines"]
    held = stage(_blocks(files, _telling(vectors, rarity, threshold)).select(
        *block, F.explode("terms").alias("term")).groupBy(*block, "term").agg(
        F.count(F.lit(1)).alias("tf")), "blocks")
    # A term such as "the" may be in every block: its rows are not shuffled by it.
    used = stage(held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(
        counts, "term").select("term", "n", idf(F.col("df")).alias("idf")), "weights")
    weighted = join_by_weight(held, used, ["term"], "n").select(
        *block, "term", (F.col("tf") * F.col("idf")).alias("w"))
    lengths = weighted.groupBy(*block).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    shared = weighted.join(side, "term").groupBy(*block, "license", "statement").agg(
        F.sum(F.col("w") * F.col("side")).alias("shared"))
    best = shared.join(lengths, block).withColumn(
        "score", F.col("shared") / F.col("norm")).where(F.col("score") >= threshold)
    # The largest score first, then the smallest licence, line and block.
    return best.groupBy("path").agg(F.min(F.struct(
        (-F.round("score", 12)).alias("s"), "license", "line_no", "n_lines")).alias("m")).select(
        "path", "m.license", (-F.col("m.s")).alias("score"), "m.line_no", "m.n_lines")


def directory(path: Column) -> Column:
    """The part of a path before its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _ancestors(path: Column) -> Column:
    """A directory and all directories above it, the top (empty) included."""
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "/"))
    return F.transform(F.sequence(F.lit(0), F.size(parts)),
                       lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(path, license, score, origin, directory)`` for every row of ``files``.

    ``files`` has ``path, text, is_licence_file``; further columns are carried
    along, those of the result's names replaced. A file with a licence line of
    its own keeps it (origin ``own``). Others inherit from the nearest directory
    at or above theirs that has a licence file with a licence (origin
    ``inherited``, ``directory`` says which); the rest have none. Licence files
    of one directory that differ: the most frequent licence, then the first by
    name. A null path has no directory and inherits nothing, a null text has no
    lines, a null flag is false; rows that repeat a path share their licences;
    an empty table gives an empty one.
    """
    made = {"license", "score", "origin", "directory"}
    files = files.select(*(F.col(f"`{c}`") for c in files.columns if c.lower() not in made))
    own = stage(own_licences(files.where("path IS NOT NULL").select("path", "text"), templates,
                             threshold), "own")
    marked = files.join(own.select("path", F.struct("license", "score").alias("_own")),
                        "path", "left")
    granted = (files.where("is_licence_file AND path IS NOT NULL")
               .join(own.select("path", "license"), "path")
               .groupBy(directory(F.col("path")).alias("above"), "license")
               .agg(F.count(F.lit(1)).alias("n"))
               .groupBy("above").agg(F.min(F.struct((-F.col("n")).alias("n"), "license"))
                                     .alias("m"))
               .select("above", F.col("m.license").alias("license")))
    # Each distinct directory finds its nearest licensed ancestor once.
    places = files.where("path IS NOT NULL").select(
        directory(F.col("path")).alias("place")).distinct()
    nearest = (places.select("place", F.explode(_ancestors(F.col("place"))).alias("above"))
               .join(granted, "above").groupBy("place")
               .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "license"))
                    .alias("near")))
    joined = marked.withColumn("_place", directory(F.col("path"))).join(
        nearest.withColumnRenamed("place", "_at").withColumnRenamed("near", "_near"),
        F.col("_place") == F.col("_at"), "left")
    has = F.col("_own").isNotNull()
    near = F.col("_near").isNotNull()
    return joined.select(
        *(F.col(f"`{c}`") for c in files.columns),
        F.coalesce("_own.license", "_near.license").alias("license"), "_own.score",
        F.when(has, "own").when(near, "inherited").otherwise("none").alias("origin"),
        F.when(~has & near, F.col("_near.above")).alias("directory"))
