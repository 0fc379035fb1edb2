"""Licence cosines against a plain computation, and inheritance."""

import math
import re
from collections import Counter

from croptide.llm import licences

FILES = "path string, text string, is_licence_file boolean"


def terms(line):
    """Runs of other characters than blanks and separators, less one dot at the end."""
    parts = re.split("[ " + re.escape(licences.SEPARATORS) + "]", line.lower())
    return [p for p in (re.sub(r"\.$", "", p) for p in parts) if p]


def best(texts, threshold=licences.THRESHOLD):
    """Every run of one to three lines against every statement, by the formula."""
    vectors = [(name, Counter(terms(line))) for name, line in licences.TEMPLATES]
    split = {k: re.split(r"\r\n|[\n\r]", t or "") for k, t in texts.items()}
    lines = [set(terms(x)) for parts in split.values() for x in parts if terms(x)]
    df = Counter(t for ts in lines for t in ts)

    def weights(counts):
        return {t: c * (1 + math.log((1 + len(lines)) / (1 + df[t]))) for t, c in counts.items()}

    out = {}
    for k, parts in split.items():
        for size in (1, 2, 3):
            for n in range(len(parts) - size + 1):
                v = weights(Counter(terms(" ".join(parts[n:n + size]))))
                for name, counts in vectors:
                    w = weights(counts)
                    score = v and (sum(v.get(t, 0) * x for t, x in w.items())
                                   / math.sqrt(sum(x * x for x in v.values()))
                                   / math.sqrt(sum(x * x for x in w.values())))
                    if score and score >= threshold:
                        out[k] = min(out.get(k, (0, "", 0, 0)), (-round(score, 9), name, n, size))
    return out


TEXTS = {
    "a/x.py": "# Released under the MIT License.\ncode is here",
    "a/y.py": "this is some work\nwork is done",
    "a/b/z.py": "Licensed under the Apache License, Version 2.0\r\nThe end",
    "a/b/w.py": "of the\n", "top.py": "Licensed under CC BY-NC 4.0.", "n.py": None, "e.py": "",
    "g.py": "this work is licensed under the gnu general public license, version 3. " * 2,
    "words.py": "Released under the MIT License. and in\n" + "and in the of\n" * 40,
    "spdx.c": "// SPDX-License-Identifier: BSD-3-Clause\nint x;", "LICENSE": "The MIT License (MIT)\n",
    "gpl.py": "#\n# you can redistribute it under the terms of the GNU\n"
              "# General Public License as published by\n#\nx = 1",
    "mpl.js": "/* This Source Code Form is subject to the terms of the\n"
              " * Mozilla Public License, v. 2.0. */\nf()",
    "body": "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
            "of this software and associated documentation files (the \"Software\"), to deal\n"
            "in the Software without restriction, including without limitation the rights\n",
}


def test_cosines(spark):
    frame = spark.createDataFrame([(k, t, False) for k, t in TEXTS.items()], FILES)
    got = {r["path"]: (-round(r["score"], 9), r["license"], r["line_no"], r["n_lines"])
           for r in licences.own_licences(frame).collect()}
    want = best(TEXTS)
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}
    assert all(abs(got[k][0] - want[k][0]) < 1e-8 for k in want)
    assert {k: v[1] for k, v in want.items()} == {
        "a/x.py": "MIT", "a/b/z.py": "Apache-2.0", "top.py": "CC-BY-NC-4.0", "g.py": "GPL-3.0",
        "words.py": "MIT", "spdx.c": "BSD-3-Clause", "LICENSE": "MIT", "gpl.py": "GPL-3.0",
        "mpl.js": "MPL-2.0", "body": "MIT"}


def test_documents_inherit(spark):
    from croptide.llm.queries import op7_licences

    origins = {r["origin"]: r["count"] for r in op7_licences(
        spark, "/root/testdata/sf0.001").groupBy("origin").count().collect()}
    assert origins["inherited"] > 0 and origins["own"] > 0


def test_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [("LICENSE", mit, True), ("src/LICENSE", apache, True), ("src/a/b/f.py", "x", False),
            ("src/own.py", mit, False), ("doc/g.txt", None, None), ("h.txt", "", False),
            ("srcs/i.py", "x", False), ("src/deep/LICENSE", "nothing", True),
            ("src/deep/j.py", "x", False), (None, mit, True), ("src/own.py", mit, False)]
    frame = spark.createDataFrame([(*r, "c", 1.0) for r in rows],
                                  FILES + ", license string, score double")
    got = sorted((r["path"] or "", r["license"], r["origin"], r["directory"])
                 for r in licences.scan(frame).collect())
    assert got == sorted([
        ("LICENSE", "MIT", "own", None), ("src/LICENSE", "Apache-2.0", "own", None),
        ("src/a/b/f.py", "Apache-2.0", "inherited", "src"), ("src/own.py", "MIT", "own", None),
        ("src/own.py", "MIT", "own", None), ("doc/g.txt", "MIT", "inherited", ""),
        ("h.txt", "MIT", "inherited", ""), ("srcs/i.py", "MIT", "inherited", ""),
        ("src/deep/LICENSE", "Apache-2.0", "inherited", "src"),
        ("src/deep/j.py", "Apache-2.0", "inherited", "src"), ("", None, "none", None)])


def test_ties_and_empty(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [("d/LICENSE", apache, True), ("d/COPYING", mit, True), ("d/f", "x", False)]
    out = {r["path"]: r["license"] for r in
           licences.scan(spark.createDataFrame(rows, FILES)).collect()}
    assert out["d/f"] == "Apache-2.0"
    assert licences.scan(spark.createDataFrame([], FILES)).count() == 0
