r"""Licence scans by sparse TF-IDF cosine, in DataFrame functions only.

Every line of every file, every window of WINDOWS lines and every whole file is a possible notice. These and the
licence templates become TF-IDF vectors of their words; inverse document frequencies of the templates' words count all
files. Two exact filters run before anything is joined. Lines that hold none of a template's heaviest words cannot reach
the threshold (the rest of the template is too light), nor can windows of such lines only. A whole file, and windows of
LONG_WINDOWS lines, are looked at if the file holds as many words of a body as its heaviest words must be to reach the
threshold. What is left meets the templates through an inverted list of template words. A file's own licence is the
template with the highest cosine, at or above the threshold.

Bodies are there for MIT and BSD; full texts of the other licences are told by their titles and notices.

A file whose name says licence file, or that is_licence marks, speaks for its directory. Files without a licence of
their own inherit from the nearest ancestor directory that has one: directories, not files, are expanded to their
ancestors and joined by path, and one row per directory is joined back.

Defined cases: a null or empty text has no lines; files with a null path keep their own licence and inherit nothing;
rows that repeat a path are one file with the best of their lines; of several licence files in a directory the highest
cosine, then the smallest licence and path, speaks; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.llm.common import materialize

THRESHOLD = 0.75
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|copyright|unlicense)([.\-_].*)?$"

# Short notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 2-Clause License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Further texts of these licences: notices that usually are wrapped, titles of the full texts.
NOTICES = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BODIES = [
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, '
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_END),
]
WINDOWS, LONG_WINDOWS = (2, 3, 4, 5, 6), (8, 12, 16, 24, 32, 48)

#: Parts that the files of a directory, and the directories below one, are cut into for the joins by path.
CUTS = 16
_NO_PATH = "\0"
_APART = r"[^\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _APART, -1), lambda t: t != "")


def _template_terms(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for t in re.findall(r"[^\W_]+", text.lower()):
        out[t] = out.get(t, 0) + 1
    return out


def scan(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, is_licence: Column | None = None) -> DataFrame:
    """(path, licence, score, origin, origin_path) per file; origin is own, inherited or null.

    files: (path, text), and what is_licence reads."""
    spark = files.sparkSession
    # Templates by licence, number and kind.
    known_texts = [*(templates or TEMPLATES).items(), *([] if templates else [*NOTICES, *BODIES])]
    bodies = set() if templates else set(range(len(known_texts) - len(BODIES), len(known_texts)))
    counted = {f"{name}#{i}": _template_terms(text) for i, (name, text) in enumerate(known_texts)}
    vocabulary = sorted({t for c in counted.values() for t in c})
    named = F.coalesce(F.element_at(F.split("path", "/", -1), -1).rlike(LICENCE_NAME), F.lit(False))
    speaks = F.coalesce(is_licence, F.lit(False)) | named if is_licence is not None else named
    # A file without a path goes by its text, on which alone its licence depends; such rows are never grouped.
    by_text = F.concat(F.lit(_NO_PATH), F.sha2(F.coalesce("text", F.lit("")), 256))
    given = files.select(F.coalesce("path", by_text).alias("path"), "text", (speaks & F.col("path").isNotNull()).alias("speaks"))
    placed = ~F.col("path").startswith(_NO_PATH)

    # One row per word of the templates, whatever the corpus.
    held = F.array_intersect(_terms(F.coalesce("text", F.lit(""))), F.array(*[F.lit(t) for t in vocabulary]))
    pass_one = given.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    df = {r["term"]: r["n"] for r in pass_one.collect()}
    n = df.get("", 0)
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    unknown = math.log(1 + n) + 1
    weights, keys, needs = [], set(), []
    for i, (name, c) in enumerate(counted.items()):
        w = {t: (1 + math.log(k)) * idf[t] for t, k in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        w = {t: x / norm for t, x in w.items()}
        weights += [(t, name, x) for t, x in sorted(w.items())]
        rest, heaviest = 1.0, 0
        for t in sorted(w, key=lambda t: (-w[t], t)):
            if math.sqrt(max(0.0, rest)) < threshold - 1e-9:
                break
            if i not in bodies:
                keys.add(t)
            rest -= w[t] ** 2
        if i in bodies:  # a text with fewer of its words has a cosine under the threshold
            mass = 0.0
            for t in sorted(w, key=lambda t: (-w[t], t)):
                if mass >= threshold**2 - 1e-9:
                    break
                mass, heaviest = mass + w[t] ** 2, heaviest + 1
            needs.append((sorted(w), heaviest))
    posts = F.broadcast(spark.createDataFrame(weights, "term string, template string, weight double"))
    known = F.broadcast(spark.createDataFrame([(t, x) for t, x in idf.items()], "term string, idf double"))
    cue = r"(?i)(?<![\p{L}\p{N}])(" + "|".join(sorted(keys)) + r")(?![\p{L}\p{N}])"

    text = F.coalesce("text", F.lit(""))
    split = F.split(text, "\n", -1)
    told = given.select("path", "text", split.alias("lines"), F.filter(F.transform(split, lambda x, i: F.when(x.rlike(cue), i)), lambda i: i.isNotNull()).alias("cues"))

    # Functions with one parameter: transform() would hand a second one the index.
    def windows(starts: Column, size: int) -> Column:
        return F.transform(starts, lambda i: F.array_join(F.slice("lines", i + 1, size), " "))

    def about(size: int) -> Column:
        return F.array_distinct(F.flatten(F.transform("cues", lambda i: F.sequence(F.greatest(i - size + 1, F.lit(0)), i))))

    units = [windows(F.col("cues"), 1), *[windows(about(size), size) for size in WINDOWS]]
    noted = told.filter(F.size("cues") > 0).select("path", F.explode(F.array_distinct(F.concat(*units))).alias("text"))
    lines = noted
    if needs:
        holds = [F.size(F.array_intersect(F.col("held"), F.array(*[F.lit(t) for t in words]))) >= least for words, least in needs]
        full = given.select("path", "text", held.alias("held")).filter(functools.reduce(Column.__or__, holds)).select("path", "text", split.alias("lines"))
        steps = [F.sequence(F.lit(0), F.size("lines") - 1, F.lit(size // 8)) for size in LONG_WINDOWS]
        parts = [F.array(F.array_join("lines", " ")), *[windows(at, size) for at, size in zip(steps, LONG_WINDOWS, strict=True)]]
        lines = noted.union(full.select("path", F.explode(F.array_distinct(F.concat(*parts))).alias("text")))
    # Rows that repeat a path must not mix their lines: a line is told by its own text.
    words = lines.select("path", F.xxhash64("text").alias("line"), "text").distinct().select("path", "line", F.explode(_terms(F.col("text"))).alias("term"))
    tf = words.groupBy("path", "line", "term").agg(F.count(F.lit(1)).alias("k")).join(known, "term", "left")
    tf = tf.select("path", "line", "term", ((1 + F.log("k")) * F.coalesce("idf", F.lit(unknown))).alias("w"))
    norms = tf.groupBy("path", "line").agg(F.sqrt(F.sum(F.round(F.col("w") * F.col("w"), 12))).alias("norm"))
    dots = tf.join(posts, "term").groupBy("path", "line", "template").agg(F.sum(F.round(F.col("w") * F.col("weight"), 12)).alias("dot"))
    near = dots.join(norms, (dots["path"].eqNullSafe(norms["path"])) & (dots["line"] == norms["line"])).select(dots["path"], F.substring_index("template", "#", 1).alias("licence"), F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
    best = near.filter(F.col("score") >= threshold).groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("worse"), "licence")).alias("b"))
    own = materialize(best.select(F.col("path").alias("own_path"), F.col("b.licence").alias("own"), (-F.col("b.worse")).alias("own_score")), "licence-own")

    every = given.filter(placed).groupBy("path").agg(F.max("speaks").alias("speaks"))
    every = materialize(every.union(given.filter(~placed).select("path", "speaks")), "licence-files")
    marked = every.join(own, every["path"].eqNullSafe(own["own_path"]), "left").withColumn("dir", F.when(placed, F.regexp_replace("path", "/?[^/]*$", "")))
    voices = marked.filter("speaks AND own IS NOT NULL").groupBy("dir").agg(F.min(F.struct((-F.col("own_score")).alias("worse"), "own", "path")).alias("v"))
    voices = voices.select(F.col("dir").alias("at"), F.col("v.own").alias("dir_licence"), (-F.col("v.worse")).alias("dir_score"), F.col("v.path").alias("dir_path"))
    parts = F.split("dir", "/", -1)
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    dirs = marked.filter("dir IS NOT NULL").select("dir").distinct().select("dir", F.explode(F.array_distinct(up)).alias("at"))
    # All directories have the topmost ones as ancestors, and one may hold most files: such keys are cut by a hash, and the few rows on the other side copied.
    cut = F.pmod(F.xxhash64("dir"), F.lit(CUTS)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(CUTS - 1)))
    nearest = dirs.withColumn("cut", cut).join(voices.withColumn("cut", copies), ["at", "cut"]).groupBy("dir").agg(F.max(F.struct(F.length("at").alias("depth"), "dir_licence", "dir_score", "dir_path")).alias("v"))
    nearest = nearest.select(F.col("dir").alias("in_dir"), "v.dir_licence", "v.dir_score", "v.dir_path").withColumn("in_cut", copies)
    told = marked.withColumn("cut", F.pmod(F.xxhash64("path"), F.lit(CUTS)).cast("int"))
    told = told.join(nearest, (told["dir"] == nearest["in_dir"]) & (told["cut"] == nearest["in_cut"]), "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("dir_licence").isNotNull(), "inherited")
    return told.select(
        F.when(placed, F.col("path")).alias("path"),
        F.coalesce("own", "dir_licence").alias("licence"),
        F.coalesce("own_score", "dir_score").alias("score"),
        origin.alias("origin"),
        F.when((origin == "own") & placed, F.col("path")).when(origin == "inherited", F.col("dir_path")).alias("origin_path"),
    )
