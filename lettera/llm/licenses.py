"""License scans: sparse TF-IDF cosine to templates, then inheritance down directory paths.

Passages that name a licence are compared with short standard notices, and whole texts with the full
texts of licences. A file takes the licence of its best passage or of its whole text, whichever is
closer. A file that is a licence text, or mostly such a passage, is a licence file of its directory, and files without
a licence of their own take that of the nearest directory above them that has one.
"""
from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, aside, restored, stored

#: Standard short notices by licence identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal Public Domain Dedication."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Full texts, one file for each licence identifier.
TEXTS = Path(__file__).with_name("license_texts")
#: Words that mark a passage as one to compare.
ANCHOR = (r"(?i)(licen[cs]e|spdx-|public domain|creative commons|free software|permission (is hereby|to use)|"
          r"redistribution and use|\bcc[ -](by|0)|copyright)")
#: Possessive: nothing is ever given back, and Java follows the group in a loop instead of by recursion.
TOKEN = r"[a-z0-9]++(?:[.-][a-z0-9]++)*+"


def full_texts() -> tuple[tuple[str, str], ...]:
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt")))


def _template_terms(templates: tuple[tuple[str, str], ...]) -> list[tuple[int, str, str, int]]:
    return [(n, name, t, found.count(t)) for n, (name, text) in enumerate(templates)
            for found in [re.findall(TOKEN, text.lower())] for t in sorted(set(found))]


def passages(files: DataFrame, text: str = "text") -> DataFrame:
    """(key, place, passage): anchored lines, and anchored blocks of several lines between blank lines."""
    blank = r"\n[\x20\t\r]*\n"
    blocks = F.filter(F.split(F.col(text), blank), lambda b: b.contains("\n"))
    both = F.filter(F.concat(F.split(F.col(text), "\n"), blocks), lambda x: x.rlike(ANCHOR))
    kept = F.when(F.col(text).rlike(ANCHOR), both)
    return files.select("key", F.posexplode(kept).alias("place", "passage"))


def _weight(tf: Column, df: Column, n: Column) -> Column:
    return (1 + F.log(tf)) * (1 + F.log((1 + n) / (1 + df)))


def _scored(found: DataFrame, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """(key, place, license, score): the cosine of each of the passages `found` to each template it shares words with.

    Document frequencies count all of `found`, for every word of theirs, so scores don't fall as a table grows.
    """
    spark = found.sparkSession
    n = F.lit(found.count())
    terms = found.select("key", "place", F.explode(F.regexp_extract_all(F.lower("passage"), F.lit(TOKEN), F.lit(0))).alias("term"))
    terms = stored(terms.groupBy("key", "place", "term").agg(F.count("*").alias("tf")), "terms")
    own = spark.createDataFrame(_template_terms(templates), "template int, license string, term string, ttf long")
    vocabulary = F.broadcast(own.select("term").distinct())
    df = stored(terms.groupBy("term").agg(F.count("*").alias("df")), "df")
    known = vocabulary.join(df.join(vocabulary, "term"), "term", "left").fillna(0, ["df"])
    weights = stored(own.join(known, "term").withColumn("w", _weight(F.col("ttf"), F.col("df"), n)), "weights")
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    by_term = weights.groupBy("term").agg(F.collect_list(F.struct("template", "license", "w")).alias("in"))
    by_passage = Window.partitionBy("key", "place")
    return (terms.join(df, "term").join(F.broadcast(by_term), "term", "left")
            .withColumn("_w", _weight(F.col("tf"), F.col("df"), n))
            .withColumn("_norm", F.sqrt(F.sum(F.col("_w") ** 2).over(by_passage)))
            .select("key", "place", "_w", "_norm", F.explode("in").alias("t"))
            .groupBy("key", "place", F.col("t.template").alias("template"), F.col("t.license").alias("license"))
            .agg(F.sum(F.col("_w") * F.col("t.w")).alias("dot"), F.first("_norm").alias("_norm"))
            .join(F.broadcast(norms), "template")
            .withColumn("score", F.round(F.col("dot") / (F.col("_norm") * F.col("norm")), 9)))


def matches(files: DataFrame, text: str = "text", least: float = 0.6) -> DataFrame:
    """(key, license, score, words): the best template of a file's passages or best full text for the whole file,
    if its cosine is `least` or more. Ties go to the first licence by name. `words` are those of the longest
    part of the file, up to the whole, that reaches `least` for that licence.
    """
    found = stored(passages(files, text).dropDuplicates(["key", "place"]), "passages")
    whole = stored(files.filter(F.col(text).rlike(ANCHOR)).dropDuplicates(["key"])
                   .select("key", F.lit(-1).alias("place"), F.col(text).alias("passage")), "whole")
    size = F.regexp_count("passage", F.lit(WORD)).alias("words")
    scored = None
    for part, templates in ((found, TEMPLATES), (whole, full_texts())):
        one = _scored(part, templates).filter(F.col("score") >= least).select("key", "place", "license", "score")
        one = one.join(part.select("key", "place", size), ["key", "place"])
        scored = one if scored is None else scored.unionByName(one)
    by_license = scored.groupBy("key", "license").agg(
        F.max("score").alias("score"), F.max("words").alias("words"))
    best = F.min_by(F.struct("license", "score", "words"), F.struct(-F.col("score"), "license"))
    return by_license.groupBy("key").agg(best.alias("m")).select("key", "m.license", "m.score", "m.words")


def parents(path: Column) -> Column:
    """The directories above a path, from the root down: '' first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def inherit(files: DataFrame) -> DataFrame:
    """(dir, license, source_dir): for each directory of `files` (dir, license, is_license_file), the licence
    of the nearest directory at or above it that has a licence file. Directories with none are left out.
    Among several licence files of a directory the most frequent licence counts, then the first by name."""
    votes = files.filter("is_license_file").groupBy("dir", "license").agg(F.count("*").alias("n"))
    holders = votes.groupBy("dir").agg(F.min_by("license", F.struct(-F.col("n"), "license")).alias("license"))
    dirs = files.select("dir").distinct()
    above = dirs.select("dir", F.explode(parents(F.concat(F.col("dir"), F.lit("/")))).alias("source_dir"))
    joined = above.join(holders.withColumnRenamed("dir", "source_dir"), "source_dir")
    return joined.groupBy("dir").agg(F.max_by(F.struct("license", "source_dir"), F.length("source_dir")).alias("x")).select(
        "dir", F.col("x.license").alias("license"), F.col("x.source_dir").alias("source_dir"))


def scan(files: DataFrame, path: str = "path", text: str = "text", least: float = 0.6, share: float = 0.5) -> DataFrame:
    """`files` with license, license_score, license_origin (`own`, `inherited` or null) and license_from.

    A file that is a full licence text, or whose licence passage holds `share` or more of its words, is a licence file: license_from of the
    files that inherit is its directory. A null text has no licence of its own; a null path has no
    directory, so it neither gives nor inherits. Repeated rows get equal results. Columns of `files` with
    these names are replaced. An empty table gives an empty one.
    """
    files, moved = aside(files, ["_key", "_dir", "_n", "_given", "_from", "_own", "_score"])
    path, text = moved.get(path, path), moved.get(text, text)
    own = ["license", "license_score", "license_origin", "license_from"]
    names = [c for c in files.columns if c not in own]
    key = F.xxhash64(F.coalesce(F.col(path), F.lit("\n")), F.col(text))
    d = files.select(*names).withColumn("_key", key)
    best = stored(matches(d.select(F.col("_key").alias("key"), text), text, least), "licenses")
    folder = F.when(F.col(path).contains("/"), F.regexp_replace(F.col(path), r"/[^/]*\z", "")).when(F.col(path).isNotNull(), "")
    d = d.withColumn("_dir", folder).withColumn("_n", F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)))
    lean = stored(d.select("_key", F.col("_dir").alias("dir"), "_n").join(best.withColumnRenamed("key", "_key"), "_key", "left")
                  .select("_key", "dir", "license", "score", (F.coalesce(F.col("words") >= share * F.col("_n"), F.lit(False))
                                                              & F.col("dir").isNotNull()).alias("is_license_file")), "files")
    given = inherit(lean.filter(F.col("dir").isNotNull())).withColumnsRenamed({"license": "_given", "dir": "_dir", "source_dir": "_from"})
    result = d.drop("_n").join(best.select(F.col("key").alias("_key"), F.col("license").alias("_own"), F.col("score").alias("_score")), "_key", "left")
    result = result.join(given, "_dir", "left")
    return restored(result.select(*names, F.coalesce("_own", "_given").alias("license"), F.col("_score").alias("license_score"),
                                  F.when(F.col("_own").isNotNull(), "own").when(F.col("_given").isNotNull(), "inherited").alias("license_origin"),
                                  F.when(F.col("_own").isNull(), F.col("_from")).alias("license_from")), moved)
