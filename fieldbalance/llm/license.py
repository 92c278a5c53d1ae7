"""Licence scans: TF-IDF cosine to templates, then nearest-ancestor inheritance; DataFrame only."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import table

# Licence identifiers and the public notices that state them, short ones and
# the passages by which whole licence texts and file headers are known.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above "
                     "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
                     "form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                     "in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
                     "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
]
THRESHOLD = 0.8
#: Words of a licence notice; a passage with none of them is below any threshold that is set here.
NOTICE = r"(?i)licen[sc]e|permission|permitted"
#: Marks of comments before and after the words of a line.
COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/|//+|\*+|#+|;+|%+|--+|<!--)?[ \t]*|[ \t]*(?:\*/|-->)?[ \t]*$"
TERM = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
TAG = r"(?im)SPDX-License-Identifier:[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*)"
DENIAL = r"(?i)\b(?:not|never|neither|nor)\s+(?:\w+\s+){0,2}(?:licensed|licenced|released|available|distributed|covered|subject)\b"


def template_weights(templates=TEMPLATES) -> tuple[dict, list, float]:
    """Inverse frequencies over the templates, {term: TF-IDF} and norm of each, weight of any other word."""
    import re
    counts = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    n = len(counts)
    held = Counter(w for c in counts for w in c)
    idf = {w: 1 + math.log((n + 1) / (1 + k)) for w, k in held.items()}
    vectors = [{w: k * idf[w] for w, k in c.items()} for c in counts]
    return idf, [(v, math.sqrt(sum(x * x for x in v.values()))) for v in vectors], 1 + math.log(n + 1)


def _ordered(name: Column) -> Column:
    """Sorts downwards as the name sorts upwards, for ties that go to the first name."""
    return F.array_append(F.transform(F.split(name, ""), lambda c: -F.ascii(c)), F.lit(1))


def passages(text: Column) -> Column:
    """What may be a notice: lines, paragraphs, and sentences of paragraphs, without comment marks.

    A notice broken over lines is whole in its paragraph, one within prose in its sentence.
    """
    plain = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), COMMENT, "")
    paragraphs = F.transform(F.split(plain, r"\n\s*\n", -1), lambda p: F.regexp_replace(p, r"\s+", " "))
    told = F.filter(paragraphs, lambda p: F.rlike(p, F.lit(NOTICE)))
    sentences = F.flatten(F.transform(told, lambda p: F.split(p, r"(?<=[.!?;])\s+(?=[A-Z\"(])", -1)))
    lines = F.split(plain, "\n", -1)
    return F.array_distinct(F.filter(F.concat(lines, told, sentences), lambda p: F.rlike(p, F.lit(NOTICE))))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """row, path, is_license, license, similarity for files (row, path, is_license, text).

    Each passage of a file, and the whole of a licence file, is a vector of its terms: their
    count, weighed by their frequency over the templates. A file has the licence of its best
    passage at or above the threshold; an SPDX tag counts as similarity 1, a passage that
    denies a licence not at all, ties go to the first name. A template of one sentence is
    found anywhere in a text, a longer one as a paragraph or as a whole licence file. Null,
    empty and other texts have no licence and similarity 0. Very long texts are read whole.
    Files that share a row number are one file with several texts; each row stays and gets the best of
    them. Other columns are not read, an empty table gives no rows.
    """
    spark = files.sparkSession
    idf, vectors, other = template_weights(templates)
    terms = spark.createDataFrame(
        [(w, i, templates[i][0], idf[w], x / norm) for i, (v, norm) in enumerate(vectors) for w, x in sorted(v.items())],
        "term string, template int, name string, idf double, weight double")
    known = terms.select("term", "idf").distinct()
    # A file without any word of a notice has neither passages nor tags.
    told = files.select("row", "is_license", "text").where(F.rlike("text", F.lit(NOTICE)))
    whole = F.when(F.col("is_license"), F.array(F.regexp_replace(F.regexp_replace("text", COMMENT, ""), r"\s+", " ")))
    units = told.select("row", F.explode(F.array_distinct(F.concat(
        passages(F.col("text")), F.coalesce(whole, F.array().cast("array<string>"))))).alias("passage"))
    # A passage that comes twice under one row doubles all its terms, which leaves its cosine as it is.
    units = units.where(~F.rlike("passage", F.lit(DENIAL))).select("row", F.xxhash64("passage").alias("unit"), F.explode(
        F.regexp_extract_all(F.lower("passage"), F.lit(TERM), F.lit(0))).alias("term"))
    counted = units.groupBy("row", "unit", "term").agg(F.count("*").alias("n"))
    # The terms of fixed templates: a few hundred rows.
    weighed = counted.join(F.broadcast(known), "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(other)))
    vector = weighed.groupBy("row", "unit").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w"))).alias("held"))
    dot = (vector.select("row", "unit", "norm", F.inline("held")).join(F.broadcast(terms), "term")
           .groupBy("row", "unit", "template", "name").agg((F.sum(F.col("w") * F.col("weight")) / F.first("norm")).alias("similarity")))
    tags = told.select("row", F.explode(F.regexp_extract_all("text", F.lit(TAG), F.lit(1))).alias("name"), F.lit(1.0).alias("similarity"))
    tags = tags.withColumn("name", F.regexp_replace("name", r"(?i)-(?:only|or-later)$|\+$", ""))
    names = {name.lower(): name for name, _ in templates}
    spelled = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])
    tags = tags.withColumn("name", F.coalesce(F.element_at(spelled, F.lower("name")), "name"))
    best = (dot.select("row", "name", F.least(F.lit(1.0), F.round("similarity", 9)).alias("similarity"))
            .where(F.col("similarity") >= threshold).unionByName(tags).groupBy("row")
            .agg(F.max("similarity").alias("similarity"),
                 F.max_by("name", F.struct("similarity", _ordered(F.col("name")))).alias("license")))
    return (files.select("row", "path", "is_license").join(best, "row", "left")
            .select("row", "path", "is_license", "license", F.coalesce("similarity", F.lit(0.0)).alias("similarity")))


def inherit(scanned: DataFrame) -> DataFrame:
    """row, path, license, similarity, effective_license, inherited_from (a directory), by path joins.

    A file without a licence inherits from the licence file of the nearest directory at or
    above its own (the smallest path, then row, if there are several). Every row stays, also
    repeated ones. A null path is in the top directory. Other columns than those of `scan` are
    not read; an empty table gives no rows.
    """
    folder = F.regexp_replace(F.coalesce("path", F.lit("")), "/?[^/]*$", "")
    s = scanned.select("row", "path", "is_license", "license", "similarity", folder.alias("dir"))
    given = (s.where(F.col("is_license") & F.col("license").isNotNull()).groupBy("dir")
             .agg(F.min_by("license", F.struct("path", "row")).alias("given")))
    dirs = s.select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    up = dirs.select("dir", F.explode(F.array_distinct(above)).alias("up"))
    nearest = (up.join(given.withColumnRenamed("dir", "up"), "up").groupBy("dir")
               .agg(F.max_by(F.struct("given", "up"), F.length("up")).alias("near")))
    return (s.join(nearest, "dir", "left")
            .select("row", "path", "license", "similarity", F.coalesce("license", "near.given").alias("effective_license"),
                    F.when(F.col("license").isNull(), F.col("near.up")).alias("inherited_from")))


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/lang/fifty/doc_id, the first five ids of each fifty licence files."""
    fifty = F.floor(F.col("doc_id") / 50)
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row"), F.concat_ws("/", "source", "lang", fifty, "doc_id").alias("path"),
        (F.col("doc_id") % 50 < 5).alias("is_license"), "text")
    return inherit(scan(files)).withColumnRenamed("row", "doc_id")
