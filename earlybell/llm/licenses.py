"""License scan: TF-IDF cosine to templates, then inheritance from directories. Native.

A file's notice is its blocks that speak of licensing (for a file named like a licence,
all blocks): paragraphs between blank lines, bare comment signs included, and between
comments and code. Of each distinct notice, however many files share it, the parts are
compared: first the whole of it and the single lines that speak of licensing, then, where
neither is near enough, each of its blocks, as in a long licence text that ends with the
notice to use. Distinct parts are compared once each: sparse TF-IDF vectors, with document
frequencies over the notices of all files and the templates, are joined with the templates'
by term, and the nearest template from the least similarity on names the licence. Files named like licences or index pages, and
files that mostly speak of licensing, declare their licence for their directory.
A file without licence inherits from its nearest ancestor directory that declares one;
a directory whose files declare several is in conflict, and passes that on.

Work on a text grows as its length. A file declares for its directory where its lines that
speak of licensing hold a good part of its words.

* null or empty text: no own licence; null path: no directory, hence none to inherit
* equal similarity: the first licence by name
* repeated rows each get the result; repeated files in a directory declare once
* an empty table gives an empty result
* extra columns are carried; one named like a result column gives way to it
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earlybell.llm.common import behind, let, store

# Usual notices and openings of licences, with their public short names.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution. Neither the name of the copyright holder nor the names of its"
        " contributors may be used to endorse or promote products derived from this software without specific prior"
        " written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at"
        " your option) any later version.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,"
        " for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright: CC0 1.0 public domain dedication."),
)

CUE = r"(?i)licen[cs]|copyright|spdx|redistribut|permission|public domain|all rights reserved"
#: Lines that belong to a comment, and those that separate blocks.
COMMENT = r"^[\x20\t]*(#|//|/?\*|;|--|%|<!--)"
BLANK = r"^[\x20\t]*(#+|//+|/?\*+/?|;+|--+|%+|<!--|-->)?[\x20\t]*$"
#: Tags of a page that end a line; others stand within one.
BLOCK_TAGS = (
    r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre"
    r"|section|script|style|table|td|th|title|tr|ul)([\x20\t\r\n/][^>]*)?>"
)
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Names of files that declare a licence for their directory.
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
INDEX_NAME = r"(?i)^(|index|readme)([._-].*)?$"
#: Least cosine, and the share of a file's words in its notice that makes it a licence file.
SIMILAR = 0.6
SHARE = 0.3
RESULTS = ("license", "similarity", "status", "declared_in")


def templates(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("template"), F.lit(n).alias("license"), F.lit(t).alias("notice")) for i, (n, t) in enumerate(TEMPLATES)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _blocks(body: Column) -> Column:
    """Paragraphs, as arrays of text: blank lines part them, and so does a comment's border."""
    lines = F.split(F.regexp_replace(body, "\r", ""), "\n", -1)

    def parted(every: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit("")), every), F.lit(1), F.size(every))
        border = lambda x, last: x.rlike(COMMENT) != last.rlike(COMMENT)
        return F.zip_with(
            every, before, lambda x, last: F.when(x.rlike(BLANK), "").when(border(x, last), F.concat(F.lit("\n"), x)).otherwise(x)
        )

    return F.split(F.array_join(let(lines, parted), "\n"), "\n\n+", -1)


def _cue_lines(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: x.rlike(CUE)), "\n")


def notices(files: DataFrame, path: str, text: str) -> DataFrame:
    """Files with directory, notice (null: none) and whether they declare for the directory."""
    carried = [c for c in files.columns if c != text and c.lower() not in RESULTS]
    name = F.element_at(F.split(F.col(f"`{path}`"), "/", -1), -1)
    rows = files.select(
        *[F.col(f"`{c}`") for c in carried],
        F.regexp_extract(F.col(f"`{path}`"), "^(.*)/[^/]*$", 1).alias("_dir"),
        F.coalesce(name, F.lit("-")).rlike(LICENSE_NAME).alias("_named"),
        F.coalesce(name, F.lit("-")).rlike(INDEX_NAME).alias("_index"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_body"),
    )
    blocks = F.filter(_blocks(F.col("_body")), lambda x: F.col("_named") | x.rlike(CUE))
    notice = F.when(F.col("_named") | F.col("_body").rlike(CUE), F.array_join(blocks, "\n\n"))
    found = rows.withColumn("_notice", F.when(F.length(F.trim(notice)) > 0, notice))
    large = _words(_cue_lines(F.col("_body"))) >= SHARE * _words(F.col("_body"))
    declares = F.col("_notice").isNotNull() & (F.col("_named") | F.col("_index") | large)
    return found.withColumn("_declares", declares).drop("_body", "_named", "_index")


def _terms(rows: DataFrame, key: str) -> DataFrame:
    """Term frequencies: key, term, tf."""
    found = F.regexp_extract_all(F.lower("notice"), F.lit(TERM), F.lit(0))
    return rows.select(key, F.explode(found).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def _parts(distinct: DataFrame) -> DataFrame:
    """What of each notice is compared: key, stage (0 first), part (a digest) and its text."""
    whole = F.array(F.col("notice"), _cue_lines(F.col("notice")))
    cued = F.filter(F.split("notice", "\n\n"), lambda x: x.rlike(CUE))

    def staged(found: Column, stage: int) -> Column:  # a second parameter of the lambda would get the index
        return F.transform(found, lambda x: F.struct(F.lit(stage).alias("stage"), x.alias("text")))

    both = F.concat(staged(whole, 0), staged(cued, 1))
    return distinct.select("key", F.inline(F.array_distinct(both))).select("key", "stage", F.md5("text").alias("part"), "text")


def matched(found: DataFrame) -> DataFrame:
    """The licence and similarity of each distinct notice (by its digest) that is near one."""
    spark = found.sparkSession
    named = found.where("_notice IS NOT NULL").select(F.md5("_notice").alias("key"), F.col("_notice").alias("notice"))
    distinct = store(named.groupBy("key").agg(F.first("notice").alias("notice"), F.count(F.lit(1)).alias("files")), "notices")
    models = templates(spark)
    parts = store(_parts(distinct), "license_parts")
    texts = parts.groupBy("part").agg(F.first("text").alias("notice"))
    of_part, of_template = store(_terms(texts, "part"), "license_part_terms"), _terms(models, "template")
    counted = _terms(distinct, "key").join(distinct.select("key", "files"), "key").select("term", F.col("files").alias("n"))
    frequency = counted.union(of_template.select("term", F.lit(1).cast("long"))).groupBy("term").agg(F.sum("n").alias("df"))
    total = len(TEMPLATES) + (distinct.agg(F.sum("files")).first()[0] or 0)
    idf = frequency.select("term", (F.log(F.lit(1 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    idf = store(idf, "license_terms")
    w_part = of_part.join(idf, "term").select("part", "term", (F.col("tf") * F.col("idf")).alias("w"))
    w_template = of_template.join(idf, "term").select("template", "term", (F.col("tf") * F.col("idf")).alias("v"))
    norm = w_part.groupBy("part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    template_norm = w_template.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("template_norm"))
    dots = w_part.join(w_template, "term").groupBy("part", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("template_norm")), 6)
    scored = dots.join(norm, "part").join(template_norm, "template").join(models.select("template", "license"), "template")
    near = scored.select("part", cosine.alias("similarity"), "license").where(F.col("similarity") >= SIMILAR)
    near = near.groupBy("part").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license")).alias("hit"))
    best = parts.select("key", "stage", "part").join(near, "part").groupBy("key")
    best = best.agg(F.min(F.struct("stage", "hit.minus", "hit.license")).alias("hit"))
    return best.select("key", F.col("hit.license").alias("license"), (-F.col("hit.minus")).alias("similarity"))


def _ancestors(directory: Column) -> Column:
    """A directory and those above it, the nearest first."""
    steps = F.split(directory, "/", -1)
    return F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Files (without their text) with license, similarity, status (own, inherited, conflict,
    none) and declared_in, the directory that an inherited licence or conflict comes from.
    """
    own = [c for c in files.columns if c != text]
    return behind(files, lambda rows, name: _scanned(rows, name[path], name[text]), own, RESULTS)


def _scanned(files: DataFrame, path: str, text: str) -> DataFrame:
    """``scan`` under names that clash with none in here."""
    found = store(notices(files, path, text), "license_files")
    carried = [F.col(f"`{c}`") for c in found.columns if c not in ("_dir", "_notice", "_declares")]
    near = store(matched(found), "license_matches")
    with_notice = found.where("_notice IS NOT NULL")
    own = with_notice.join(near, F.md5("_notice") == near["key"], "left")
    known = store(own.where("license IS NOT NULL").select("_dir", "_declares", "license"), "license_declared")
    declared = known.where("_declares AND _dir IS NOT NULL").groupBy("_dir").agg(F.min("license").alias("low"), F.max("license").alias("high"))
    declared = declared.select(F.col("_dir").alias("declared_in"), "low", "high")
    places = found.where("_dir IS NOT NULL").select("_dir").distinct()
    steps = places.select("_dir", F.posexplode(_ancestors(F.col("_dir"))).alias("up", "ancestor"))
    reached = steps.join(declared, F.col("ancestor") == F.col("declared_in"))
    nearest = reached.groupBy("_dir").agg(F.min(F.struct("up", "declared_in", "low", "high")).alias("from"))
    nearest = store(nearest.select(F.col("_dir").alias("at"), "from.declared_in", "from.low", "from.high"), "license_inherited")
    mine = own.where("license IS NOT NULL").select(
        *carried, "license", "similarity", F.lit("own").alias("status"), F.lit(None).cast("string").alias("declared_in")
    )
    without = found.where("_notice IS NULL").select(*carried, "_dir").union(own.where("license IS NULL").select(*carried, "_dir"))
    heirs = without.join(nearest, without["_dir"] == nearest["at"], "left")
    status = F.when(F.col("at").isNull(), "none").when(F.col("low") != F.col("high"), "conflict").otherwise("inherited")
    rest = heirs.select(
        *carried,
        F.when(status == "inherited", F.col("low")).alias("license"),
        F.lit(None).cast("double").alias("similarity"),
        status.alias("status"),
        "declared_in",
    )
    return mine.union(rest)
