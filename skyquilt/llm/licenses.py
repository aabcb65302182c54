"""License scans in DataFrame functions only.

A notice is a line that names a licence, a window of adjacent lines around one, a sentence or a paragraph with their
comment marks stripped, a block of such paragraphs, or the whole of a licence file. Its TF-IDF vector is compared with
those of the templates by sparse cosine: blocks and whole files with full licence texts, the others with notices. Only
terms that a template has meet in the join, and the other terms count in the notice's length with the weight of a term
that no template has. A file without a notice of its own inherits from the licence files of its nearest ancestor
directory.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Notices as their licences word them, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Whole header paragraphs, of which the texts above may be a part.
HEADERS = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
#: Titles and SPDX tags by identifier, from which a licence's short notices are made.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International", "CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0 International", "CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-NC-ND-4.0": ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International", "CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"),
    "CC-BY-NC-SA-4.0": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International", "CC BY-ND 4.0", "CC-BY-ND-4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International", "CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal", "CC0-1.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "ISC": ("ISC License", "ISC"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "MIT": ("MIT License", "The MIT License (MIT)", "MIT"),
    "MPL-2.0": ("Mozilla Public License Version 2.0", "Mozilla Public License, v. 2.0", "MPL-2.0"),
}
#: Not a licence: it counts where no licence is found.
RESERVED = "LicenseRef-All-Rights-Reserved"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.\w+)?$"
_GAP = r"[^\p{L}\p{N}]+"
NAMES_ONE = r"(?i)licen[cs]e|copyright|spdx|\bcc[ -](by|0)|\bcc0\b|" + "|".join(x.replace(" ", _GAP) for x in ("permission is hereby", "redistribution and use", "all rights reserved", "is free software", "permission to use", "source code form"))
LEAST = 0.75
#: Long texts share their commonest words, so that another licence's text comes near 0.9.
LEAST_FULL = 0.95
WIDTHS = (2, 3, 4, 5, 6, 8, 10)
_TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
_MARKS = r"(?im)^(?:[^\p{L}\p{N}\n]*(?:rem|dnl)[ \t]+|[^\p{L}\p{N}\n]+)"


def _terms(text: str):
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


@cache
def _texts() -> tuple[tuple[str, str, str], ...]:
    """kind, license and text of every template."""
    notices = [*TEMPLATES, *HEADERS, (RESERVED, "All rights reserved.")]
    for name, (title, *others) in NAMES.items():
        notices += [(name, title)] + [(name, x) for x in others if " " in x]
        notices += [(name, x.format(title)) for x in ("This project is licensed under the {}.", "Licensed under the {}.", "Released under the {}.")]
        notices += [(name, f"SPDX-License-Identifier: {x}") for x in others if " " not in x]
    files = sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
    full = [("full", x.name.removesuffix(".txt"), x.read_text()) for x in files]
    return (*(("notice", *x) for x in dict.fromkeys(notices)), *full)


def _vocabulary(kind: str) -> list[str]:
    """The terms of a kind's templates, as _TERM finds them."""
    return sorted({t for k, _, text in _texts() if k == kind for t in re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())})


def _count(kind: str) -> int:
    return sum(k == kind for k, _, _ in _texts())


def _templates(spark: SparkSession) -> DataFrame:
    """kind, template, license, term, w (unit length), idf and size (terms of the template)."""
    texts = spark.createDataFrame([(kind, k, name, text) for k, (kind, name, text) in enumerate(_texts())], "kind string, template int, license string, text string")
    tf = texts.select("kind", "template", "license", F.explode(_terms("text")).alias("term")).groupBy("kind", "template", "license", "term").agg(F.count("*").alias("tf"))
    idf = tf.groupBy("kind", "term").agg((F.log((1.0 + _number(F.col("kind"))) / (1 + F.count("*"))) + 1).alias("idf"))
    both = tf.join(idf, ["kind", "term"]).withColumn("x", F.col("tf") * F.col("idf"))
    own = Window.partitionBy("template")
    return both.withColumns({"w": F.col("x") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(own)), "size": F.sum("tf").over(own)}).select("kind", "template", "license", "term", "w", "idf", "size")


def _number(kind: Column) -> Column:
    return F.when(kind == "full", _count("full")).otherwise(_count("notice"))


def _least(kind: Column) -> Column:
    return F.when(kind == "full", LEAST_FULL).otherwise(LEAST)


def _units(text: Column, is_licence: Column) -> Column:
    """The texts of a file that are compared: structs of kind, whole (of a block or a licence file's heading) and notice."""
    unit = lambda kind, whole, x: F.struct(F.lit(kind).alias("kind"), F.lit(whole).alias("whole"), x.alias("notice"))
    bare = lambda x: F.regexp_replace(x, _MARKS, "")
    joined = lambda x: F.translate(x, "\n", " ")
    names = lambda x: x.rlike(NAMES_ONE)

    def windows(lines: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: names(F.get(lines, i)))
        of = lambda i: F.array(*(F.array_join(F.slice(lines, s + 1, F.lit(w)), " ") for w in WIDTHS for s in (i, F.greatest(i - 1, F.lit(0)))))
        return F.concat(F.filter(lines, names), F.flatten(F.transform(at, of)))

    def parts(paragraph: Column) -> Column:
        sentences = F.filter(F.split(joined(paragraph), r"(?<=[.:;])\s+(?=[\p{Lu}(])"), names)
        return F.concat(F.array(joined(paragraph)), sentences, windows(F.split(paragraph, "\n")))

    lines = F.regexp_replace(text, "\r\n?", "\n")
    blocks = F.filter(F.split(lines, r"\n[ \t]*\n"), names)
    paragraphs = F.filter(F.flatten(F.transform(blocks, lambda b: F.split(bare(b), r"\n\n+"))), names)
    notices = F.transform(F.array_distinct(F.flatten(F.transform(paragraphs, parts))), lambda x: unit("notice", False, x))
    full = F.transform(blocks, lambda b: unit("full", True, bare(b)))
    first = F.filter(F.split(bare(lines), "\n", 20), lambda x: x != "")
    heading = F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda n: unit("notice", True, F.array_join(F.slice(first, F.lit(1), n), " ")))
    own = F.concat(F.array(unit("full", True, bare(lines))), heading)
    return F.concat(F.when(is_licence, own).otherwise(F.slice(own, 1, 0)), full, notices)


def _may_match(kind: Column, terms: Column) -> Column:
    """False if the terms that no template has make a cosine of the least score impossible, whatever the others are.

    A term outside weighs most and counts once at least; those inside weigh at most as much.
    """

    def possible(which: str, least: float) -> Column:
        inside = F.filter(terms, lambda t: t.isin(_vocabulary(which)))
        n, m, outside = F.size(inside), F.size(F.array_distinct(inside)), F.size(F.array_distinct(terms))
        most = (n - m + 1) * (n - m + 1) + m - 1
        return (m > 0) & (most >= least * least * (most + outside - m))

    return F.when(kind == "full", possible("full", LEAST_FULL)).otherwise(possible("notice", LEAST))


def scan_licenses(files: DataFrame) -> DataFrame:
    """file_id, path, license, score, how (own, inherited or none) and source_path, for every row of ``files``.

    ``files`` has file_id, path and text; other columns are ignored. A file's licence is that of its notice
    with the largest cosine, of at least LEAST, full texts (of at least LEAST_FULL) and headings of licence files before
    other notices, and a licence before reserved rights; ties go to the longer template, then to the smaller identifier.
    Several licence files in a directory: the best by the same order, then the smaller path. Null or empty texts have no
    notice; a null path has no ancestors; repeated rows are rows of one result each, if file_id and path are the same.
    """
    spark = files.sparkSession
    templates = _templates(spark)  # the terms of _texts, a fixed list
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select("file_id", "path", "text", F.coalesce(name.rlike(LICENCE_FILE), F.lit(False)).alias("is_licence"))
    named = rows.where(F.col("text").rlike(NAMES_ONE))
    units = named.select("file_id", "path", "is_licence", F.explode(_units(F.col("text"), F.col("is_licence"))).alias("u"))
    units = units.select("file_id", "path", "is_licence", "u.kind", "u.whole", F.xxhash64("u").alias("n"), _terms("u.notice").alias("terms"))
    notices = units.where(_may_match(F.col("kind"), F.col("terms"))).dropDuplicates(["file_id", "path", "n"])
    unit = ["file_id", "path", "is_licence", "kind", "whole", "n"]
    tf = notices.select(*unit, F.explode("terms").alias("term")).groupBy(*unit, "term").agg(F.count("*").alias("tf"))
    weights = templates.groupBy("kind", "term", "idf").agg(F.collect_list(F.struct("template", "license", "w", "size")).alias("in"))
    other = F.log(1.0 + _number(F.col("kind"))) + 1
    tf = tf.join(F.broadcast(weights), ["kind", "term"], "left").withColumn("x", F.col("tf") * F.coalesce("idf", other))
    length = Window.partitionBy("file_id", "path", "n")
    square = F.col("x") * F.col("x")
    tf = tf.withColumns({"norm": F.sqrt(F.sum(square).over(length)), "known": F.sum(F.when(F.col("in").isNotNull(), square)).over(length)}).where(F.col("in").isNotNull())
    # No cosine is above the share of the known terms in the length.
    tf = tf.where(F.sqrt("known") >= (_least(F.col("kind")) - 1e-6) * F.col("norm"))
    hits = tf.select(*unit, "x", "norm", F.inline("in"))
    cosine = hits.groupBy(*unit, "template", "license", "norm", "size").agg(F.round(F.sum(F.col("x") * F.col("w")) / F.first("norm"), 6).alias("score"))
    rank = F.when(F.col("license") == RESERVED, 2).when(F.col("whole"), 0).otherwise(1)
    order = F.struct(rank.alias("rank"), (-F.col("score")).alias("s"), (-F.col("size")).alias("z"), "license")
    best = cosine.where(F.col("score") >= _least(F.col("kind"))).groupBy("file_id", "path", "is_licence").agg(F.min(order).alias("b"))
    own = best.select("file_id", "path", "is_licence", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), F.col("b.rank").alias("rank"))
    # Directories are resolved once each, whatever number of files they hold.
    above = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    given = own.where("is_licence").withColumn("dir", above).groupBy("dir").agg(F.min(F.struct("rank", (-F.col("score")).alias("s"), "path", "license")).alias("g"))
    dirs = rows.where("path is not null").select(above.alias("dir")).distinct()
    parts = F.size(F.split("dir", "/")) - 1
    chain = F.transform(F.sequence(F.lit(0), parts), lambda k: F.struct(k.alias("depth"), F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(F.split("dir", "/"), F.lit(1), k), "/"), F.lit("/"))).alias("up")))
    walk = dirs.select("dir", F.inline(chain))
    found = walk.join(given.select(F.col("dir").alias("up"), "g"), "up").groupBy("dir").agg(F.max(F.struct("depth", "g")).alias("x"))
    found = found.select("dir", F.col("x.g.license").alias("up_license"), (-F.col("x.g.s")).alias("up_score"), F.col("x.g.path").alias("up_path"))
    out = rows.select("file_id", "path", above.alias("dir"))
    mine = own.select(F.col("file_id").alias("_id"), F.col("path").alias("_path"), "license", "score")
    same = F.col("file_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path"))
    out = out.join(mine, same, "left").join(found, "dir", "left")
    how = F.when(F.col("license").isNotNull(), F.lit("own")).when(F.col("up_license").isNotNull(), F.lit("inherited")).otherwise(F.lit("none"))
    return out.select("file_id", "path", F.coalesce("license", "up_license").alias("license"), F.coalesce("score", "up_score").alias("score"), how.alias("how"), F.when(F.col("license").isNull(), F.col("up_path")).otherwise(F.col("path")).alias("source_path"))


def as_files(documents: DataFrame) -> DataFrame:
    """The documents as files of a tree: a directory for each source, and in it for each thousand and hundred ids.

    Every tenth document is a licence file, of a thousand's directory if its hundred is the first, else of its hundred's.
    """
    thousand, hundred = F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100)
    up = F.concat_ws("/", F.coalesce("source", F.lit("")), thousand.cast("string"))
    down = F.when((F.col("doc_id") % 10 == 0) & (hundred % 10 == 0), up).otherwise(F.concat_ws("/", up, hundred.cast("string")))
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE."), F.col("doc_id").cast("string"))).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return documents.select(F.col("doc_id").alias("file_id"), F.concat_ws("/", down, name).alias("path"), "text")
