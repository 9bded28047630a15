"""License scan: notices by sparse TF-IDF cosine with templates, then nearest licence by folder.

All steps are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.llm.expressions import words
from playline.session import stage

#: Least cosine of a notice with its template.
LEAST = 0.6
#: Bits in which the templates' terms are marked by hash.
BITS, SHIFT = 1 << 19, 13
#: A line with one of these, in any case, mentions a licence and is counted, whatever its cosine.
HINTS = ("licen", "LICEN", "Licen", "SPDX", "opyright", "OPYRIGHT", "rights reserved", "ublic domain")

# Notices as they stand in headers, by licence.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            " software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without"
                     " modification, are permitted. Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
)

# Headers of several lines, by licence. The full texts lie in license_texts.
GRANT = (
    "is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name}"
    " as published by the Free Software Foundation, either version {number} of the License, or (at your"
    " option) any later version."
)
WARRANTY = (
    " is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
    " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for"
    " more details. You should have received a copy of the GNU {name} along with this {thing}."
)
FAMILY = (
    ("GPL-2.0", "program", ";", "General Public License", "2"),
    ("GPL-3.0", "program", ":", "General Public License", "3"),
    ("LGPL-2.1", "library", ";", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "library", ":", "Lesser General Public License", "3"),
    ("AGPL-3.0", "program", ":", "Affero General Public License", "3"),
)
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this'
                   " file except in compliance with the License. You may obtain a copy of the License at"
                   " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
                   ' to in writing, software distributed under the License is distributed on an "AS IS"'
                   " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the"
                   " License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
                " copy of the MPL was not distributed with this file, You can obtain one at"
                " https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
            " fee is hereby granted, provided that the above copyright notice and this permission notice"
            ' appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES'
            " WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
            " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL"
            " DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN"
            " ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH"
            " THE USE OR PERFORMANCE OF THIS SOFTWARE."),
)
#: What a comment line begins with.
COMMENT = "(?:#|//|/[*]|[*]|--|;|%|<!--|dnl\\b|(?i:rem)\\b)"


def texts() -> list[tuple[str, str]]:
    """Full licence texts and headers of several lines, by licence."""
    files = resources.files("playline.llm").joinpath("license_texts").iterdir()
    full = sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in files)
    heads = [*HEADERS]
    for license, thing, mark, name, number in FAMILY:
        grant = f"This {thing} " + GRANT.format(mark=mark, name=name, number=number)
        heads += [(license, grant), (license, grant + f" This {thing}" + WARRANTY.format(name=name, thing=thing))]
    return full + heads


def terms(text: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    own = words(text)
    pairs = F.zip_with(own, F.slice(own, 2, 1 << 30), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.filter(F.concat(own, pairs), lambda t: F.length(t) > 0))


def units(text: Column) -> Column:
    """What is compared: lines, blocks of lines between lines without words or blank lines, blocks
    of comment lines, and the whole text."""
    blocks = F.split(text, "\\n[^A-Za-z0-9\\x{80}-\\x{10FFFF}]*\\n")
    sections = F.split(text, "\\n\\s*\\n")
    comments = F.regexp_replace(text, f"(?m)^[ \\t]*(?!{COMMENT})\\S.*$", "")
    comments = F.when(text.rlike(f"(?m)^[ \\t]*{COMMENT}"), F.split(comments, "\\n\\s*\\n"))
    none = F.array().cast("array<string>")
    parts = F.concat(F.split(text, "\n"), blocks, sections, F.coalesce(comments, none), F.array(text))
    return F.array_distinct(parts)


def is_line(notice: Column) -> Column:
    return ~F.contains(notice, F.lit("\n"))


def mentions(line: Column) -> Column:
    low = F.lower(line)
    return reduce(Column.__or__, [F.contains(low, F.lit(h)) for h in sorted({h.lower() for h in HINTS})])


def hashed(text: Column) -> Column:
    """The distinct hashes of ``terms``."""
    pairs = lambda own: F.transform(own, lambda w, i: F.xxhash64(w, F.get(own, i + 1)))
    both = lambda own: F.concat(
        F.transform(own, lambda w: F.xxhash64(w)),
        F.slice(pairs(own), 1, F.greatest(F.size(own) - 1, F.lit(0))),
    )
    return F.array_distinct(F.flatten(F.transform(F.array(words(text)), both)))


def near(spark: SparkSession, lists, least: float) -> Callable[[Column], Column]:
    """Whether a unit of these hashed terms can have a cosine of ``least`` with a template of one of
    the lists; never false for one that has.

    With S the squared weights that unit and template share, and u and t their lengths, S >= least u t
    and S is at most the square of either. So S >= least^2 u^2 and u >= least t: as no term weighs more
    than an unknown one, at least least^2 of the unit's terms are terms of templates, and it has at
    least least^2 t^2 / rarest^2 terms. Terms are looked up by bits of their hash, so some more may pass.
    """
    shortest, marks = [], [0] * (BITS // 64)
    for templates in lists:
        _, weights, rarest = weighted(spark, templates)
        shortest.append(weights.agg(F.min("norm") / rarest).first()[0] ** 2 * least**2)
        listed = spark.createDataFrame([(text,) for _, text in templates], "text string")
        for r in listed.select(F.explode_outer(hashed(F.col("text"))).alias("h")).distinct().collect():
            marks[r.h % (BITS // 64)] |= 1 << (r.h // (BITS // 64)) % 64
    marks = ",".join(str(m - (1 << 64) if m >> 63 else m) for m in marks)
    bits = F.split(F.lit(marks), ",").cast("array<bigint>")

    def known(h: Column) -> Column:
        word = F.get(bits, h.bitwiseAND(F.lit(BITS // 64 - 1)).cast("int"))
        return F.getbit(word, F.shiftright(h, SHIFT).bitwiseAND(F.lit(63)).cast("int")) == 1

    def close(own: Column) -> Column:
        count = F.size(own)
        enough = count >= min(shortest) - 1e-6
        return (count > 0) & enough & (F.size(F.filter(own, known)) >= least**2 * count - 1e-6)

    return close


def notices(files: DataFrame, least: float = LEAST) -> DataFrame:
    """``notice``: every distinct unit of a text that mentions a licence or may be near a template."""
    spark = files.sparkSession
    parts = files.select("file_key", F.explode_outer(units(F.col("text"))).alias("notice"))
    close = near(spark, (TEMPLATES, texts()), least)
    is_close = F.exists(F.array(hashed(F.col("notice"))), close)
    return parts.where((is_line(F.col("notice")) & mentions(F.col("notice"))) | is_close)


def weighted(spark: SparkSession, templates):
    """The templates' terms with their weights, the same a template with its length, and the weight
    of a term that none has."""
    listed = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(templates)],
        "template int, license string, text string",
    )
    spread = listed.select("template", "license", F.explode_outer(terms(F.col("text"))).alias("term"))
    count = len(templates)
    rarity = spread.groupBy("term").agg((F.log(count / F.count(F.lit(1))) + 1).alias("weight"))
    weights = spread.join(rarity, "term")
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    return rarity, weights.join(norms, "template"), F.log(F.lit(float(count))) + 1


def matched(spark: SparkSession, lines: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``notice, license, cosine``: the nearest template of each distinct notice.

    Weights are the logs of how rare a term is among the templates; a term that none has counts as
    the rarest. Ties go to the licence that comes first by name.
    """
    rarity, weights, rarest = weighted(spark, templates)
    # The templates are a fixed list, so their size is known.
    weights, rarity = F.broadcast(weights), F.broadcast(rarity)
    own = lines.select("notice").distinct()
    parts = own.select("notice", F.explode_outer(terms(F.col("notice"))).alias("term"))
    lengths = (
        parts.join(rarity, "term", "left")
        .groupBy("notice")
        .agg(F.sqrt(F.sum(F.coalesce("weight", rarest) ** 2)).alias("length"))
    )
    products = (
        parts.join(weights, "term")
        .groupBy("notice", "template", "license")
        .agg((F.sum(F.col("weight") ** 2) / F.first("norm")).alias("product"))
    )
    # Rounded, so that the order in which terms are added does not decide a tie.
    cosine = F.round(F.col("product") / F.col("length"), 9)
    return (
        products.join(lengths, "notice")
        .select("notice", "license", cosine.alias("cosine"))
        .groupBy("notice")
        .agg(F.min(F.struct((-F.col("cosine")).alias("away"), "license")).alias("best"))
        .select("notice", F.col("best.license").alias("license"), (-F.col("best.away")).alias("cosine"))
    )


def parents(folder: Column) -> Column:
    """The folder itself and all above it, nearest first; the top is the empty string."""
    steps = F.split(folder, "/")
    count = F.size(steps)
    above = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(steps, 1, count - i), "/")
    )
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(above, F.array(F.lit(""))))


def licenses(
    files: DataFrame,
    key: str = "doc_id",
    path: str = "path",
    text: str = "text",
    is_license_file: Column | None = None,
    least: float = LEAST,
) -> DataFrame:
    """The licence of every file: by its own notices, else of the nearest folder above it that has one.

    Returns ``file_id, path, n_notices, own_license, cosine, license, inherited_from``. A file's own
    licence is that of its notice with the highest cosine of at least ``least``; ties go to the first
    by name. Files for which ``is_license_file`` holds (by default those named LICENSE, LICENCE or
    COPYING) give theirs to their folder and the folders below; of several, the highest cosine, then
    the first by name, counts. ``inherited_from`` is that folder ("" is the top), null otherwise.

    A null or empty text has no notice, a null path lies in the top folder, a null key stays null.
    Rows of an equal key, path and text are alike and each stays a row. Other columns are not read.
    """
    spark = files.sparkSession
    place, body = F.col(path).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = F.coalesce(place, F.lit("")).rlike("(?i)(^|/)(licen[cs]e|copying)([.][a-z]+)?$")
    file_id = F.col(key).cast("long")
    name = F.md5(
        F.concat_ws("\n", F.coalesce(file_id.cast("string"), F.lit("-")), F.coalesce(place, F.lit("-")), body)
    )
    flag = named if is_license_file is None else is_license_file
    rows = files.select(
        file_id.alias("file_id"),
        place.alias("path"),
        F.regexp_extract(F.coalesce(place, F.lit("")), "^(.*)/[^/]*$", 1).alias("folder"),
        F.coalesce(flag, F.lit(False)).alias("gives"),
        name.alias("file_key"),
        body.alias("text"),
    )
    lines = stage(notices(rows, least).distinct(), "notices")
    best = reduce(
        DataFrame.union,
        [
            matched(spark, lines, templates).where(F.col("cosine") >= least).withColumn("rank", F.lit(rank))
            for rank, templates in enumerate((texts(), TEMPLATES))
        ],
    )
    best = best.groupBy("notice").agg(
        F.min(F.struct("rank", (-F.col("cosine")).alias("away"), "license")).alias("best")
    )
    line = is_line(F.col("notice")) & (mentions(F.col("notice")) | F.col("best").isNotNull())
    own = stage(
        lines.join(best, "notice", "left")
        .groupBy("file_key")
        .agg(
            F.count(F.when(line, 1)).alias("n_notices"),
            F.min("best").alias("best"),
        )
        .withColumn("n_notices", F.greatest("n_notices", F.col("best").isNotNull().cast("long"))),
        "own-licenses",
    )
    light = rows.drop("text")
    judged = stage(
        light.join(own, "file_key", "left").select(
            "file_id",
            "path",
            "folder",
            "gives",
            F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
            F.col("best.license").alias("own_license"),
            (-F.col("best.away")).alias("cosine"),
        ),
        "judged",
    )
    given = (
        judged.where("gives AND own_license IS NOT NULL")
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("cosine")).alias("away"), "own_license")).alias("best"))
        .select(F.col("folder").alias("above"), F.col("best.own_license").alias("given_license"))
    )
    # Folders are resolved once each, whatever the number of files in them.
    folders = judged.select("folder").distinct()
    near = (
        folders.select("folder", F.posexplode_outer(parents(F.col("folder"))).alias("steps", "above"))
        .join(given, "above")
        .groupBy("folder")
        .agg(F.min(F.struct("steps", "above", "given_license")).alias("nearest"))
    )
    inherits = F.col("own_license").isNull()
    return judged.join(near, "folder", "left").select(
        "file_id",
        "path",
        "n_notices",
        "own_license",
        F.round("cosine", 6).alias("cosine"),
        F.coalesce("own_license", "nearest.given_license").alias("license"),
        F.when(inherits, F.col("nearest.above")).alias("inherited_from"),
    )
