"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Lines that speak of licensing and whole licence files (by name) are compared with templates: term weights are TF-IDF over the
templates, and term lists are joined to the templates' postings, so only shared terms meet. The best template at or above the
threshold is a file's own licence, if the line's or paragraph's distinguishing terms (version, Affero, ND, clauses) agree. A directory's licence is that of its licence file, else nothing. A file without its own takes
that of the nearest ancestor directory, found by joining the distinct directories' ancestors to the licensed ones.

Lines that only speak of a licence that was or isn't given say nothing. A licence file is also compared as a whole, with the texts of
licences that are short.

Null texts and paths count as empty (no licence; the root directory); of several licence files in one directory the first by path
counts; ties between templates go to the first by name; repeated rows are kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle

THRESHOLD = 0.55
#: Names of licence files, lines that speak of licensing, and terms.
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)"
SPEAKS = r"(?i)licen[sc]e|copyright|public domain|permission is hereby|redistribution"
TERM = r"[a-z0-9][a-z0-9.]*[a-z0-9]|[a-z0-9]"

# Names of licences and what headers say of them.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # Titles and openings of licence files.
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International Public License"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International Public License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    # Whole texts of short licences.
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
)

_V = r"(?:version|v|gpl)[\s.-]*"
_NC, _ND, _SA = r"\bnc\b|noncommercial", r"\bnd\b|noderiv", r"\bsa\b|sharealike"
_BY = r"\bcc[\s-]by\b|creative commons attribution"
#: What a segment has to say, all of it, and what it mustn't say, to have a licence, in lower case.
AGREES = {
    "AGPL-3.0": ([r"affero|\bagpl", _V + r"3\b"], []),
    "Apache-2.0": ([r"\bapache\b", r"\b2(?:\.0)?\b"], []),
    "BSD-2-Clause": ([r"\b2[\s-]clause|redistribution and use"], []),
    "BSD-3-Clause": ([r"\b3[\s-]clause|redistribution and use"], []),
    "CC-BY-4.0": ([_BY, r"\b4\.0\b"], [_NC, _ND, _SA]),
    "CC-BY-NC-4.0": ([_BY, r"\b4\.0\b", _NC], [_ND, _SA]),
    "CC-BY-NC-ND-4.0": ([_BY, r"\b4\.0\b", _NC, _ND], [_SA]),
    "CC-BY-NC-SA-4.0": ([_BY, r"\b4\.0\b", _NC, _SA], [_ND]),
    "CC-BY-ND-4.0": ([_BY, r"\b4\.0\b", _ND], [_NC, _SA]),
    "CC-BY-SA-4.0": ([_BY, r"\b4\.0\b", _SA], [_NC, _ND]),
    "CC0-1.0": ([r"\bcc0\b"], []),
    "EPL-2.0": ([r"eclipse|\bepl", r"\b2\.0\b"], []),
    "GPL-2.0": ([r"general public|\bgpl", _V + r"2(?:\.0)?\b(?!\.)"], [r"affero|lesser|library"]),
    "GPL-3.0": ([r"general public|\bgpl", _V + r"3\b"], [r"affero|lesser|library"]),
    "ISC": ([r"\bisc\b|permission to use, copy"], []),
    "LGPL-2.1": ([r"lesser|\blgpl", _V + r"2\.1\b"], []),
    "LGPL-3.0": ([r"lesser|\blgpl", _V + r"3\b"], []),
    "MIT": ([r"\bmit\b|permission is hereby granted"], []),
    "MPL-2.0": ([r"mozilla|\bmpl", r"\b2\.0\b"], []),
    "Unlicense": ([r"unencumbered|unlicense"], []),
}
#: What a line says that only speaks of a licence that was, or isn't, given; in lower case.
BARRED = r"\b(?:previously|formerly|no longer|not|never|once|until \d{4})\s+(?:\w+\s+){0,2}(?:released|licen[sc]ed|distributed|available|covered|under)\b|\b(?:now|is|are) proprietary\b"
#: Characters of the longest line that is taken for such a remark.
REMARK = 300
#: The sentence that BSD licences share; the clauses of the whole text tell which it is.
SHARED = r"redistribution and use in source and binary"
CLAUSES = {"BSD-2-Clause": 2, "BSD-3-Clause": 3}


def agreeing(low: Column, clauses: Column) -> Column:
    """The licences that a lower-case segment's distinguishing terms, or for BSD its text's clauses, allow; other names aren't held against it."""
    out = []
    for name, (needs, bars) in AGREES.items():
        fits = F.lit(True)
        for need in needs:
            fits &= low.rlike(need)
        for bar in bars:
            fits &= ~low.rlike(bar)
        if name in CLAUSES:
            fits &= ~low.rlike(SHARED) | (clauses == CLAUSES[name])
        out.append(F.when(fits, name))
    return F.array_compact(F.array(*out))


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def weights(templates=TEMPLATES) -> tuple[list[tuple[str, float]], list[tuple[str, int, str, float]], float]:
    """Weight by term; postings (term, template number, licence, weight of unit length); weight of a term that no template has."""
    bags = [Counter(terms(t)) for _, t in templates]
    df = Counter(t for bag in bags for t in bag)
    idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in df.items()}
    postings = []
    for i, (bag, (name, _)) in enumerate(zip(bags, templates, strict=True)):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in bag.items()))
        postings += [(t, i, name, n * idf[t] / norm) for t, n in bag.items()]
    return sorted(idf.items()), postings, math.log(1 + len(bags)) + 1


def own_licences(spark: SparkSession, segments: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """Of segments (row, at, segment, perhaps clauses): row, license, cosine of the best template at or above the threshold, of
    those that the segment's distinguishing terms agree with."""
    clauses = F.col("clauses") if "clauses" in segments.columns else F.lit(0)
    idf, postings, unknown = weights(templates)
    # Both tables are made from the fixed templates, a few hundred rows.
    idf = F.broadcast(spark.createDataFrame(idf, "term string, idf double"))
    postings = F.broadcast(spark.createDataFrame(postings, "term string, template int, license string, weight double"))
    segments = segments.withColumn("low", F.regexp_replace(F.lower("segment"), r"\s+", " "))
    segments = segments.filter((F.char_length("low") > REMARK) | ~F.col("low").rlike(BARRED))
    segments = segments.select("row", "at", "segment", agreeing(F.col("low"), clauses).alias("may"))
    bags = segments.select("row", "at", "may", F.explode(F.regexp_extract_all(F.lower("segment"), F.lit(TERM), F.lit(0))).alias("term")).groupBy("row", "at", "may", "term").count()
    weighted = bags.join(idf, "term", "left").withColumn("w", F.col("count") * F.coalesce("idf", F.lit(unknown)))
    per_template = weighted.join(postings, "term", "left").groupBy("row", "at", "may", "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    norms = weighted.groupBy("row", "at").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    cosine = per_template.filter("template IS NOT NULL").filter(F.array_contains("may", F.col("license")) | ~F.col("license").isin(list(AGREES))).join(norms, ["row", "at"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
    best = F.max(F.struct("cosine", (-F.col("template")).alias("order"), "license"))
    return cosine.filter(F.col("cosine") >= threshold).groupBy("row").agg(best.alias("x")).select("row", "x.license", "x.cosine")


def ancestors(directory: Column) -> Column:
    """The directory and all above it, as (depth, path); the root is the empty path at depth 0."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("path")))


def scan(df: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """id, path, license, cosine (of its own), origin (own, inherited or none) and from_directory of each row."""
    spark = df.sparkSession
    path = F.coalesce(path, F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.substring_index("path", "/", -1)
    docs = df.select(F.col(id_col).alias("id"), path.alias("path"), text.alias("text"))
    licence_file = F.rlike(name, F.lit(LICENCE_FILE))
    lines = F.when(F.col("text").rlike(SPEAKS), F.filter(F.split("text", "\n"), lambda line: line.rlike(SPEAKS)))
    # Of licence files the paragraphs, too: titles and versions, and clauses, go over several lines.
    paragraphs = F.filter(F.split("text", r"\n\s*\n"), lambda part: part.rlike(SPEAKS))
    low = F.regexp_replace(F.lower("text"), r"\s+", " ")
    clauses = F.when(low.rlike("neither the name|names? of (?:its|the) contributors"), 3).when(low.rlike("redistributions in binary form must"), 2).otherwise(0)
    # Few texts hold the word; the others are spared the patterns.
    clauses = F.when((F.col("text").contains("edistribution") | F.col("text").contains("EDISTRIBUTION")), F.when(low.rlike(SHARED), clauses).otherwise(0)).otherwise(0)
    segments = F.concat(F.coalesce(lines, F.array().cast("array<string>")), F.when(licence_file & F.col("text").rlike(SPEAKS), F.concat(F.array("text"), paragraphs)).otherwise(F.array().cast("array<string>")))
    folder = F.array_join(F.filter(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1), lambda p: p != ""), "/")
    rows = settle(docs.select("id", "path", folder.alias("folder"), licence_file.alias("is_licence"), segments.alias("segments"), clauses.alias("clauses")).withColumn("row", F.monotonically_increasing_id()))
    some = rows.filter(F.size("segments") > 0)
    own = settle(own_licences(spark, some.select("row", "clauses", F.posexplode("segments").alias("at", "segment")), threshold, templates))
    licensed = rows.filter("is_licence").join(own, "row").groupBy("folder").agg(F.min(F.struct("path", "license")).alias("x")).select(F.col("folder").alias("up"), F.col("x.license").alias("up_license"))
    folders = rows.select("folder").distinct().select("folder", F.explode(ancestors(F.col("folder"))).alias("a"))
    nearest = folders.join(licensed, F.col("a.path") == F.col("up")).groupBy("folder").agg(F.max_by(F.struct("up", "up_license"), "a.depth").alias("near"))
    out = rows.drop("segments", "clauses").join(own, "row", "left").join(settle(nearest), "folder", "left")
    return out.select(
        "id",
        "path",
        F.coalesce("license", "near.up_license").alias("license"),
        "cosine",
        F.when(F.col("license").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("near.up")).alias("from_directory"),
    )
