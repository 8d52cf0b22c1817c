"""Licence scans with DataFrame operations alone: TF-IDF cosine of statements to templates, then inheritance by path.

A text is looked at in units: its lines, its sentences, its paragraphs and the sentences of two or three lines on end, and
the stretches that begin like a licence body. A unit and a template are sparse vectors of term counts times inverse document
frequency over the templates; a unit carries the licence of the template with the largest cosine of ``LEAST`` or more.

Nothing that reaches ``LEAST`` is put aside before it is scored. A unit's cosine to a template is at most the norm of the
template's part on the terms that the unit has. So a text or unit that can reach ``LEAST`` has one of the template's anchors
(its heaviest terms but common words, as many as it takes) or, where common words alone could do it, all of one of the least
sets of them that could: else it is put aside. Units are scored if the bound over all their terms reaches ``LEAST`` for some
template.
Files without a licence of their own take that of the licence file in the nearest directory above them.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache, reduce
from itertools import combinations
from math import log, sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernflow.scratch import materialize

LEAST = 0.8
TERM = "[a-z0-9]+(?:-[a-z0-9]+|[.][0-9]+)*"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-_.][^/]*)?$"

# Words that are common in texts. They become anchors only where the others are not enough.
COMMON = frozenset("a an and are as at be by code for form free from in into is it later mit of on only or source subject terms that the this to under v was with work".split())

# Statements by which texts say their licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "Unencumbered software released into the public domain under the Unlicense."),
)

# Licence texts' operative parts and standard headers, each taken from its first words on.
TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# What opens a line inside a comment, and what ends one.
MARKS = r"(?md)^[ \t]*(?://+|/\*+|\*+/?|#+|--+|;+|%+|<!--)[ \t]*|[ \t]*(?:\*+/|-->)[ \t\r]*$"
SENTENCE = "(?<=[.!?])[ \\t]+"
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = "[ \\t\\n\\x0B\\f\\r]+"


@lru_cache(8)
def _model(templates: tuple[tuple[str, str], ...], least: float) -> tuple[list[tuple[int, str, str, float]], dict[str, float], float, list[str]]:
    """Rows (template, licence, term, unit weight), the terms' weights by themselves, that of an unknown term, and the sets of
    terms of which what reaches ``least`` has one whole."""
    counts = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    spread = Counter(term for c in counts for term in c)
    idf = {term: log((1 + len(templates)) / (1 + n)) + 1 for term, n in sorted(spread.items())}
    rows, sets = [], set()
    for i, ((name, _), c) in enumerate(zip(templates, counts, strict=True)):
        norm = sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        weight = {t: n * idf[t] / norm for t, n in c.items()}
        left, most = 1.0, (least - 1e-6) ** 2
        for t in sorted(set(c) - COMMON, key=lambda t: (t[0].isdigit(), -weight[t], t)):
            if left < most:
                break
            sets.add((t,))
            left -= weight[t] ** 2
        if left >= most:
            rest = sorted(set(c) & COMMON)
            for size in range(1, len(rest) + 1):
                for some in combinations(rest, size):
                    if sum(weight[t] ** 2 for t in some) >= most and not any(set(x) <= set(some) for x in sets):
                        sets.add(some)
        rows += [(i, name, t, w) for t, w in sorted(weight.items())]
    return rows, idf, log(1 + len(templates)) + 1, sorted(sets, key=lambda x: (len(x), x))


def _told(text, templates, least: float):
    """Whether a text in lower case has all terms of one of the sets without which nothing in it can reach ``least``."""
    found, sets = F.lit(False), _model(tuple(templates), least)[3]
    for terms in sets:
        if not any(len(x) == 1 and x != terms and any(x[0] in t for t in terms) for x in sets):  # what has it has the other
            found = found | _all_of(text, terms)
    return found


def _all_of(text, terms):
    return reduce(lambda a, b: a & b, [text.contains(t) for t in sorted(terms, key=lambda t: (-len(t), t))])


def _terms(unit):
    return F.regexp_extract_all(F.lower(unit), F.lit(TERM), F.lit(0))


def _may_reach(unit, templates, least: float):
    """Whether the bound on a unit's cosine reaches ``least`` for some template: the norm of the template's part on the
    unit's terms."""
    rows, idf, _, _ = _model(tuple(templates), least)
    parts: dict[str, list[float]] = {t: [0.0] * len(templates) for t in idf}
    for i, _, t, w in rows:
        parts[t][i] = w * w
    numbers = lambda v: F.array(*[F.lit(x) for x in v])
    table = F.create_map(*[c for t, v in parts.items() for c in (F.lit(t), numbers(v))])
    have = F.array_intersect(_terms(unit), F.array(*[F.lit(t) for t in parts]))
    bound = F.aggregate(have, numbers([0.0] * len(templates)), lambda held, t: F.zip_with(held, table[t], lambda x, y: x + y))
    return F.exists(bound, lambda x: x >= (least - 1e-6) ** 2)


def license_of_units(spark: SparkSession, units: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """(unit, license, similarity) for each distinct string ``unit`` that reaches ``least``; ties go to the first template."""
    named = units.select("unit").distinct().withColumn("uid", F.md5(F.col("unit").cast("binary")))
    return named.join(_score(spark, named, templates, least), "uid").select("unit", "license", "similarity")


def _score(spark: SparkSession, units: DataFrame, templates, least: float) -> DataFrame:
    """(uid, license, similarity) of units (uid, unit). A unit may be a whole text, so only its ``uid`` goes with its terms."""
    rows, idf, unknown, _ = _model(tuple(templates), least)
    known = spark.createDataFrame(list(idf.items()), "term string, idf double")
    vectors = spark.createDataFrame(rows, "template int, license string, term string, weight double")
    terms = units.select("uid", _terms(F.col("unit")).alias("terms")).dropDuplicates(["uid"]).select("uid", F.explode("terms").alias("term"))
    terms = terms.groupBy("uid", "term").agg(F.count("*").alias("tf")).join(F.broadcast(known), "term", "left")
    terms = terms.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    norms = terms.groupBy("uid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = terms.where("idf is not null").join(F.broadcast(vectors), "term").groupBy("uid", "template", "license")
    dots = dots.agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, "uid").withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("similarity") >= least)
    best = scored.groupBy("uid").agg(F.max_by(F.struct("license", "similarity"), F.struct("similarity", -F.col("template"))).alias("b"))
    return best.select("uid", "b.license", "b.similarity")


def _stretches(text, texts):
    """For each of ``texts`` the stretches of its length from its first three words on, in a text without line breaks."""
    found = []
    for first, n in sorted({(" ".join(t.split()[:3]), len(t.split())) for _, t in texts}):
        found.append(F.regexp_extract_all(text, F.lit(rf"(?i)(?<![a-z0-9]){re.escape(first)}\S*(?: \S+){{0,{n - 3}}}"), F.lit(0)))
    return F.flatten(F.array(*found))


def scan(files: DataFrame, key: str, path: str, text: str = "text", templates=TEMPLATES, least: float = LEAST, texts=TEXTS) -> DataFrame:
    """(key, path, license, basis, similarity, found_in) for every row of ``files``.

    ``basis`` is ``file`` for a licence file's own statement (its name says so, or half of its words are the statement),
    ``header`` for another text's own one, ``inherited`` with the licence file's path in ``found_in`` for a text without one
    below a directory with a licence file, and null for neither. A text with several takes the one with the largest cosine,
    then the first by name. Several licence files in a directory: the first path counts. Rows with one key and path share
    their result; null and empty texts have none of their own; a null path inherits nothing and is no licence file; an empty
    table gives no rows. Whole texts are scanned; the templates are broadcast, being a fixed list. Of licence bodies and
    standard headers (``texts``) the stretch from their first words on is compared, line breaks and comment marks folded.
    """
    spark = files.sparkSession
    lowered = files.select(F.col(key).alias("k"), F.col(path).alias("p"), F.lower(F.col(text)).alias("t"))  # no rule tells cases apart
    firsts = sorted({" ".join(t.lower().split()[:3]) for _, t in texts})
    begun = reduce(lambda a, b: a | b, [_all_of(F.col("t"), f.split()) for f in firsts], F.lit(False))
    lowered = materialize(lowered.withColumn("told", _told(F.col("t"), templates, least)).where(F.col("told") | begun), "texts")
    rows = lowered.where("told")
    # columns of their own, so that each array is made once; lines are zipped, as a lambda would cut the text anew for each
    rows = rows.withColumn("lines", F.split("t", "\\n")).withColumn("bare", F.split(F.regexp_replace("t", MARKS, ""), "\\n"))
    zipped = lambda a, n: F.zip_with(a, F.slice("bare", n, F.size("bare")), lambda x, y: F.concat_ws(" ", x, y))
    rows = rows.withColumn("two", zipped("bare", 2)).withColumn("three", zipped("two", 3))  # notices wrapped over neighbouring lines
    told = lambda a: F.filter(a, lambda x: _told(x, templates, least))
    rows = rows.withColumn("some", told(F.concat("lines", "two", "three")))
    cut = F.concat("some", told(F.flatten(F.transform("some", lambda x: F.split(x, SENTENCE)))), told(F.split("t", "\\n[ \\t]*\\n")))
    words_of = lambda c: F.regexp_count(c, F.lit(WORD))
    found = F.array_distinct(F.transform(cut, lambda x: F.btrim(x, F.lit(" \t\r\n"))))
    units = rows.select("k", "p", words_of(F.col("t")).alias("n_words"), F.explode(found).alias("unit")).where(_may_reach(F.col("unit"), templates, least))
    share = (words_of(F.col("unit")) * 2 >= F.col("n_words")).alias("share")
    units = units.select("k", "p", share, F.md5(F.col("unit").cast("binary")).alias("uid"), "unit")
    units = materialize(units, "units")
    named = _score(spark, units.select("uid", "unit"), templates, least)
    said = units.select("k", "p", "share", "uid").join(named, "uid").select("k", "p", "share", "license", "similarity")
    if texts:
        flat = F.regexp_replace(F.regexp_replace("t", MARKS, " "), SPACES, " ")
        bodies = lowered.select("k", "p", words_of(F.col("t")).alias("n_words"), flat.alias("t"))
        bodies = bodies.where(F.col("t").rlike("|".join(map(re.escape, firsts))))
        bodies = bodies.select("k", "p", "n_words", F.explode(F.array_distinct(_stretches(F.col("t"), texts))).alias("unit"))
        bodies = bodies.select("k", "p", (words_of(F.col("unit")) * 2 >= F.col("n_words")).alias("share"), F.md5(F.col("unit").cast("binary")).alias("uid"), "unit")
        bodies = materialize(bodies, "bodies")
        named = _score(spark, bodies.select("uid", "unit"), texts, least)
        said = said.unionByName(bodies.join(named, "uid").select("k", "p", "share", "license", "similarity"))
    own = said.groupBy("k", "p").agg(
        F.min_by(F.struct("license", "similarity"), F.struct(-F.col("similarity"), F.col("license"))).alias("b"),
        F.max("share").alias("mostly"),
    )
    is_file = F.col("p").isNotNull() & (F.coalesce(F.col("p").rlike(LICENSE_FILE), F.lit(False)) | F.col("mostly"))
    own = own.select(F.col("k").alias("k2"), F.col("p").alias("p2"), "b.license", "b.similarity", is_file.alias("is_file"))
    folder = lambda c: F.regexp_replace(c, "/?[^/]*$", "")
    places = own.where("is_file").select(folder("p2").alias("dir"), F.struct(F.col("p2").alias("path"), "license").alias("f")).groupBy("dir").agg(F.min("f").alias("f"))
    base = files.select(F.col(key).alias("k"), F.col(path).alias("p"))
    out = base.join(own, F.col("k").eqNullSafe(F.col("k2")) & F.col("p").eqNullSafe(F.col("p2")), "left")
    dirs = base.where("p is not null").select(folder("p").alias("own_dir")).distinct()
    parts = F.split("own_dir", "/")
    above = F.concat(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")), F.array(F.lit("")))
    above = dirs.select("own_dir", F.explode(F.array_distinct(above)).alias("dir")).join(places, "dir")
    nearest = above.groupBy("own_dir").agg(F.max_by("f", F.length("dir")).alias("up"))
    out = out.withColumn("own_dir", F.when(F.col("license").isNull(), folder("p"))).join(nearest, "own_dir", "left")
    basis = F.when(F.col("license").isNotNull(), F.when(F.col("is_file"), "file").otherwise("header")).when(F.col("up").isNotNull(), "inherited")
    found_in = F.when(F.col("license").isNull(), F.col("up.path"))
    return out.select(F.col("k").alias(key), F.col("p").alias(path), F.coalesce("license", "up.license").alias("license"), basis.alias("basis"), "similarity", found_in.alias("found_in"))


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = F.concat_ws("/", F.col("source"), F.col("lang"), F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt")))
    return scan(docs.select("doc_id", place.alias("path"), "text"), "doc_id", "path")


def _sql_scores(name: str, templates, least: float) -> str:
    """CTEs that score all units of ``name`` (unit, ...), whatever their terms, into ``name``_best (unit, license, similarity)."""
    rows, idf, unknown, _ = _model(tuple(templates), least)
    vectors = ", ".join(f"({i}, '{licence}', '{t}', {w!r}::DOUBLE)" for i, licence, t, w in rows)
    known = ", ".join(f"('{t}', {w!r}::DOUBLE)" for t, w in idf.items())
    return f"""
{name}_v(i, name, t, weight) AS (VALUES {vectors}), {name}_known(t, idf) AS (VALUES {known}),
{name}_k AS (SELECT unit, unnest(regexp_extract_all(lower(unit), '{TERM}')) AS t FROM (SELECT DISTINCT unit FROM {name})),
{name}_w AS (SELECT unit, k.t, count(*) * coalesce(any_value(idf), {unknown!r}::DOUBLE) AS w FROM {name}_k k LEFT JOIN {name}_known n ON n.t = k.t GROUP BY 1, 2),
{name}_n AS (SELECT unit, sqrt(sum(w * w)) AS norm FROM {name}_w GROUP BY 1),
{name}_s AS (SELECT unit, i, name, sum(w * weight) AS dot FROM {name}_w w JOIN {name}_v v ON v.t = w.t GROUP BY 1, 2, 3),
{name}_r AS (SELECT s.unit, i, name, round(dot / norm, 6) AS similarity FROM {name}_s s JOIN {name}_n n ON n.unit = s.unit),
{name}_best AS (SELECT unit, arg_max(name, (similarity, -i)) AS license, max(similarity) AS similarity FROM {name}_r WHERE similarity >= {least} GROUP BY 1)"""


def oracle(templates=TEMPLATES, least: float = LEAST, texts=TEXTS) -> str:
    """DuckDB SQL for op5_licenses: all units and stretches are scored, none put aside before."""
    trim = lambda x: f"trim({x}, ' ' || chr(9) || chr(13) || chr(10))"
    count = lambda x: f"len(regexp_extract_all({x}, '{WORD}'))"
    marks = MARKS.replace("(?md)", "(?m)").replace("'", "''")
    sentences = lambda x: f"flatten(list_transform({x}, lambda x: string_split(regexp_replace(x, '([.!?])[ \\t]+', '\\1' || chr(1), 'g'), chr(1))))"
    spans = lambda n: f"list_transform(range(1, len(m) + 1), lambda i: array_to_string(m[i:i + {n - 1}], ' '))"
    firsts = sorted({(" ".join(t.split()[:3]), len(t.split())) for _, t in texts})
    stretch = lambda f, n: f"regexp_extract_all(f, '(?i)(?:^|[^a-z0-9])(" + re.escape(f).replace("'", "''") + f"[^ ]*(?: [^ ]+){{0,{n - 3}}})', 1)"
    return f"""
WITH d AS (SELECT doc_id, concat_ws('/', source, lang, coalesce(doc_id::VARCHAR, 'none') || '.txt') AS path, text FROM documents),
c AS (SELECT doc_id, path, {count("text")} AS n_words, string_split(text, chr(10)) AS l, regexp_split_to_array(text, '\\n[ \\t]*\\n') AS p,
  string_split(regexp_replace(text, '{marks}', '', 'g'), chr(10)) AS m, regexp_replace(regexp_replace(text, '{marks}', ' ', 'g'), '{SPACES}', ' ', 'g') AS f FROM d),
e AS (SELECT doc_id, path, n_words, list_concat(l, {sentences("l")}, p, s2, {sentences("s2")}, s3, {sentences("s3")}) AS units
  FROM (SELECT *, {spans(2)} AS s2, {spans(3)} AS s3 FROM c)),
u AS (SELECT DISTINCT doc_id, path, n_words, {trim("unit")} AS unit FROM (SELECT doc_id, path, n_words, unnest(units) AS unit FROM e)),
b AS (SELECT DISTINCT doc_id, path, n_words, unnest(list_concat({", ".join(stretch(f, n) for f, n in firsts)})) AS unit FROM c),{_sql_scores("u", templates, least)},{_sql_scores("b", texts, least)},
said AS (SELECT doc_id, path, n_words, u.unit, license, similarity FROM u JOIN u_best x ON x.unit = u.unit UNION ALL SELECT doc_id, path, n_words, b.unit, license, similarity FROM b JOIN b_best x ON x.unit = b.unit),
own AS (SELECT doc_id, path, arg_min(license, (-similarity, license)) AS license, max(similarity) AS similarity,
  path IS NOT NULL AND (regexp_matches(path, '{LICENSE_FILE}') OR bool_or({count("unit")} * 2 >= n_words)) AS is_file FROM said GROUP BY 1, 2),
places AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, min(path) AS path, arg_min(license, path) AS license FROM own WHERE is_file GROUP BY 1),
o AS (SELECT d.doc_id, d.path, license, similarity, is_file, regexp_replace(d.path, '/?[^/]*$', '') AS own_dir FROM d LEFT JOIN own ON own.doc_id = d.doc_id AND own.path = d.path),
up AS (SELECT own_dir, arg_max((p.path, p.license), length(p.dir)) AS up FROM (SELECT DISTINCT own_dir FROM o WHERE license IS NULL) q JOIN places p ON q.own_dir = p.dir OR starts_with(q.own_dir, p.dir || '/') OR p.dir = '' GROUP BY 1)
SELECT doc_id, path, coalesce(license, up[2]) AS license, CASE WHEN license IS NOT NULL THEN CASE WHEN is_file THEN 'file' ELSE 'header' END WHEN up IS NOT NULL THEN 'inherited' END AS basis, similarity,
  CASE WHEN license IS NULL THEN up[1] END AS found_in FROM o LEFT JOIN up ON up.own_dir = o.own_dir AND license IS NULL
"""
