"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

DataFrame operations alone.  Statements are the lines of a file that share a term with a template and the runs of
comment lines they are in, wherever they stand; a licence file is one statement more as a whole.  Equal statements are compared
once, however many files hold them.  Document frequencies count all distinct statements of all files and the
templates.  A file without a licence of its own takes that of the licence file in its nearest ancestor
directory, found by joins on paths, directory by directory.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

#: Least cosine of a statement to a template.
SIMILARITY = 0.5
#: Runs of comment lines.
COMMENTS = r"(?m)(?:^[ \t]*+(?:#|//|/?\*|;|--)[^\n]*+\n?)++"
LICENCE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense|notice)(?:[._-][^/]*)?$"
#: Statements by which licences are known: names, short headers and the opening of the texts.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Licensed under the ISC License."),
    ("MIT", "Distributed under the MIT license."),
    ("Apache-2.0", "Distributed under the Apache 2.0 license."),
    ("GPL-3.0", "Distributed under the GNU GPL v3."),
    ("GPL-2.0", "Distributed under the GNU GPL v2."),
    *[(x, f"SPDX-License-Identifier: {x}") for x in ("MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "AGPL-3.0", "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense", "ISC")],
]
#: Words that lines of any text share with templates; a line that has no other term of a template has no cosine worth finding.
COMMON = frozenset("a an and any are as at be by can charge conditions copy deal either endorse except file files following for form free from have hereby if in into is it its later may met modification modify name names neither nor not obtain obtaining of or person program provided published restriction sa source subject terms that the this to under use used version with without work you".split())
#: Lines with a term of a template, by a rule: all of their words of two letters or more but the common ones.
SPEAKS = r"(?i)(?:^|[^a-z0-9])(?:" + "|".join(sorted({w for _, t in TEMPLATES for w in re.findall("[a-z0-9]{2,}", t.lower())} - COMMON)) + r")(?:[^a-z0-9]|$)"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda w: w != "")


def weighted(counts: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """(key, term, w): TF-IDF weights of unit length, from counts (key, term, tf)."""
    w = counts.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norms = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norms, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def statements(files: DataFrame, whole: Column) -> DataFrame:
    """(path, statement, sid) of files (path, text): see the module's text; ``whole`` marks licence files."""
    spoken = F.filter(F.split("text", "\n"), lambda x: x.rlike(SPEAKS))
    header = F.filter(F.regexp_extract_all("text", F.lit(COMMENTS), F.lit(0)), lambda x: x.rlike(SPEAKS))
    found = F.array_distinct(F.concat(spoken, F.when(whole, F.array("text")).otherwise(header)))
    rows = files.where("text is not null").where(whole | F.col("text").rlike(SPEAKS))
    return rows.select("path", F.explode(found).alias("statement")).withColumn("sid", F.md5("statement"))


def term_counts(text: Column) -> Column:
    """[(term, tf)] of a text, in one row: runs of the sorted terms."""
    found = F.array_sort(terms(text))
    starts = lambda t: F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1)))
    runs = lambda t, s: F.transform(s, lambda x, i: F.struct(F.get(t, x).alias("term"), (F.coalesce(F.get(s, i + 1), F.size(t)) - x).cast("long").alias("tf")))
    counted = F.transform(F.array(found), lambda t: F.transform(F.array(starts(t)), lambda s: runs(t, s))[0])[0]
    return F.when(F.size(found) > 0, counted)


def recognised(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(sid, license, similarity) of those at SIMILARITY or more, over distinct statements.

    Statements are numbered, so that neither a text nor its digest is repeated for each of its terms; their terms go
    once to the weights and once back to the statement, where lengths and cosines are summed in one place.
    """
    spark = found.sparkSession
    distinct = found.groupBy("sid").agg(F.first("statement").alias("statement"))
    distinct = scratch.write(distinct.select("sid", F.monotonically_increasing_id().alias("id"), term_counts(F.col("statement")).alias("counts")), "statements")
    templates = spark.createDataFrame([(i, *t) for i, t in enumerate(TEMPLATES)], "template int, license string, words string")
    ours = distinct.select("id", F.explode("counts").alias("c")).select("id", "c.term", "c.tf")
    theirs = templates.select("template", F.explode(term_counts(F.col("words"))).alias("c")).select("template", "c.term", "c.tf")
    n = distinct.count() + len(TEMPLATES)
    df = ours.select("term").unionByName(theirs.select("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = scratch.write(df.select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf")), "idf")
    # Every term of a statement counts for its length; only terms of templates, numbered by ``t``, meet them.
    terms_of = sorted({w for _, t in TEMPLATES for w in re.split("[^a-z0-9]+", t.lower()) if w})
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(terms_of)), "t int, term string"))
    known = scratch.write(weighted(theirs, idf, "template").join(numbers, "term").select("t", "template", F.col("w").alias("x")), "templates")
    weights = ours.join(idf.join(numbers, "term", "left"), "term").select("id", "t", (F.col("tf") * F.col("idf")).alias("w"))
    whole = weights.repartition("id").groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.when(F.col("t").isNotNull(), F.struct("t", "w"))).alias("hits"))
    pairs = whole.select("id", "norm", F.explode("hits").alias("h")).select("id", "norm", "h.t", "h.w").join(F.broadcast(known), "t")
    cosines = pairs.groupBy("id", "template").agg(F.sum(F.col("w") / F.col("norm") * F.col("x")).alias("cosine")).where(F.col("cosine") >= SIMILARITY)
    best = cosines.join(F.broadcast(templates), "template").groupBy("id").agg(F.max(F.struct(F.round("cosine", 9).alias("cosine"), (-F.col("template")).alias("t"), "license")).alias("best"))
    best = scratch.write(best.select("id", F.col("best.license").alias("license"), F.col("best.cosine").alias("similarity")), "best")
    return distinct.select("id", "sid").join(best, "id").select("sid", "license", "similarity")


def scan(files: DataFrame) -> DataFrame:
    """(path, license, similarity, origin, licence_dir) of every file (path, text).

    origin is own (a statement of the file itself), inherited (from licence_dir, the nearest directory at or
    above the file's whose licence file has a licence), or none.  The best statement of a file counts, ties
    to the greatest name; of licence files in one directory the most similar, ties to the least name.
    Null and empty texts have no statement, but inherit; a null path inherits nothing; repeated paths give
    repeated rows with the licence of all their texts; other columns are ignored.
    """
    scratch = Scratch(files.sparkSession, "licenses")
    rows = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    name = F.element_at(F.split("path", "/"), -1)
    found = scratch.write(statements(rows, F.coalesce(name.rlike(LICENCE_FILE), F.lit(False))), "found")
    known = recognised(found, scratch)
    own = found.where("path is not null").select("path", "sid").join(known, "sid").groupBy("path").agg(F.max(F.struct("similarity", "license")).alias("own"))
    own = scratch.write(own.select("path", "own.license", "own.similarity"), "own")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    given = own.where(F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE)).groupBy(folder.alias("dir")).agg(F.min(F.struct((-F.col("similarity")).alias("s"), "path", "license")).alias("g"))
    given = scratch.write(given.select("dir", F.col("g.license").alias("license"), (-F.col("g.s")).alias("similarity")), "given")
    paths = scratch.write(rows.select("path", folder.alias("dir")), "paths")
    dirs = paths.where("dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", F.lit(0)).otherwise(F.size(parts))), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("up")))
    ups = dirs.select("dir", F.explode(above).alias("u")).select("dir", "u.depth", F.col("u.up").alias("up"))
    taken = ups.join(given, ups["up"] == given["dir"]).groupBy(ups["dir"]).agg(F.max(F.struct("depth", "up", "license", "similarity")).alias("g"))
    taken = scratch.write(taken.select("dir", F.col("g.license").alias("l2"), F.col("g.similarity").alias("s2"), F.col("g.up").alias("up")), "taken")
    out = paths.join(own, "path", "left").join(taken, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        "path",
        F.coalesce("license", "l2").alias("license"),
        F.coalesce("similarity", "s2").alias("similarity"),
        F.when(mine, "own").when(F.col("l2").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("up")).alias("licence_dir"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """(doc_id, path, text): documents laid out as source/thousands/hundreds/name, each hundredth a LICENSE."""
    i = F.col("doc_id")
    name = F.when(i % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(i / 1000).cast("string"), F.floor(i / 100).cast("string"), name)
    return docs.select(i.alias("doc_id"), F.when(i.isNotNull(), path).alias("path"), "text")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths; document_paths lays them out, so that each path holds one document."""
    rows = document_paths(table(spark, sf_dir, "documents"))
    name = F.element_at(F.split("path", "/"), -1)
    hundred = F.element_at(F.split("path", "/"), -2).cast("long")
    ids = F.when(name == "LICENSE", hundred * 100).otherwise(F.regexp_extract(name, "^([0-9]+)", 1).cast("long"))
    return scan(rows).select(ids.alias("doc_id"), "path", "license", "similarity", "origin", "licence_dir")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL = f"""WITH tpl(template, license, words) AS (VALUES {", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(TEMPLATES))}),
d AS (SELECT doc_id, text, coalesce(source, 'none') || '/' || (doc_id // 1000) || '/' || (doc_id // 100) || '/' || CASE WHEN doc_id % 100 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS path FROM documents),
st AS (SELECT path, s FROM (SELECT path, unnest(string_split(text, chr(10))) AS s FROM d) WHERE regexp_matches(s, {_quoted(SPEAKS)})
  UNION SELECT path, s FROM (SELECT path, unnest(regexp_extract_all(text, {_quoted(COMMENTS.replace("*+", "*").replace("++", "+"))})) AS s FROM d WHERE path NOT LIKE '%/LICENSE') WHERE regexp_matches(s, {_quoted(SPEAKS)})
  UNION SELECT path, text FROM d WHERE path LIKE '%/LICENSE' AND text IS NOT NULL),
ds AS (SELECT DISTINCT s FROM st), total AS (SELECT count(*) + {len(TEMPLATES)} AS n FROM ds),
ours AS (SELECT s, w, count(*) AS tf FROM (SELECT s, unnest(regexp_split_to_array(lower(s), '[^a-z0-9]+')) AS w FROM ds) WHERE w <> '' GROUP BY s, w),
theirs AS (SELECT template, w, count(*) AS tf FROM (SELECT template, unnest(regexp_split_to_array(lower(words), '[^a-z0-9]+')) AS w FROM tpl) WHERE w <> '' GROUP BY template, w),
idf AS (SELECT w, ln((1.0::DOUBLE + any_value(n)) / (1.0::DOUBLE + count(*))) + 1.0 AS idf FROM (SELECT w FROM ours UNION ALL SELECT w FROM theirs), total GROUP BY w),
a AS (SELECT s, w, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY s)) AS x FROM ours JOIN idf USING (w)),
b AS (SELECT template, w, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS x FROM theirs JOIN idf USING (w)),
c AS (SELECT s, template, round(sum(a.x * b.x), 9) AS cosine FROM a JOIN b USING (w) GROUP BY s, template HAVING sum(a.x * b.x) >= {SIMILARITY}),
known AS (SELECT s, license, cosine AS similarity FROM c JOIN tpl USING (template) QUALIFY row_number() OVER (PARTITION BY s ORDER BY cosine DESC, template) = 1),
own AS (SELECT path, license, similarity FROM st JOIN known USING (s) QUALIFY row_number() OVER (PARTITION BY path ORDER BY similarity DESC, license DESC) = 1),
given AS (SELECT regexp_replace(path, '/[^/]*$', '') AS dir, license, similarity FROM own WHERE path LIKE '%/LICENSE'),
taken AS (SELECT d.path, g.dir, g.license, g.similarity FROM d JOIN given g ON starts_with(d.path, g.dir || '/') QUALIFY row_number() OVER (PARTITION BY d.path ORDER BY length(g.dir) DESC) = 1)
SELECT d.doc_id, d.path, coalesce(own.license, taken.license) AS license, coalesce(own.similarity, taken.similarity) AS similarity,
  CASE WHEN own.path IS NOT NULL THEN 'own' WHEN taken.path IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin, CASE WHEN own.path IS NULL THEN taken.dir END AS licence_dir
FROM d LEFT JOIN own ON own.path = d.path LEFT JOIN taken ON taken.path = d.path"""
