"""Licence scan: TF-IDF cosines of passages to templates, and inheritance from the nearest directory above.

Passages of a file are its lines, its header (the comment lines that it starts with, as one text) and the whole file. A
term weighs tf * (ln((1 + N) / (1 + df)) + 1), where df counts the files that hold it; terms outside all templates
weigh as terms of no file. The cosine of a passage and a template is a sparse product over the template's terms.

Only passages that hold an anchor are weighed. Anchors are terms of each template, heavy ones that few files hold, as many as
it takes for the others to make less than the threshold of its length: by Cauchy-Schwarz no passage without one can reach it.
So the filter loses nothing, and almost all text stays out of the shuffles.

A file's own licence is that of its best line or header. A file is a licence file if its name says so or if it is, as a
whole and without a comment header, near a template; the best licence file of a directory names the directory's licence. A file without a licence of its
own takes that of the nearest directory above it that has one, found by joining paths: each distinct directory is joined
by its ancestors, never file by file. Built-in functions only; templates and vocabulary are fixed, so their
broadcasts are bounded.

Defined results: a NULL text has no licence, a NULL path counts as the empty path. Rows that repeat a path are one file: it
gets the best of their licences. Ties between templates go to the first of the list, between files of a directory to the
smaller path. An empty table gives an empty result. Input columns named like those that are added are replaced.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import col, without, written
from tidemark.llm.license_texts import MORE

#: Least cosine of a line or header, and of a whole file that counts as a licence file.
LINE, WHOLE = 0.6, 0.5

# Short forms and openings of public licences, then full texts, notices, titles and SPDX tags.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                "your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
                "your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *MORE,
]
TERM = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
NAME = r"(?i)^(licen[cs]e|copying|unlicense)([.\-_].*)?$"
HEADER = r"\A(?:[ \t]*(?:#|//|/\*|\*|--|;|%|<!--)[^\n]*(?:\n|\z))+"
# The same patterns for Java, whose repeated groups recurse once per repeat unless they give nothing back.
TERM_ONCE = r"[a-z0-9]++(?:[.\-][a-z0-9]++)*+"
HEADER_ONCE = r"\A(?:[ \t]*+(?:#|//|/\*|\*|--|;|%|<!--)[^\n]*+(?:\n|\z))++"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_ONCE), F.lit(0))


def directory(path: Column) -> Column:
    """The folder of a path, without the last slash; empty at the top."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def ancestors(folder: Column) -> Column:
    """The folder itself and all above it, the nearest first, down to the empty one."""
    parts = F.filter(F.split(folder, "/", -1), lambda x: x != "")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.concat_ws("/", F.slice(parts, 1, n - i)))


def _templates(spark: SparkSession) -> DataFrame:
    """(template, license, term, tf)."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text"))
                     for i, (name, text) in enumerate(TEMPLATES)])
    return (spark.range(1, numPartitions=1).select(F.inline(rows))
            .select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
            .groupBy("template", "license", "term").agg(F.count("*").alias("tf")))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", line: float = LINE,
         whole: float = WHOLE) -> DataFrame:
    """All rows and columns, with own_license, own_score, is_license_file, inherited_from and license."""
    spark = files.sparkSession
    # tables over the terms of the templates have some thousand rows, and lie in one file
    model = written(_templates(spark).coalesce(1), "license-templates")
    vocabulary = model.select("term").distinct().union(spark.range(1).select(F.lit(None).cast("string"))).toDF("known")
    texts = files.select(F.coalesce(col(path_col), F.lit("")).alias("path"), col(text_col).alias("text"))
    held = texts.select(F.explode(F.concat(
        F.coalesce(F.array_distinct(terms(F.col("text"))), F.array().cast("array<string>")),
        F.array(F.lit(None).cast("string")))).alias("term"))
    # one count for each term of the templates, and the number of files under the NULL term
    df = (held.join(F.broadcast(vocabulary), F.col("term").eqNullSafe(F.col("known")), "left_semi")
          .groupBy("term").agg(F.count("*").alias("df")))
    df = written(df.coalesce(1), "license-df")
    counted = df.filter("term is null").first()
    n = counted["df"] if counted else 0
    rarest = math.log(1.0 + n) + 1.0
    weight = F.log(F.lit(1.0 + n) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    weighed = written(model.join(F.broadcast(df.filter("term is not null")), "term", "left").select(
        "template", "license", "term", F.coalesce("df", F.lit(0)).alias("df"), weight.alias("idf"),
        (F.col("tf") * weight).alias("w")).coalesce(1), "license-weights")
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    heavy = [[(x.w, x.term, x.df) for x in r.ws] for r in
             weighed.groupBy("template").agg(F.collect_list(F.struct("w", "term", "df")).alias("ws")).collect()]

    def holds_for(least):
        return _any_of(sorted({t for weights in heavy for t in _anchors(weights, least)}))

    of_line, of_file = holds_for(line), holds_for(whole)
    text = F.col("text")
    header = F.regexp_extract(text, HEADER_ONCE, 0)
    # a file that starts with comments is source, and only its header speaks for the whole
    passages = F.concat(
        F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(F.lit("line").alias("kind"), i.alias("no"), x.alias("text"))),
        F.array(F.when(header == "", F.struct(F.lit("file").alias("kind"), F.lit(0).alias("no"), text.alias("text")))
                .otherwise(F.struct(F.lit("line").alias("kind"), F.lit(-1).alias("no"), header.alias("text")))))
    held_by_kind = F.when(F.col("kind") == "file", of_file(F.col("text"))).otherwise(of_line(F.col("text")))
    # passages are dealt out once, as texts: all that follows, up to one row for each, stays where they are
    found = (texts.filter(of_line(text) | of_file(text)).select("path", F.xxhash64("text").alias("of"), F.explode(passages).alias("p"))
             .select("path", "of", "p.kind", "p.no", "p.text").filter(held_by_kind)
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "of", "kind", "no"))
    counted = (found.select("path", "of", "kind", "no", F.explode(terms(F.col("text"))).alias("term"))
               .groupBy("path", "of", "kind", "no", "term").agg(F.count("*").alias("tf")))
    postings = weighed.join(norms, "template").groupBy("term").agg(
        F.first("idf").alias("idf"),
        F.collect_list(F.struct("template", "license", (F.col("w") / F.col("norm")).alias("w"))).alias("in"))
    valued = counted.join(F.broadcast(postings), "term", "left").withColumn(
        "v", F.col("tf") * F.coalesce("idf", F.lit(rarest)))
    passage = ["path", "of", "kind", "no"]
    # one row per passage and template, and one under template NULL for the passage's length
    products = (valued.select(*passage, "v", F.explode(F.concat(
        F.coalesce("in", F.array().cast(postings.schema["in"].dataType)),
        F.array(F.struct(F.lit(None).cast("int").alias("template"), F.lit(None).cast("string").alias("license"),
                         F.col("v").alias("w"))))).alias("t"))
        .groupBy(*passage, "t.template", "t.license").agg(F.sum(F.col("v") * F.col("t.w")).alias("dot"))
        .groupBy(*passage).agg(
            F.sqrt(F.sum(F.when(F.col("template").isNull(), F.col("dot")))).alias("norm"),
            F.max(F.when(F.col("template").isNotNull(), F.struct(
                F.round("dot", 9).alias("dot"), (-F.col("template")).alias("order"), "license"))).alias("best")))
    scored = products.select("path", "kind", F.col("best.license").alias("license"),
                             F.round(F.col("best.dot") / F.col("norm"), 6).alias("score"), F.col("best.order").alias("o"))

    def best(kind, least):
        return F.max(F.when((F.col("kind") == kind) & (F.col("score") >= least), F.struct("score", "o", "license")))

    judged = written(scored.groupBy("path").agg(best("line", line).alias("own"), best("file", whole).alias("file"))
                     .filter("own is not null or file is not null")
                     .select("path", "own", F.coalesce("file", "own").alias("file"), F.col("file").isNotNull().alias("by_text")),
                     "license-judged")
    name = F.regexp_extract("path", "[^/]*$", 0)
    license_files = judged.filter(F.col("by_text") | name.rlike(NAME))
    of_folder = (license_files.withColumn("folder", directory(F.col("path"))).groupBy("folder").agg(F.min(F.struct(
        (-F.col("file.score")).alias("a"), "path", F.col("file.license").alias("license"))).alias("f"))
        .select("folder", F.col("f.license").alias("license")))
    folders = texts.select(directory(F.col("path")).alias("folder")).distinct()
    above = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("up", "ancestor"))
    inherited = written(
        above.join(of_folder.withColumnRenamed("folder", "ancestor"), "ancestor").groupBy("folder")
        .agg(F.min(F.struct("up", "ancestor", "license")).alias("i"))
        .select(F.col("folder").alias("i_folder"), F.col("i.ancestor").alias("i_from"), F.col("i.license").alias("i_license")),
        "license-inherited")
    own = judged.select(F.col("path").alias("j_path"), "own", (F.col("by_text") | F.regexp_extract("path", "[^/]*$", 0)
                                                              .rlike(NAME)).alias("j_file"))
    kept = without(files, "own_license", "own_score", "is_license_file", "inherited_from", "license").columns
    packed = files.select(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)]).alias("row"),
                          F.coalesce(col(path_col), F.lit("")).alias("key"))
    with_own = packed.join(own, F.col("key") == F.col("j_path"), "left")
    out = with_own.join(inherited, directory(F.col("key")) == F.col("i_folder"), "left")
    inherits = F.col("own").isNull() & F.col("i_license").isNotNull()
    return out.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], F.col("own.license").alias("own_license"), F.col("own.score").alias("own_score"),
        F.coalesce("j_file", F.lit(False)).alias("is_license_file"), F.when(inherits, F.col("i_from")).alias("inherited_from"),
        F.coalesce("own.license", F.when(inherits, F.col("i_license"))).alias("license"))


def _anchors(weights: list[tuple[float, str, int]], least: float) -> list[str]:
    """Terms of a template whose others make less than ``least`` of its length: those with most weight for each file that holds them."""
    left = total = sum(w * w for w, _, _ in weights)
    out = []
    for w, term, _ in sorted(weights, key=lambda x: (x[0] * x[0] / (x[2] + 1), x[1]), reverse=True):
        if left < (least - 1e-6) ** 2 * total:
            break
        out.append(term)
        left -= w * w
    return out


def _any_of(words: list[str]):
    """Does a text hold one of these terms, as a term or as part of one?"""
    pattern = r"(?i)(?<![a-z0-9])" + _one_of(words) + r"(?![a-z0-9])"  # not \b: an underscore is no part of a term
    return lambda text: text.rlike(pattern)


def _one_of(words: list[str]) -> str:
    """A pattern of these words that goes letter by letter, so that its cost does not follow their number."""
    after: dict[str, list[str]] = {}
    for w in words:
        if w:
            after.setdefault(w[0], []).append(w[1:])
    tails = [re.escape(c) + _one_of(rest) for c, rest in sorted(after.items())]
    if not tails:
        return ""
    return "(?:" + "|".join(tails) + ")" + ("?" if "" in words else "")
