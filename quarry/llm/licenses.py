"""License scan: TF-IDF cosine of lines to licence phrases, then inheritance from the nearest directory.

Each line or sentence of a file is a sparse vector of its words' counts times their
inverse document frequency, counted over all files; it matches the phrase with the
highest cosine, from a threshold up.  Only lines that hold an anchor word are
scored: what a phrase weighs without its anchors is below the threshold, so no
other line can reach it.

A file without a licence of its own takes that of the nearest directory above it
which holds a licence file: directories are joined with their ancestors' paths, and
files with their directory's answer.  All of it is DataFrame functions.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import cut

# The names and notices by which licences are declared.
PHRASES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004"],
    "MIT": ["Released under the MIT License", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "GNU General Public License Version 3, 29 June 2007"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2",
                "GNU General Public License Version 2, June 1991"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License"],
    "ISC": ["Released under the ISC License"],
    "CC0-1.0": ["Licensed under CC0 1.0 Universal, Public Domain Dedication"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
}
#: Words are runs of ASCII letters and digits, version numbers in one piece; lines end at these.
WORD, LINE_END = r"[a-z0-9]+(?:[.][0-9]+)*", r"\n|[.!?][ \t]+"
#: Least cosine of a match.
THRESHOLD = 0.75
#: Different words that a line must have in common with a phrase.
SHARED_WORDS = 2
#: A file is a licence file by its name, or if this part of its words stands in matching lines.
LICENCE_NAME, LICENCE_PART = r"(?i)^(licen[sc]e|copying|notice)([.\-_].*)?$", 0.5


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _weights(n_files: int, files_with: dict[str, int], phrases: dict[str, list[str]]) -> tuple[dict, float, list]:
    """Weight of each phrase word, that of any other word, and the unit vector (name, phrase number, word, value) rows."""
    idf = {w: math.log((1 + n_files) / (1 + files_with.get(w, 0))) + 1
           for ps in phrases.values() for p in ps for w in words_of(p)}
    other = math.log(1 + n_files) + 1
    rows, number = [], 0
    for name, ps in phrases.items():
        for p in ps:
            v = {w: n * idf[w] for w, n in Counter(words_of(p)).items()}
            size = math.sqrt(sum(x * x for x in v.values()))
            rows += [(name, number, w, x / size) for w, x in v.items()]
            number += 1
    return idf, other, rows


def _anchors(rows: list, threshold: float) -> list[str]:
    """The heaviest words of each phrase, until the rest weighs less than the threshold."""
    out = set()
    for number in {r[1] for r in rows}:
        rest = 1.0
        for _, _, w, x in sorted((r for r in rows if r[1] == number), key=lambda r: (-r[3], r[2])):
            if rest < threshold * threshold - 1e-9:
                break
            out.add(w)
            rest -= x * x
    return sorted(out)


def _constants(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals (Python rows would start Python workers)."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan_licences(files: DataFrame, phrases: dict[str, list[str]] | None = None, threshold: float = THRESHOLD,
                  path: str = "path", text: str = "text") -> DataFrame:
    """``files`` without the text, with ``licence``, ``origin``, ``score``, ``licence_dir`` and ``licences``.

    ``origin`` is 'own' where lines of the file match (``licence``: the best, then
    the first name; ``licences``: all, in order), 'inherited' where the nearest
    directory at or above the file's (``licence_dir``) holds a licence file, else
    null.  ``score`` is the best cosine to 6 digits.  Of several licence files in
    a directory the best score counts, then the first name.  A null path is the
    empty one; a null or empty text matches nothing; rows that share a path share
    their licences; columns of ``files`` with these names are replaced.
    """
    spark = files.sparkSession
    phrases = phrases or PHRASES
    made = ("licence", "origin", "score", "licence_dir", "licences")
    files = files.drop(*[c for c in made if c not in (path, text)])
    rows = files.select(F.coalesce(F.col(path), F.lit("")).alias("_path"), F.col(text).alias("_text"))

    vocabulary = sorted({w for ps in phrases.values() for p in ps for w in words_of(p)})
    known = F.array(*[F.lit(w) for w in vocabulary])
    counted = rows.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(
        F.array_intersect(_words(F.col("_text")), known), F.array().cast("array<string>")))).alias("word"))
    # one row for each word of the phrases; the empty word counts the files
    seen = {r["word"]: r["count"] for r in counted.groupBy("word").count().collect()}
    n_files = seen.pop("", 0)
    idf, other, vectors = _weights(n_files, seen, phrases)
    anchor = rf"(?i)(?<![a-z0-9])(?:{'|'.join(map(re.escape, _anchors(vectors, threshold)))})(?![a-z0-9])"

    hit = F.when(F.col("_text").rlike(anchor), F.col("_text"))
    lines = F.filter(F.split(hit, LINE_END, -1), lambda s: s.rlike(anchor))
    lined = rows.filter(F.col("_text").rlike(anchor)).select(
        "_path", F.size(_words(F.col("_text"))).alias("n_words"), F.posexplode(F.array_distinct(lines)).alias("at", "line"))
    lined = cut(lined.withColumn("line_key", F.xxhash64("_path", "at", "line")))
    word_rows = lined.select("_path", "at", "line_key", F.explode(_words(F.col("line"))).alias("word"))
    counts = word_rows.groupBy("_path", "at", "line_key", "word").agg(F.count(F.lit(1)).alias("n"))
    weight = _constants(spark, list(idf.items()), ["word", "idf"])
    unit = _constants(spark, vectors, ["name", "phrase", "word", "value"])
    weighed = counts.join(F.broadcast(weight), "word", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(other)))
    line = ["_path", "at", "line_key"]
    size = weighed.groupBy(*line).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("size"), F.sum("n").alias("line_words"))
    dots = weighed.join(F.broadcast(unit), "word").groupBy(*line, "name", "phrase").agg(
        F.sum(F.col("x") * F.col("value")).alias("dot"), F.count(F.lit(1)).alias("shared"))
    cosines = dots.join(size, line).withColumn("score", F.round(F.col("dot") / F.col("size"), 6))
    best = cosines.filter((F.col("score") >= threshold) & (F.col("shared") >= SHARED_WORDS)).groupBy(*line).agg(
        F.min(F.struct(-F.col("score"), F.col("name"), F.col("line_words"))).alias("b"))
    best = best.select("_path", "line_key", F.col("b.name").alias("name"), (-F.col("b.col1")).alias("score"),
                       F.col("b.line_words").alias("line_words"))
    length = lined.groupBy("_path").agg(F.max("n_words").alias("n_words"))
    own = best.groupBy("_path").agg(F.min(F.struct(-F.col("score"), F.col("name"))).alias("b"),
                                    F.array_sort(F.collect_set("name")).alias("licences"), F.sum("line_words").alias("in_lines"))
    own = cut(own.join(length, "_path").select("_path", F.col("b.name").alias("licence"), (-F.col("b.col1")).alias("score"),
                                               "licences", (F.col("in_lines") >= LICENCE_PART * F.col("n_words")).alias("mostly")))

    named = F.regexp_extract("_path", "([^/]*)$", 1).rlike(LICENCE_NAME)
    holders = cut(own.filter(named | F.col("mostly")).groupBy(_directory(F.col("_path")).alias("licence_dir")).agg(
        F.min(F.struct(-F.col("score"), F.col("licence"))).alias("b")).select(
        "licence_dir", F.col("b.licence").alias("from_dir")))
    directories = rows.select(_directory(F.col("_path")).alias("_dir")).distinct()
    parts = F.split("_dir", "/")
    above = directories.select("_dir", F.explode(F.when(F.col("_dir") == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))).alias("licence_dir"))
    nearest = above.join(holders, "licence_dir").groupBy("_dir").agg(
        F.max(F.struct(F.length("licence_dir"), F.col("licence_dir"), F.col("from_dir"))).alias("b"))
    nearest = cut(nearest.select("_dir", "b.licence_dir", "b.from_dir"))

    out = files.drop(text) if path != text else files
    out = out.withColumn("_path", F.coalesce(F.col(path), F.lit(""))).withColumn("_dir", _directory(F.col("_path")))
    out = out.join(own.drop("mostly"), "_path", "left").join(nearest, "_dir", "left")
    mine = F.col("licence").isNotNull()
    return (out.withColumn("origin", F.when(mine, "own").when(F.col("from_dir").isNotNull(), "inherited"))
            .withColumn("licence_dir", F.when(~mine, F.col("licence_dir")))
            .withColumn("licence", F.coalesce("licence", "from_dir")).drop("_path", "_dir", "from_dir"))
