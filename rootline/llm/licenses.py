"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

The vocabulary is that of the templates; a term's weight is its count times ln((1 + N) / (1 + df)) + 1, with the number
of documents that hold it counted over all documents. What is compared are runs of 12 and of 40 words (``RUNS``), each beginning half
a run after the last, of every line and of the whole text, so that short and long notices are found in long lines and over
line breaks; a licence file is compared as a whole too. A template only counts where all its own words (``MUST``) stand in the run, so
that a licence without a template isn't given its neighbour's name; a text without the first of them for any template
can match nothing and is passed over. A file without a licence of its own takes that of the licence file in the nearest
directory above it. Directories are joined as distinct paths, so that a directory with very many files costs one row.

Only DataFrame functions run here. What reaches the driver is one count for each template term, which are fixed.

Defined cases: null and empty texts match nothing; a null path inherits nothing; of equal scores the template with the
least name wins; several licence files of a directory: the best score, then the least name, then the least path;
repeated rows are rows of their own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootline.llm.common import stored, text_marks, text_or_empty

#: Notices and opening words of common licences, with the words that a match needs, the most telling one
#: first; the part of a name before the slash is the licence.
_NOTICES = {
    "AGPL-3.0/notice": ("gnu affero general public license version 3", "affero 3"),
    "Apache-2.0/notice": ("licensed under the apache license version 2.0", "apache 2.0"),
    "Apache-2.0/text": ("apache license version 2.0 you may not use this file except in compliance with the license", "apache 2.0 compliance"),
    "BSD-2-Clause/notice": ("bsd 2-clause license", "bsd 2-clause"),
    "BSD-3-Clause/notice": ("bsd 3-clause license", "bsd 3-clause"),
    "BSD-3-Clause/text": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "endorse contributors neither"),
    "CC-BY-4.0/text": ("creative commons attribution 4.0 international license", "commons attribution 4.0"),
    "CC-BY-NC-4.0/notice": ("licensed under cc by-nc 4.0", "by-nc 4.0"),
    "CC-BY-NC-4.0/text": ("creative commons attribution noncommercial 4.0 international public license", "noncommercial commons 4.0"),
    "CC-BY-SA-4.0/text": ("creative commons attribution sharealike 4.0 international license", "sharealike commons 4.0"),
    "CC0-1.0/notice": ("cc0 1.0 universal public domain dedication", "cc0 1.0"),
    "EPL-2.0/notice": ("eclipse public license version 2.0", "eclipse 2.0"),
    "GPL-2.0/notice": ("this work is licensed under the gnu general public license version 2", "gnu general 2"),
    "GPL-3.0/notice": ("this work is licensed under the gnu general public license version 3", "gnu general 3"),
    "GPL-3.0/text": ("gnu general public license version 3 free software foundation you can redistribute it", "gnu general 3 redistribute"),
    "ISC/text": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "fee permission hereby"),
    "LGPL-2.1/notice": ("gnu lesser general public license version 2.1", "lesser gnu 2.1"),
    "LGPL-3.0/notice": ("gnu lesser general public license version 3", "lesser gnu 3"),
    "MIT/notice": ("released under the mit license", "mit license"),
    "MIT/text": ("mit license permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby charge person obtaining"),
    "MPL-2.0/notice": ("mozilla public license version 2.0", "mozilla 2.0"),
    "Unlicense/text": ("this is free and unencumbered software released into the public domain", "unencumbered domain"),
}
_NAMES = sorted({n.split("/")[0] for n in _NOTICES})
TEMPLATES = {n: t for n, (t, _) in _NOTICES.items()} | {f"{n}/tag": f"spdx-license-identifier {n.lower()}" for n in _NAMES}
MUST = {n: m.split() for n, (_, m) in _NOTICES.items()} | {f"{n}/tag": [n.lower(), "spdx-license-identifier"] for n in _NAMES}
WORD = r"[a-z0-9][a-z0-9+-]*(?:\.[0-9]+)?"
LICENSE_FILE = r"(?i)(?:^|/)(?:licen[sc]e|copying)[^/]*$"
RUNS = (12, 40)  # words; twice a short notice and twice the longest template


def _words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def template_weights(df: dict[str, int], n: int, templates: dict[str, str] = TEMPLATES) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """idf of each term, and each template as a vector of length 1."""
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for text in templates.values() for t in _words(text)}
    vectors = {}
    for name, text in templates.items():
        v = {t: c * idf[t] for t, c in Counter(_words(text)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors[name] = {t: x / size for t, x in v.items()}
    return idf, vectors


def _tokens(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _run(at: Column, run: int) -> Column:
    return F.struct(at.alias("at"), F.lit(run).alias("run"), F.slice("words", at + 1, F.lit(run)).alias("words"))


def units(texts: DataFrame, keys: list[str], anchors: Column) -> DataFrame:
    """(keys, text, whole: a licence file) -> (keys, piece, at, run, words): the runs of each line and of the whole text that may match."""
    lines = F.split("text", "\n", -1)
    pieces = F.when(F.size(lines) > 1, F.concat(lines, F.array("text"))).otherwise(lines)
    rows = texts.select(*keys, "whole", F.size(pieces).alias("n"), F.posexplode(pieces).alias("piece", "text"))
    rows = rows.select(*keys, "piece", (F.col("whole") & (F.col("piece") == F.col("n") - 1)).alias("whole"), _tokens("text").alias("words")).where(F.arrays_overlap("words", anchors))

    def starts(run: int) -> Column:
        last = F.greatest(F.ceil((F.size("words") - run) / (run // 2)), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: _run(i * (run // 2), run))

    short, long = RUNS
    own = F.when(F.size("words") > short, F.concat(starts(short), starts(long))).otherwise(starts(short))
    own = F.when(F.col("whole"), F.concat(own, F.array(_run(F.lit(0), 2**31 - 1)))).otherwise(own)
    # cut inside the row, so that no copy of a long text goes with each of its runs
    return rows.select(*keys, "piece", F.explode(F.filter(own, lambda r: F.arrays_overlap(r["words"], anchors))).alias("r")).select(*keys, "piece", "r.*")


def scores(runs: DataFrame, keys: list[str], idf: dict[str, float], vectors: dict[str, dict[str, float]], must: dict[str, list[str]] = MUST) -> DataFrame:
    """runs (keys, piece, at, run, words) -> (keys, piece, at, run, template, score) by the cosine over the templates' vocabulary."""
    spark, unit = runs.sparkSession, [*keys, "piece", "at", "run"]
    weight = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))  # as long as the templates
    parts = [(n, t, x, int(t in must[n]), len(must[n])) for n, v in vectors.items() for t, x in v.items()]
    parts = F.broadcast(spark.createDataFrame(parts, "template string, term string, w double, own int, needed int"))
    terms = runs.select(*unit, F.explode("words").alias("term")).join(weight, "term").groupBy(*unit, "term", "idf").agg(F.count(F.lit(1)).alias("tf"))
    weighed = terms.withColumn("x", F.col("tf") * F.col("idf"))
    size = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(*unit)))
    found = weighed.withColumn("size", size).join(parts, "term").groupBy(*unit, "template", "needed").agg(F.sum(F.col("x") * F.col("w") / F.col("size")).alias("score"), F.sum("own").alias("own"))
    return found.where("own = needed").drop("own", "needed")


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(folders: DataFrame, granted: DataFrame) -> DataFrame:
    """folders (folder), granted (folder, license) -> (folder, license, source): the nearest folder at or above it that grants."""
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    steps = folders.select("folder").distinct().select("folder", F.posexplode(above).alias("depth", "source"))
    steps = steps.where((F.col("depth") == 0) | (F.col("source") != "") | (F.col("folder") != ""))
    hit = steps.join(granted.select(F.col("folder").alias("source"), "license"), "source")
    return hit.groupBy("folder").agg(F.max_by(F.struct("license", "source"), "depth").alias("b")).select("folder", "b.license", "b.source")


def scan(files: DataFrame, threshold: float = 0.6) -> DataFrame:
    """files (doc_id, path, text) -> (doc_id, path, own_license, score, license, inherited_from) for each file."""
    keys = ["r1", "r2"]
    # rows that share id, path and text are alike; their name is two hashes of the three
    rid = [F.xxhash64("doc_id", "path", *text_marks()).alias("r1"), F.xxhash64(F.lit(1), "doc_id", "path", *text_marks()).alias("r2")]
    base = files.select("doc_id", "path", text_or_empty().alias("text"))
    vocabulary = sorted({t for x in TEMPLATES.values() for t in _words(x)})
    present = F.array_intersect(_tokens("text"), F.array(*map(F.lit, vocabulary)))
    counted = base.select(F.explode(present).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf, vectors = template_weights({r.term: r.df for r in counted.collect()}, base.count())
    anchors = F.array(*[F.lit(t) for t in sorted({m[0] for m in MUST.values()})])

    named = base.select(*rid, "doc_id", "path", "text")
    may = named.where(F.arrays_overlap(_tokens("text"), anchors)).select(*keys, "text", F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False)).alias("whole"))
    found = scores(units(may, keys, anchors), keys, idf, vectors).withColumn("score", F.round("score", 6)).where(F.col("score") >= threshold)
    best = found.groupBy(*keys).agg(F.min(F.struct((-F.col("score")).alias("s"), "template")).alias("b")).select(*keys, F.split_part("b.template", F.lit("/"), F.lit(1)).alias("own_license"), (-F.col("b.s")).alias("score"))
    best = stored(best, "license-own").df

    rows = named.select(*keys, "doc_id", "path").join(best, keys, "left").drop(*keys).withColumn("folder", _folder(F.col("path")))
    rows = stored(rows, "license-files").df
    grants = rows.where(F.col("own_license").isNotNull() & F.col("path").rlike(LICENSE_FILE))
    granted = grants.groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "own_license", "path")).alias("b")).select("folder", F.col("b.own_license").alias("license"))
    near = inherited(rows.where("folder is not null"), granted).withColumnRenamed("license", "near")
    out = rows.join(near, "folder", "left")
    return out.select("doc_id", "path", "own_license", "score", F.coalesce("own_license", "near").alias("license"), F.when(F.col("own_license").isNull(), F.col("source")).alias("inherited_from"))


def query_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source/lang/bucket/id.txt; of those that start with a word of licensing every fourth id is the
    LICENSE file of its source, language or bucket folder."""
    folder = [F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.concat(F.lit("b"), F.floor(F.col("doc_id") / 100).cast("string"))]
    notice = F.coalesce(F.col("text").rlike(r"(?i)^[^\n]*\blicen[sc]ed?\b"), F.lit(False)) & (F.col("doc_id") % 4 == 0)
    level = F.when(F.col("doc_id") % 12 == 0, folder[0]).when(F.col("doc_id") % 12 == 4, F.concat_ws("/", *folder[:2])).otherwise(F.concat_ws("/", *folder))
    path = F.when(notice, F.concat(level, F.lit("/LICENSE"))).otherwise(F.concat_ws("/", *folder, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    return docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")
