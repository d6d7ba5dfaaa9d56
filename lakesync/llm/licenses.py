"""Licence scan: sparse TF-IDF cosine of text blocks to licence templates, then
inheritance from the nearest ancestor directory.

Each line is a block that may be a header. The inverse
document frequencies of all terms of the scored lines are taken over all
files; only lines that hold one of the terms without which no template can be
reached are scored, and of each file the best (licence, cosine) stays. A file named LICENSE, LICENCE, COPYING or NOTICE, or
that is little but a licence line (``WHOLE`` of its characters), licences its directory. Files without a
licence of their own inherit that of the nearest ancestor directory.

Null texts have no licence of their own; null paths inherit none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, stored

THRESHOLD = 0.6
WHOLE = 0.9
BROADCAST_TERMS = 100_000

# Licence identifiers and the header sentences that name them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _terms(col):
    return F.filter(F.split(lower_ascii(col), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(TEMPLATES)], "template int, license string, body string") \
        .select("template", "license", _terms(F.col("body")).alias("terms"))


def _heavy(terms, idf):
    """Terms of a template of which a block must hold one to reach the threshold:
    by Cauchy and Schwarz the cosine is at most the shared terms' part of the
    template's norm, and all other terms together have less than that."""
    squares = sorted(((terms.count(w) * idf[w]) ** 2, w) for w in set(terms))
    least, light, out = (THRESHOLD - 1e-6) ** 2 * sum(x for x, _ in squares), 0.0, []
    for x, w in squares:
        light += x
        if light >= least:
            out.append(w)
    return out


def scan(files: DataFrame) -> DataFrame:
    """path, license, cosine, origin (own, inherited or none) and license_dir of
    ``files`` (path, text)."""
    spark = files.sparkSession
    t = templates(spark)
    vocabulary = sorted({w for r in t.collect() for w in r["terms"]})  # the terms of the fixed templates
    words = F.array(*[F.lit(w) for w in vocabulary])
    f = files.select("path", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = f.count()
    known = f.select("path", F.explode(F.array_intersect(_terms(F.col("text")), words)).alias("w"))
    df = known.groupBy("path", "w").count().groupBy("w").agg(F.count("*").alias("df"))
    rows = df.select("w", F.log((F.lit(total) + 1) / (F.col("df") + 1)).alias("idf")).collect()  # one row per template term
    most = float(spark.range(1).select(F.log(F.lit(total + 1.0))).first()[0]) + 1.0
    idf = {w: most for w in vocabulary} | {r["w"]: r["idf"] + 1.0 for r in rows}
    weights = F.create_map(*[F.lit(x) for kv in sorted(idf.items()) for x in kv])
    of = lambda w: weights[w]
    heavy = F.array(*[F.lit(w) for w in sorted({w for r in t.collect() for w in _heavy(r["terms"], idf)})])
    lines = f.select("path", F.char_length(F.trim("text")).alias("n_text"), F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("path", "n_text", F.char_length(F.trim("line")).alias("n_line"), _terms(F.col("line")).alias("terms"))
    hits = stored(lines.where(F.arrays_overlap("terms", heavy)).select(
        "path", (F.col("n_line") >= WHOLE * F.col("n_text")).alias("whole"), F.array_sort("terms").alias("block")), "lines")
    distinct = hits.groupBy("path", "block").agg(F.max("whole").alias("whole")).withColumn("shared", F.array_intersect("block", words))
    blocks = distinct.groupBy("block").agg(F.first("shared").alias("shared"))
    tf = lambda terms, w: F.size(F.filter(terms, lambda x: x == w))
    square = lambda terms, known: F.aggregate(known, F.lit(0.0), lambda a, w: a + F.pow(tf(terms, w) * of(w), F.lit(2.0)))
    t = stored(t.select("template", "license", "terms", F.sqrt(square(F.col("terms"), F.array_distinct("terms"))).alias("t_norm"),
                        F.explode(F.array_distinct("terms")).alias("w")).select("template", "license", "t_norm", "w", (tf(F.col("terms"), F.col("w")) * of(F.col("w"))).alias("t_weight")), "templates")
    # terms of no template weigh 1 at least, which bounds the cosine from above
    # before their document frequencies are known
    others = F.array_except("block", words)
    light = blocks.withColumn("least", F.size(others)).withColumn("mass", square(F.col("block"), F.col("shared"))) \
        .where(F.col("mass") >= THRESHOLD ** 2 * (F.col("mass") + F.col("least")))
    dots = light.select("block", "mass", "least", F.explode("shared").alias("w")).withColumn("b", tf(F.col("block"), F.col("w")) * of(F.col("w"))) \
        .join(F.broadcast(t), "w").groupBy("block", "mass", "least", "template", "license", "t_norm").agg(F.sum(F.col("b") * F.col("t_weight")).alias("dot"))
    near = stored(dots.where(F.col("dot") >= (THRESHOLD - 1e-6) * F.col("t_norm") * F.sqrt(F.col("mass") + F.col("least")))
                  .select("block", "mass", "template", "license", "t_norm", "dot"), "near")
    # tf-idf of the other terms, by their document frequencies over all files
    extra = stored(near.select("block").distinct().select("block", F.explode(others).alias("w")).withColumn("n", tf(F.col("block"), F.col("w"))), "extra")
    sought = stored(extra.select("w").distinct(), "sought")
    sought = F.broadcast(sought) if sought.count() <= BROADCAST_TERMS else sought
    held = f.select("path", F.explode(F.array_distinct(_terms(F.col("text")))).alias("w")).join(sought, "w", "left_semi")
    df = held.groupBy("path", "w").count().groupBy("w").agg((F.log((F.lit(total) + 1) / (F.count("*") + 1)) + 1).alias("idf"))
    rest = extra.join(df, "w").groupBy("block").agg(F.sum(F.pow(F.col("n") * F.col("idf"), F.lit(2.0))).alias("rest"))
    scored = near.join(rest, "block", "left").withColumn("norm", F.sqrt(F.col("mass") + F.coalesce("rest", F.lit(0.0)))) \
        .withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 9)).where(F.col("cosine") >= THRESHOLD)
    best = scored.groupBy("block").agg(F.max(F.struct("cosine", (-F.col("template")).alias("t"), "license")).alias("top"))
    own = stored(distinct.join(best, "block").groupBy("path").agg(F.max(F.struct("top", "whole")).alias("m")).select(
        "path", F.col("m.top.license").alias("license"), F.col("m.top.cosine").alias("cosine"), F.col("m.whole").alias("whole")), "own")
    return inherit(f.select("path"), own)


def _directories(path):
    """Ancestor directories, the root '' included, with their depth."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir")))


def inherit(files: DataFrame, own: DataFrame) -> DataFrame:
    """Own licences, else the nearest ancestor directory's, by joins on the
    directories: distinct directories first, so files join once."""
    named = F.element_at(F.split("path", "/"), -1).rlike(r"(?i)^(licen[cs]e|copying|notice)(\.|$)")
    holder = own.where(named | F.col("whole")).withColumn("dir", F.element_at(_directories(F.col("path")), -1)["dir"])
    holder = holder.groupBy("dir").agg(F.max(F.struct("cosine", "license")).alias("h")).select("dir", F.col("h.license").alias("dir_license"))
    f = files.withColumn("dir", F.when(F.col("path").isNotNull(), F.element_at(_directories(F.col("path")), -1)["dir"]))
    dirs = f.select(F.col("dir").alias("at")).where("at is not null").distinct()
    up = dirs.select("at", F.explode(F.when(F.col("at") == "", F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("dir")))).otherwise(
        F.concat(_directories(F.col("at")), F.array(F.struct(F.size(F.split("at", "/")).alias("depth"), F.col("at").alias("dir")))))).alias("a"))
    nearest = up.select("at", "a.depth", "a.dir").join(holder, "dir").groupBy("at").agg(
        F.max(F.struct("depth", "dir", "dir_license")).alias("n")).select(F.col("at").alias("dir"), F.col("n.dir").alias("license_dir"), F.col("n.dir_license").alias("dir_license"))
    joined = f.join(own.select("path", "license", "cosine"), "path", "left").join(F.broadcast(nearest) if nearest.count() <= 10_000 else nearest, "dir", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none")
    return joined.select("path", F.coalesce("license", "dir_license").alias("license"), "cosine", origin.alias("origin"),
                         F.when(F.col("license").isNull(), F.col("license_dir")).alias("license_dir"))
