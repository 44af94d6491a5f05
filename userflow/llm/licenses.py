"""License scans by MinHash bands over overlapping windows, in DataFrame
functions only.

A template of m words is sought in windows of 2m words, one every m words: an
occurrence lies whole in some window.  Windows and templates are sets of
5-word shingles (hashes); a window that holds the share ``CONTAINMENT`` of a
template's shingles has a Jaccard similarity J with it of at least about 1/6
(shortest templates) to 1/3.  ``BANDS`` bands of one minimum each meet with
probability 1 - (1 - J)^BANDS, over 0.9999 even at J = 1/6.  Windows that share
a band with a template are compared exactly.

Texts without any template shingle, and such windows, cannot pass the exact
comparison; they are left out before the bands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS = 64

#: Notices as they are written in files and pages.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def _words_sql(text: str) -> str:
    return f"array_remove(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), '')"


def _shingles_sql(words: str, k: int) -> str:
    run = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return (f"CASE WHEN size({words}) < {k} THEN cast(array() as array<bigint>) "
            f"ELSE transform(sequence(0, size({words}) - {k}), i -> xxhash64({run})) END")


def _bands_sql(shingles: str, bands: int) -> str:
    return (f"transform(sequence(0, {bands - 1}), j -> struct(j as band, "
            f"array_min(transform({shingles}, h -> xxhash64(h, j))) as low))")


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                   k: int = SHINGLE_WORDS) -> DataFrame:
    """(license, n_words, shingles): templates of at least ``k`` words."""
    rows = spark.createDataFrame(list(templates), "license string, text string")
    rows = rows.select("license", F.expr(_words_sql("text")).alias("w"))
    return rows.select("license", F.size("w").alias("n_words"),
                       F.array_distinct(F.expr(_shingles_sql("w", k))).alias("shingles")).where("size(shingles) > 0")


def find_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text", k: int = SHINGLE_WORDS, containment: float = CONTAINMENT,
                  bands: int = BANDS) -> DataFrame:
    """(doc_id, license, containment, window_start): one row for each id and template found,
    with the best window (the first of equals), counted in words.

    Words are runs of letters and digits in lower case.  Null, empty and short
    texts hold nothing; templates of fewer than ``k`` words are not sought;
    rows that repeat an id count together; an empty table gives an empty
    result.  Other columns are not read.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates, k).collect()  # the fixed list above, or the caller's
    empty = "doc_id {}, license string, containment double, window_start int".format(
        docs.schema[id_col].dataType.simpleString())
    if not known:
        return spark.createDataFrame([], empty)
    every = sorted({h for t in known for h in t["shingles"]})
    any_of = "h IN (" + ", ".join(f"{h}L" if h > -(2**63) else "-9223372036854775807L - 1" for h in every) + ")"
    sizes = sorted({t["n_words"] for t in known})
    # stack(1, x) names a result that is computed once: a plain column would be
    # put in place of its name in the filter below, inside the functions over it.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.expr(f"stack(1, {_words_sql(f'`{text_col}`')})").alias("w"))
    rows = rows.select("doc_id", F.expr(f"stack(1, {_shingles_sql('w', k)})").alias("g"))
    # Places of template shingles: none, no license.
    places = f"filter(transform(g, (h, i) -> CASE WHEN {any_of} THEN i END), i -> i IS NOT NULL)"
    rows = rows.select("doc_id", "g", F.expr(f"stack(1, {places})").alias("hits")).where("size(hits) > 0")
    starts = ", ".join(
        f"transform(array_distinct(flatten(transform(hits, p -> array(p div {m}, greatest(p div {m} - 1, 0))))), "
        f"b -> struct({m} as m, cast(b * {m} as int) as start))" for m in sizes)
    windows = rows.select("doc_id", "g", F.expr(f"explode(flatten(array({starts})))").alias("x"))
    windows = windows.select("doc_id", "x.m", "x.start", F.expr(
        f"stack(1, array_distinct(slice(g, x.start + 1, 2 * x.m - {k - 1})))").alias("s"))
    # A window keeps its shingles beside its bands: few windows are left by now.
    banded = windows.select("doc_id", "m", "start", "s", F.expr(f"explode({_bands_sql('s', bands)})").alias("b"))
    shapes = template_table(spark, templates, k)
    shapes = shapes.select("license", F.col("n_words").alias("tm"), F.col("shingles").alias("t"),
                           F.expr(f"explode({_bands_sql('shingles', bands)})").alias("tb"))
    met = banded.join(F.broadcast(shapes), (F.col("m") == F.col("tm")) & (F.col("b.band") == F.col("tb.band"))
                      & (F.col("b.low") == F.col("tb.low")))
    score = F.expr("size(array_intersect(t, s)) / size(t)")
    return (met.select("doc_id", "license", score.alias("containment"), "start").where(F.col("containment") >= containment)
            .groupBy("doc_id", "license").agg(F.max(F.struct("containment", (-F.col("start")).alias("at"))).alias("best"))
            .select("doc_id", "license", "best.containment", (-F.col("best.at")).alias("window_start")))


def oracle_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, k: int = SHINGLE_WORDS,
               containment: float = CONTAINMENT) -> str:
    """DuckDB SQL: the exact containment in every window, without bands."""
    listed = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in templates)
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    grams = f"unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: {run}))"
    return f"""
    WITH templates(license, text) AS (VALUES {listed}),
    tw AS (SELECT license, {words} AS w FROM templates),
    ts AS (SELECT DISTINCT license, len(w) AS m, {grams} AS s FROM tw WHERE len(w) >= {k}),
    tn AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
    dw AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
    ds AS (SELECT rid, doc_id, unnest(range(0, len(w) - {k - 1})) AS p, {grams} AS s FROM dw WHERE len(w) >= {k}),
    hits AS (SELECT rid, doc_id, license, m, p, s, unnest([p // m, p // m - 1]) AS b FROM ds JOIN ts USING (s)),
    inside AS (SELECT DISTINCT rid, doc_id, license, m, b, s FROM hits WHERE b >= 0 AND p < b * m + 2 * m - {k - 1}),
    scored AS (SELECT rid, doc_id, license, b * m AS start, count(*) / any_value(n) AS c
               FROM inside JOIN tn USING (license) GROUP BY rid, doc_id, license, b, m),
    best AS (SELECT doc_id, license, max({{'c': c, 'at': -start}}) AS x FROM scored WHERE c >= {containment}
             GROUP BY doc_id, license)
    SELECT doc_id, license, x.c AS containment, CAST(-x.at AS INTEGER) AS window_start FROM best"""
