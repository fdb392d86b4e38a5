"""License scans: MinHash bands over text windows, then exact containment.

Texts and templates become runs of 5-word shingles (words are ``[a-z0-9]+`` of
the lowered text, shingles are compared by their 64-bit hash). Templates of
similar length share a size class: windows of the class have ``W`` shingles, two
to four times the template's, and start every ``W / 2``, so a template that
occurs is whole in at least one window. There its similarity to the window is
0.8 / 4.2 or more when 0.8 of it is found, and ``n_bands`` picks as many one-value bands
as make them meet in one with a probability of at least ``PROBABILITY``. Windows
that meet a template in a band are checked exactly: the share of the template's
distinct shingles that the window holds must be ``PERCENT`` or more.

Everything is DataFrame expressions. A text without any template shingle can't
match, so only windows around such shingles are formed; for most texts the work
ends in the first projection. The templates are a parameter of at most
``MAX_SHINGLES`` shingles in all; that bounds the broadcast side.

Defined cases: a null or empty text, or one of fewer than five words, matches
nothing and has no row. A template needs five words at least. Very long texts
are cut into windows whole. Rows that repeat an id give one row for each license
and id, the best of them. A row without id is reported with a null id. An empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusmart.llm.license_texts import CREATIVE_COMMONS, NOTICES

# Wordings of common license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-header", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    *NOTICES,
    *CREATIVE_COMMONS,
)
SHINGLE, PERCENT, PROBABILITY = 5, 80, 1 - 1e-6
MAX_SHINGLES = 100_000


def n_bands(percent: int = PERCENT, probability: float = PROBABILITY) -> int:
    """Bands of one value each, for the least similarity a window can have."""
    share = percent / 100
    least = share / (4 + 1 - share)
    return math.ceil(math.log(1 - probability) / math.log(1 - least))


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(text: Column) -> Column:
    """Hashes of the 5-word shingles in order, an empty array if there are none."""
    w = F.split(F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " ")), " ")
    parts = lambda w, x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, SHINGLE)])
    return _let(w, lambda w: F.transform(F.slice(w, 1, F.greatest(F.size(w) - SHINGLE + 1, F.lit(0))), lambda x, i: parts(w, x, i)))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """license, shingles (distinct), n, window (its class's length)."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, t in templates]))
    t = spark.range(1).select(rows.alias("t")).select("t.license", F.array_distinct(shingles(F.col("t.text"))).alias("shingles"))
    n = F.size("shingles")
    return t.withColumns({"n": n, "window": F.pow(F.lit(2.0), F.ceil(F.log2(n)) + 1).cast("int")})


def _band_values(window: Column, bands: int) -> Column:
    """The least hash of a window under each band's hash function."""
    k = F.sequence(F.lit(0), F.lit(bands - 1))
    return F.transform(k, lambda b: F.array_min(F.transform(window, lambda x: F.xxhash64(x, b))))


def license_scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """doc_id, license, n_found, n_shingles and first_word (of the first best
    window) for every document and license that match."""
    spark = docs.sparkSession
    table = template_table(spark, templates)
    known = table.collect()
    total = sum(r["n"] for r in known)
    if total > MAX_SHINGLES or any(r["n"] == 0 for r in known):
        raise ValueError(f"templates need five words each and {MAX_SHINGLES} shingles at most in all")
    sizes = sorted({r["window"] for r in known})
    every = sorted({x for r in known for x in r["shingles"]})
    bands = n_bands(percent)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingles(F.col("text")).alias("s"))
    # Positions of template shingles; "s" is used twice, so it is made once.
    at = F.filter(F.transform("s", lambda x, i: F.when(x.isin(every), i)), lambda i: i.isNotNull())
    hit = text.withColumn("at", at).where(F.size("at") > 0)

    def windows(size: int) -> Column:
        half = size // 2
        numbers = F.array_distinct(F.flatten(F.transform("at", lambda i: F.array(F.floor(i / half), F.floor(i / half) - 1))))
        return F.transform(
            F.filter(numbers, lambda n: n >= 0),
            lambda n: F.struct(F.lit(size).alias("window"), (n * half).cast("int").alias("start"), F.slice("s", (n * half + 1).cast("int"), size).alias("part")),
        )

    cut = hit.select("doc_id", F.explode(F.flatten(F.array(*[windows(w) for w in sizes]))).alias("w"))
    cut = cut.select("doc_id", "w.window", "w.start", F.array_distinct("w.part").alias("part"))
    banded = cut.select("*", F.posexplode(_band_values(F.col("part"), bands)).alias("band", "least"))
    keyed = table.select("license", "shingles", "n", "window", F.posexplode(_band_values(F.col("shingles"), bands)).alias("band", "least"))
    met = banded.join(F.broadcast(keyed), ["window", "band", "least"])
    # Every meeting is verified; a pair that meets in several bands gives equal rows.
    found = met.select("doc_id", "license", "start", F.size(F.array_intersect("part", "shingles")).alias("n_found"), "n")
    found = found.where(F.col("n_found") * 100 >= F.col("n") * percent)
    best = found.groupBy("doc_id", "license", "n").agg(F.max(F.struct("n_found", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(
        "doc_id", "license", F.col("best.n_found").cast("long").alias("n_found"), F.col("n").cast("long").alias("n_shingles"), (-F.col("best.back")).cast("long").alias("first_word")
    )
