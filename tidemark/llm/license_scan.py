"""Operator 9, license scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

A text is lower-cased and split into words of letters and digits; a shingle is two words. Every second window of WINDOW
words gets BANDS MinHash values (the least value under as many hash functions), one value to a band, and so does every
window of each template. A notice of three words lies whole in two of the text's windows at least, each of which has two
of its five shingles in common with the template: similarity 0.4. Ten bands of one row miss one such window with a chance
of 0.6 ** 10 = 0.006, and both with less; of four words (0.6) with 0.0001; of WINDOW or more words a text's window equals
one of the template's. All is done per row, without a shuffle; only hits are verified and counted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE, BANDS, MIN_CONTAINMENT = 6, 2, 10, 0.8
MAX_TEMPLATES = 200
#: Words on both sides of a hit that are looked at, or as many as the longest template has.
REACH = 120

#: Public notices by the name of their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "LGPL notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "reserved": "All rights reserved",
}


def shingled(df: DataFrame, text: Column) -> DataFrame:
    """df with grams array<long>: hashes of word pairs, with WINDOW blank words behind the text, so that every word starts a
    window. A text of n words has n - 1 pairs of its own."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    df = df.withColumn("h", F.transform(F.concat(words, F.array_repeat(F.lit(""), WINDOW)), lambda w: F.xxhash64(w)))
    return df.withColumn("grams", F.zip_with(F.slice("h", F.lit(1), F.size("h") - 1), F.slice("h", F.lit(2), F.size("h") - 1), lambda a, b: F.xxhash64(a, b))).drop("h")


def band_values(grams: Column, at: Column, n: int) -> Column:
    """BANDS MinHash values of the n shingles from `at` on, each under a hash function of its own."""
    return F.array(*[F.least(*[F.xxhash64(F.get(grams, at + j), F.lit(band)) for j in range(n)]) for band in range(BANDS)])


def template_bands(spark, templates: Mapping[str, str]) -> DataFrame:
    """(license, n, shingles, values): every template's number of shingles, its distinct ones, and the band values of its windows."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = shingled(spark.createDataFrame(list(templates.items()), "license string, text string"), F.col("text"))
    rows = rows.withColumn("own", F.slice("grams", F.lit(1), F.greatest(F.size("grams") - WINDOW, F.lit(0))))
    span = WINDOW - 1
    # a template shorter than a window: its own shingles only, the last one repeated
    padded = F.concat("own", F.array_repeat(F.try_element_at("own", F.lit(-1)), F.greatest(F.lit(span) - F.size("own"), F.lit(0)).cast("int")))
    rows = rows.withColumn("padded", padded)
    starts = F.sequence(F.lit(0), F.size("padded") - span)
    values = F.flatten(F.transform(starts, lambda i: band_values(F.col("padded"), i, span)))
    return rows.select("license", F.size("own").alias("n"), F.array_distinct("own").alias("shingles"), F.array_distinct(values).alias("values"))


def license_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The license notices in every text.

    Returns one row per id and license found: id_col, license, containment double (share of the template's word pairs in
    the text around the hit, MIN_CONTAINMENT or more), n_hits long (windows that retrieved and passed), first_word long
    (the first such window's word number, from 0). At most MAX_TEMPLATES templates, each of three words or more, else
    ValueError.

    Null and empty texts hold none. Rows with equal ids, repeated rows and null ids among them, are counted as one
    document. Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    known = template_bands(spark, templates).collect()  # some times as large as the templates given
    if short := [r.license for r in known if r.n < 2]:
        raise ValueError(f"templates of fewer than three words: {short}")
    wanted = sorted({v for r in known for v in r["values"]}) or [0]
    span, reach = WINDOW - 1, max([REACH, *(r.n for r in known)])
    rows = shingled(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), F.col("text")).drop("text")
    # A band value stands for a shingle of its window. So a window without any of the templates' shingles matches no band,
    # and its values need not be made; this leaves out no window that the bands would retrieve.
    shingles = sorted({x for r in known for x in r.shingles}) or [0]
    told = F.filter(F.transform("grams", lambda g, i: F.when(g.isin(*shingles), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("told", told)
    grid = lambda i: F.floor((i - span + STRIDE) / STRIDE).cast("int") * STRIDE  # noqa: E731  the first window that holds shingle i
    around_it = lambda i: F.sequence(F.greatest(grid(i), F.lit(0)), (F.floor(i / STRIDE) * STRIDE).cast("int"), F.lit(STRIDE))
    starts = F.filter(F.array_distinct(F.flatten(F.transform("told", around_it))), lambda i: i <= F.size("grams") - span)
    all_windows = F.transform(starts, lambda i: F.struct(i.alias("at"), F.filter(band_values(F.col("grams"), i, span), lambda v: v.isin(*wanted)).alias("values")))
    hits = rows.select("id", "grams", F.filter(all_windows, lambda w: F.size(w["values"]) > 0).alias("hits"))
    near = lambda w: F.slice("grams", F.greatest(w["at"] - reach, F.lit(0)) + 1, F.lit(2 * reach + span))
    around = F.transform("hits", lambda w: F.struct(w["at"].alias("at"), w["values"].alias("values"), near(w).alias("near")))
    # outer, since a filter on the array would be pushed down, and there compute the shingles anew for each window
    each = hits.select("id", F.explode_outer(around).alias("w")).select("id", "w.at", "w.near", F.explode_outer(F.array_distinct("w.values")).alias("value"))
    table = spark.createDataFrame([(v, r.license) for r in known for v in r["values"]], "value long, license string")
    sets = spark.createDataFrame([(r.license, r.shingles) for r in known], "license string, shingles array<bigint>")
    share = F.size(F.array_intersect("shingles", "near")) / F.size("shingles")
    checked = each.join(F.broadcast(table), "value").join(F.broadcast(sets), "license").withColumn("containment", share).filter(F.col("containment") >= MIN_CONTAINMENT)
    out = checked.groupBy("id", "license").agg(F.max("containment").alias("containment"), F.count_distinct("at").alias("n_hits"), F.min("at").cast("long").alias("first_word"))
    return out.withColumnRenamed("id", id_col)
