"""Licence notices in documents: MinHash bands over overlapping windows retrieve
templates, and exact containment of word n-grams verifies them. Only Spark's own
functions are used.

A template of m n-grams is looked for in windows of W n-grams, W the power of two from 2m
on, that begin every W / 2: so any run of m lies in one window whole. If the window holds
the share c of the template's n-grams, their Jaccard similarity is at least
c m / (W + m - c m), more than 0.19 for c = 0.8 as m > W / 4. With one MinHash value a
band, a window and its template meet in one of 48 bands with a probability of at least
1 - 0.81^48 > 0.9999.

A band's value in common means that the window has one of the template's n-grams. So only
windows around such n-grams are hashed, the others cannot meet a template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.functions.text import let

# Words of an n-gram.
_WORDS = 3
# Bands of one MinHash value.
BANDS = 48
# N-grams of templates that are looked for at once, in the mean.
BLOCK_NGRAMS = 50_000

# Wordings of licence notices.
NOTICES = {
    "mit-notice": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files, to deal in the Software without restriction, including without limitation"
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-program": "This program is free software: you can redistribute it and/or modify it under the terms of the"
    " GNU General Public License as published by the Free Software Foundation",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met",
}

# More licences, by wordings that hold none of the above.
MORE_NOTICES = {
    "lgpl": "GNU Lesser General Public License",
    "agpl": "GNU Affero General Public License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl-2.0": "made available under the terms of the Eclipse Public License 2.0",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
    " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the"
    " authors be held liable for any damages arising from the use of this software.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-name": "Creative Commons Attribution 4.0 International License",
    "cc-by-sa-name": "Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "CC0 1.0 Universal",
}


def notice_templates(spark: SparkSession) -> DataFrame:
    """The notices above as a table of templates."""
    return spark.createDataFrame([*NOTICES.items(), *MORE_NOTICES.items()], "license string, template string")


def license_scan(
    docs: DataFrame,
    templates: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    license_col: str = "license",
    template_col: str = "template",
    percent: int = 80,
) -> DataFrame:
    """``id``, ``license``, ``containment`` (largest share of the template's distinct
    n-grams in a window, from ``percent`` % on), ``ngrams`` (of the template) and
    ``first_word`` (where the first such window begins), for each id and licence found.

    Words are runs of letters and digits, with A-Z folded; an n-gram is three of them.
    No text is shuffled; what meets in a band is a row of one window. Templates are looked
    for in blocks of about 50,000 n-grams, or of one larger template, so each block fits
    into the plan and its bands (48 for each template) are broadcast; documents are read
    once for each block. Templates of fewer than three words, or null, are not looked for;
    texts of fewer, or null, hold none. Rows with the same id are one document, a
    null id stays null. Templates with the same text are each found.
    """
    # Templates first: few rows.
    own = templates.select(F.col(license_col).alias("license"), _ngrams(_words(F.col(template_col))).alias("grams"))
    own = own.select("license", F.array_distinct("grams").alias("grams")).where(F.size("grams") > 0)
    own = own.withColumn("span", _power_of_two(2 * F.size("grams")))
    total = own.agg(F.sum(F.size("grams")).alias("n")).first().n or 0
    blocks = max(-(-total // BLOCK_NGRAMS), 1)
    block = F.pmod(F.xxhash64("grams"), F.lit(blocks))
    found = None
    for i in range(blocks):
        part = _found(docs, own.where(block == i) if blocks > 1 else own, id_col, text_col, percent)
        found = part if found is None else found.union(part)
    return (
        found.groupBy("id", "license", "ngrams")
        .agg(F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
        .select("id", "license", "containment", "ngrams", "first_word")
    )


def _found(docs: DataFrame, own: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """The windows that hold a template of one block."""
    rows = own.select("grams", "span").collect()
    known = sorted({g for r in rows for g in r.grams})
    spans = sorted({r.span for r in rows})
    bands = own.select("license", "grams", "span", F.posexplode(_signature(F.col("grams"))).alias("band", "value"))

    texts = docs.select(F.col(id_col).alias("id"), _words(F.col(text_col)).alias("words"))
    texts = texts.where(F.size("words") >= _WORDS).select("id", _ngrams(F.col("words")).alias("all"))
    numbered = F.transform("all", lambda g, i: F.when(g.isin(known), i))
    hits = F.filter(numbered, lambda i: i.isNotNull())
    texts = texts.withColumn("hits", hits).where(F.size("hits") > 0)
    windows = texts.select("id", "all", F.explode(_windows(F.col("hits"), spans)).alias("window")).select(
        "id",
        F.col("window.span").alias("span"),
        (F.col("window.number") * F.col("window.span") / 2).cast("int").alias("first_word"),
        F.slice("all", (F.col("window.number") * F.col("window.span") / 2).cast("int") + 1, F.col("window.span")).alias("inside"),
    )
    signed = windows.select("*", F.posexplode(_signature(F.col("inside"))).alias("band", "value"))
    share = F.size(F.array_intersect("inside", "grams")) / F.size("grams")
    return (
        signed.join(F.broadcast(bands), ["span", "band", "value"])
        .withColumn("containment", share)
        .where(100 * F.size(F.array_intersect("inside", "grams")) >= percent * F.size("grams"))
        .select("id", "license", F.size("grams").alias("ngrams"), "containment", "first_word")
    )


def _words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _ngrams(words: Column) -> Column:
    """Hashes of the runs of words, one for each word that begins one."""
    return let(
        words,
        lambda w: F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - (_WORDS - 1), F.lit(0))),
            lambda first, i: F.xxhash64(first, *[F.get(w, i + k) for k in range(1, _WORDS)]),
        ),
    )


def _power_of_two(least: Column) -> Column:
    return F.pow(F.lit(2.0), F.ceil(F.log2(least.cast("double")))).cast("int")


def _windows(hits: Column, spans: list[int]) -> Column:
    """The distinct windows of each span that hold an n-gram of a template."""

    def of(span: int) -> Column:
        last = F.transform(hits, lambda i: F.floor(i / (span // 2)))
        numbers = F.array_distinct(F.concat(last, F.transform(last, lambda n: F.greatest(n - 1, F.lit(0)))))
        return F.transform(numbers, lambda n: F.struct(F.lit(span).alias("span"), n.alias("number")))

    if not spans:
        return F.array().cast("array<struct<span:int,number:bigint>>")
    return F.concat(*[of(span) for span in spans])


def _signature(grams: Column) -> Column:
    """The smallest hash of the n-grams under each of the bands' hash functions."""
    return let(
        grams,
        lambda held: F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda band: F.array_min(F.transform(held, lambda g: F.xxhash64(g, band))),
        ),
    )
