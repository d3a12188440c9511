"""License scan: MinHash bands over overlapping text windows retrieve license
templates, exact shingle containment verifies them. DataFrame functions only.

A template of n five-word shingles belongs to the size class c with
2**(c-1) < n <= 2**c. Windows of class c hold 2**(c+1) shingles and begin at
every 2**c-th, so an occurrence of any template of the class lies whole in one
of them. A window that contains at least 0.8 of a template's shingles has a
Jaccard similarity of 0.19 or more with it, and with 32 bands of one MinHash
value each they collide with a probability of 0.998 or more.

A band value can only collide where the window holds the very shingle that is
the template's minimum. So each text is first searched for these shingles (a
bounded set), and windows and their MinHash values are made around hits only;
every window without a hit could not have collided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import written

WORDS = 5
BANDS = 32
CONTAINMENT = 0.8

#: License notices, lower case and punctuation do not matter (fixed values).
TEMPLATES = {
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
}


def _words(text: Column) -> Column:
    """Letter and digit runs in lower case; none for a null or empty text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingle_count(words: Column) -> Column:
    return F.greatest(F.size(words) - (WORDS - 1), F.lit(0))


def _per_shingle(words: Column, make) -> Column:
    n = _shingle_count(words)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(F.array())


def _let(value: Column, make) -> Column:
    """``make(value)`` with the value computed once, wherever the optimizer moves it."""
    return F.transform(F.array(value), make)[0]


def _hashes(words: Column) -> Column:
    # five words hashed one into the next: no shingle string is built
    return F.transform(F.slice(words, 1, _shingle_count(words)),
                       lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WORDS)]))


def _shingles(words: Column) -> Column:
    return F.transform(_per_shingle(words, lambda i: F.slice(words, i + 1, WORDS)), lambda s: F.array_join(s, " "))


def _salts() -> list[int]:
    """One pattern per band; a hash XOR the pattern orders the shingles anew."""
    x, out = 1, []
    for _ in range(BANDS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(x - (1 << 64) if x >> 63 else x)
    return out


def _signature(hashes: Column) -> Column:
    """One least value per band, with its number."""
    def least(salt: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(salt))))

    return F.array(*[F.struct(F.lit(b).alias("band"), least(s).alias("value")) for b, s in enumerate(_salts())])


def templates(spark: SparkSession, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per template: license, template (its number), class, shingles,
    sig (one value per band). Templates of fewer than five words are refused."""
    rows = [(name, k, t) for name, own in (texts or TEMPLATES).items() for k, t in enumerate(own)]
    short = [t for _, _, t in rows if len(t.split()) < WORDS]
    if short:
        raise ValueError(f"templates of fewer than {WORDS} words: {short}")
    out = (spark.createDataFrame(rows, "license string, template int, text string")
           .withColumn("words", _words(F.col("text"))).withColumn("hashes", F.array_distinct(_hashes(F.col("words"))))
           .withColumn("shingles", F.array_distinct(_shingles(F.col("words")))))
    out = written(out.select("license", "template", "shingles", "hashes"), "license-shingles")
    return written(out.select(
        "license", "template", F.ceil(F.log2(F.size("shingles").cast("double"))).cast("int").alias("class"),
        "shingles", _signature(F.col("hashes")).alias("sig")), "license-templates")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         texts: dict[str, list[str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per id and license found: id, license, template (the best one),
    containment, first_word (0-based word where its window begins).

    Texts without a license, null or empty texts have no row. Repeated rows of
    an id and licenses that several templates or windows show give one row:
    the greatest containment, then the first window, then the first template.
    Rows with a null id are one. Other columns are not kept.
    """
    spark = df.sparkSession
    known = templates(spark, texts)
    # a few templates' values: the set of shingles at which a band can collide
    bounded = known.select("class", F.inline("sig")).distinct().collect()
    salts = _salts()
    hot = sorted({r["value"] ^ salts[r["band"]] for r in bounded})
    sizes = sorted({r["class"] for r in bounded})
    places = lambda hs: F.filter(F.transform(hs, lambda h, i: F.when(h.isin(hot), i)), lambda i: i.isNotNull())
    found = _let(_words(F.col(text_col)), lambda ws: _let(_hashes(ws), lambda hs: F.struct(
        ws.alias("words"), hs.alias("hashes"), places(hs).alias("at"))))
    placed = written(df.select(F.col(id_col), found.alias("f")).where(F.size("f.at") > 0).select(id_col, "f.*"),
                     "license-hits")
    # windows around the hits: each hit lies in two windows of each class
    def around(c: int) -> Column:
        begin = lambda i, k: F.greatest((F.shiftright(i, c) - k) * (1 << c), F.lit(0))
        return F.flatten(F.transform("at", lambda i: F.array(
            *[F.struct(F.lit(c).alias("class"), begin(i, k).alias("start")) for k in (0, 1)])))

    starts = F.array_distinct(F.flatten(F.array(*map(around, sizes))))
    windows = placed.select(F.col(id_col), "words", "hashes", F.explode(starts).alias("w")).select(
        id_col, "w.*", "words", "hashes")
    span = F.expr("shiftleft(2, class)")
    cut = windows.select(id_col, "class", "start", F.slice("hashes", F.col("start") + 1, span).alias("hashes"),
                         F.slice("words", F.col("start") + 1, span + (WORDS - 1)).alias("words"))
    keys = F.broadcast(known.select("license", "template", "class", "shingles", F.inline("sig")))  # templates * bands rows
    met = (cut.select(id_col, "class", "start", "words", F.explode(_signature(F.col("hashes"))).alias("s"))
           .select(id_col, "class", "start", "words", "s.band", "s.value").join(keys, ["class", "band", "value"])
           .dropDuplicates([id_col, "start", "class", "license", "template"]))
    share = F.size(F.array_intersect(_shingles(F.col("words")), F.col("shingles"))) / F.size("shingles")
    good = met.withColumn("containment", share).where(F.col("containment") >= containment)
    best = F.max(F.struct("containment", (-F.col("start")).alias("s"), (-F.col("template")).alias("t")))
    return good.groupBy(id_col, "license").agg(best.alias("b")).select(
        id_col, "license", (-F.col("b.t")).alias("template"), "b.containment", (-F.col("b.s")).alias("first_word"))
