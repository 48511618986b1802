"""License scans: MinHash bands over overlapping text windows, then exact shingle containment. DataFrame functions throughout.

A template of L five-word shingles belongs to the class c, the power of two
with c/2 < L <= c; texts are cut into windows of 2c shingles that start every
c shingles, so any passage of c shingles lies whole in a window. A passage that
holds 0.8 of a template has a Jaccard similarity of at least 0.19 with its
window; with 64 bands of one row, the window and the template meet in a band
with a probability of 1 - 0.81**64, over 0.99999. Windows without any shingle
of a template can't meet one and are not signed: that drops no match.
Windows that meet a template are verified by containment of the shingles' text.

A template of under five words is one shingle, its whole word sequence: texts
are shingled at that length too and compared with it directly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm.common import SPACES, keep_where
from layercake.session import materialize

SHINGLE, BANDS, CONTAINED = 5, 64, 0.8

#: License notices to look for (fixed values): name and wording.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
    " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    " See the License for the specific language governing permissions and limitations under the License.",
    "mit-line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"),"
    " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
    " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
    " the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it"
    " will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    " See the GNU General Public License for more details.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
    " in the documentation and/or other materials provided with the distribution.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
    " provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    " If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell,"
    " or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "proprietary-line": "All rights reserved.",
    "proprietary": "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"
    " without the prior written permission of the publisher.",
}

#: Signs that wording is compared without (fixed values).
_SIGNS = ".,;:()[]{}\"'“”‘’*#/<>|&%$!?-_="


def template_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(TEMPLATES.items()), "license string, wording string")


def _words(text: Column) -> Column:
    """Lower-cased words without signs."""
    bare = F.btrim(F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _SIGNS, ""), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t\n\x0B\f\r]+"))


def _starts(words: Column, n: int = SHINGLE) -> Column:
    return F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column, n: int = SHINGLE) -> Column:
    return F.transform(_starts(words, n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))


def _texts(words: Column) -> Column:
    return F.transform(_starts(words), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE)]))


def _bands(hashes: Column) -> Column:
    """One value a band: the smallest shingle hash under the band's own hash, made distinct from other bands' values."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b)))))


def scan(docs: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 100_000) -> DataFrame:
    """``(doc_id, license, containment, first_word)``: every template of which a document holds 0.8 or more of the five-word shingles in a passage.

    ``containment`` is the best window's, ``first_word`` where the first such
    window begins. Wording is compared lower-cased and without signs; null or
    blank texts hold nothing; a template of under five words is held where all
    its words stand in a row, a template without words nowhere;
    rows that share an id give one row for each template. Templates may hold
    ``most`` shingles in all (they are sent to every task); more raise an error.
    """
    every = templates.select("license", _words(F.col("wording")).alias("w"))
    brief = every.where(F.size("w").between(1, SHINGLE - 1)).select("license", F.size("w").alias("n"), F.concat_ws(" ", "w").alias("words"), *[
        F.get(_hashes(F.col("w"), n), F.lit(0)).alias(f"h{n}") for n in range(1, SHINGLE)
    ]).collect()
    t = every.where(F.size("w") >= SHINGLE).select("license", F.array_distinct(_hashes(F.col("w"))).alias("h"), F.array_distinct(_texts(F.col("w"))).alias("s"))
    known = t.select("license", "h", "s", _bands(F.col("h")).alias("bands")).collect()
    if sum(len(r["h"]) for r in known) + len(brief) > most:
        raise ValueError(f"templates hold more than {most} shingles")
    spark = docs.sparkSession
    classes = {r["license"]: 1 << math.ceil(math.log2(len(r["h"]))) for r in known}
    shingles = sorted({h for r in known for h in r["h"]})
    values = sorted({v for r in known for v in r["bands"]})
    by_band = spark.createDataFrame(
        [(v, classes[r["license"]], r["license"], r["s"]) for r in known for v in r["bands"]], "value bigint, class int, license string, shingles array<string>"
    )
    own = docs.select(F.col(doc_id).alias("doc_id"), _words(F.col(text)).alias("w"))
    own = own.withColumn("h", _hashes(F.col("w")))
    own = own.withColumn("at", F.filter(F.transform("h", lambda h, i: F.when(h.isin(shingles), i)), lambda x: x.isNotNull()))
    own = own.withColumn("brief", F.flatten(F.array(F.array().cast("array<struct<n:int,start:int>>"), *[
        _briefly(n, sorted({r[f"h{n}"] for r in brief if r["n"] == n})) for n in sorted({r["n"] for r in brief})
    ])))
    # few texts hold any shingle of a template: they are stored, and dealt out anew with all that follows
    own = materialize(keep_where(own, (F.size("at") > 0) | (F.size("brief") > 0)), "license-texts")
    none = F.array().cast("array<struct<class:int,start:int>>")
    cuts = F.flatten(F.array(none, *[_windows(c) for c in sorted(set(classes.values()))]))
    windows = own.select("doc_id", "w", "h", F.explode(cuts).alias("c")).select("doc_id", "w", "h", "c.class", "c.start")
    windows = windows.withColumn("bands", _bands(F.slice("h", F.col("start") + 1, F.col("class") * 2)))
    met = windows.select(
        "doc_id", "class", "start", F.slice("w", F.col("start") + 1, F.col("class") * 2 + SHINGLE - 1).alias("w"),
        F.explode(F.filter("bands", lambda v: v.isin(values))).alias("value"),
    )
    found = met.join(F.broadcast(by_band), ["value", "class"])  # bounded by ``most``
    share = F.size(F.array_intersect(_texts(F.col("w")), F.col("shingles"))) / F.size("shingles")
    checked = found.select("doc_id", "license", "start", share.alias("share")).where(F.col("share") >= CONTAINED)
    if brief:
        wording = spark.createDataFrame([(r["license"], r["n"], r["words"]) for r in brief], "license string, n int, words string")
        stand = own.select("doc_id", "w", F.explode("brief").alias("b")).select(
            "doc_id", F.col("b.n").alias("n"), F.concat_ws(" ", F.slice("w", F.col("b.start") + 1, F.col("b.n"))).alias("words"),
            F.greatest(F.col("b.start") - 1, F.lit(0)).alias("start"),  # the first window of two shingles that holds it
        )
        stand = stand.join(F.broadcast(wording), ["n", "words"])  # bounded by ``most``
        checked = checked.union(stand.select("doc_id", "license", "start", F.lit(1.0).alias("share")))
    return checked.groupBy("doc_id", "license").agg(F.max("share").alias("containment"), F.min("start").alias("first_word"))


def _windows(c: int) -> Column:
    """``(class, start)`` of a class's windows that hold any of the shingles ``at``: those that start at its multiple of c, or one step before."""
    starts = F.array_distinct(F.flatten(F.transform("at", lambda i: F.array(i - i % c, F.greatest(i - i % c - c, F.lit(0))))))
    return F.transform(starts, lambda s: F.struct(F.lit(c).alias("class"), s.alias("start")))


def _briefly(n: int, hashes: list[int]) -> Column:
    """``(n, start)`` of a text's shingles of ``n`` words that have one of the hashes."""
    found = F.transform(_hashes(F.col("w"), n), lambda h, i: F.when(h.isin(hashes), F.struct(F.lit(n).alias("n"), i.alias("start"))))
    return F.filter(found, lambda x: x.isNotNull())
