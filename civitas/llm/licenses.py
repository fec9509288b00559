"""Licence notices found by MinHash, in DataFrame functions alone.

Texts are cut into overlapping windows of 5-word shingles, in as many lengths
as the templates need.
A template of over L / 2 and up to L shingles is looked for in windows of
2 L at steps of L, so it lies whole in one of them. Each window gives
``BANDS`` minima under different hash functions, each minimum a band of its
own, and a template is retrieved when one band agrees. A window that holds
80 of 100 shingles of the template has a Jaccard similarity of at least 0.19
with it, so it misses all 64 bands with probability under 2e-6. Retrieved
templates are then checked exactly: the share of the template's shingles
that the window contains.

A band can agree only if the window holds a shingle of a template, so only
windows around such shingles are hashed; no other could be retrieved.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import tokens

WORDS = 5
BANDS = 64
CONTAINED = 0.8
#: The wording of public licence notices.
TEMPLATES: Mapping[str, str] = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."),
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT-line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def _shingle(toks: str, at: Column, words: int) -> Column:
    return F.xxhash64(*[F.get(toks, at + k) for k in range(words)])


def _shingles(toks: Column, words: int) -> Column:
    """Distinct shingles of an array of at least ``words`` tokens."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(toks) - words),
                                        lambda i: F.xxhash64(*[F.get(toks, i + k) for k in range(words)])))


def _minima(shingles: str, bands: int) -> Column:
    """(band, value): the smallest shingle under each hash function."""
    def band(b: int) -> Column:
        least = F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(b))))
        return F.struct(F.lit(b).alias("band"), least.alias("value"))
    return F.array(*[band(b) for b in range(bands)])


def _power(run: Column) -> Column:
    """The least power of two that is at least ``run``: a template's class."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(30)), F.lit(1), lambda n, _: F.when(n < run, n * 2).otherwise(n))


def template_table(spark: SparkSession, templates: Mapping[str, str], words: int) -> DataFrame:
    """license, length class, shingles per template; one of fewer than
    ``words`` tokens can't be found and is left out."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, body string")
    rows = rows.select("license", tokens(F.col("body")).alias("toks")).where(F.size("toks") >= words)
    run = F.size("toks") - words + 1
    return rows.select("license", _power(run).alias("length"), _shingles(F.col("toks"), words).alias("wanted"))


def scan_licenses(spark: SparkSession, docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, words: int = WORDS,
                  bands: int = BANDS, contained: float = CONTAINED, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """One row per text and licence found: doc_id, text_hash, license,
    containment (largest share of the template's shingles in one window),
    first_token (start of the first such window).

    Null, empty and short texts (fewer tokens than a shingle) have no rows;
    repeated rows of one id and text give one row; an empty table or no
    templates give none; further columns are not read. The templates are a
    list of the caller's, some thousands at most; their shingles are
    broadcast."""
    known = template_table(spark, templates, words)
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.xxhash64(text_column).alias("text_hash"),
                        tokens(F.col(text_column)).alias("toks"))
    # places of template shingles, and the windows of that template's class around them
    seeds = known.select("length", F.explode("wanted").alias("shingle")).distinct()
    places = F.when(F.size("toks") >= words, F.sequence(F.lit(0), F.size("toks") - words))
    hits = (texts.withColumn("place", F.explode(places))
            .withColumn("shingle", _shingle("toks", F.col("place"), words)).join(F.broadcast(seeds), "shingle"))
    around = F.floor(F.col("place") / F.col("length")).cast("int")
    windows = (hits.withColumn("number", F.explode(F.array(around, F.greatest(around - 1, F.lit(0)))))
               .withColumn("start", F.col("number") * F.col("length"))
               .select("doc_id", "text_hash", "length", "start",
                       F.slice("toks", F.col("start") + 1, 2 * F.col("length") + words - 1).alias("window"))
               .distinct()
               .withColumn("shingles", _shingles(F.col("window"), words)))
    marks = known.select("license", "length", "wanted", F.explode(_minima("wanted", bands)).alias("m"))
    marks = marks.select("license", "length", "wanted", "m.band", "m.value")
    retrieved = (windows.drop("window").withColumn("m", F.explode(_minima("shingles", bands)))
                 .select("doc_id", "text_hash", "length", "start", "shingles", "m.band", "m.value")
                 .join(F.broadcast(marks), ["length", "band", "value"]))
    share = F.size(F.array_intersect("wanted", "shingles")) / F.size("wanted")
    return (retrieved.withColumn("containment", share).where(F.col("containment") >= contained)
            .groupBy("doc_id", "text_hash", "license")
            .agg(F.max("containment").alias("containment"), F.min("start").alias("first_token")))
