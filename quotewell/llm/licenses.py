"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import col, key_pair, read

WORDS = 5
CONTAINED = 0.8
BANDS = 32

# Clauses of public licenses and of the notices they ask for, and common license lines.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "all-rights-reserved-line": "All rights reserved.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-permission": "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-limits": "See the License for the specific language governing permissions and limitations under the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl-copy": "You should have received a copy of the GNU Lesser General Public License along with this library",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "agpl-copy": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-permission": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-permission": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "wtfpl": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document",
}


def _with_shingles(rows: DataFrame, size: int) -> DataFrame:
    """rows with shingles, the hashes of all runs of `size` words of body (lower case, cut at all but letters and digits).

    One step per column: a column used several times in the next is not worked out anew there.
    """
    words = F.filter(F.split(F.lower("body"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    rows = rows.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w))).drop("body")
    rows = rows.withColumn("runs", F.greatest(F.size("hashes") - size + 1, F.lit(0)))
    shifted = [F.slice("hashes", F.lit(i + 1), F.col("runs")).alias(f"w{i}") for i in range(size)]
    return rows.withColumn("shingles", F.transform(F.arrays_zip(*shifted), lambda z: F.xxhash64(z))).drop("hashes", "runs")


def _bands(shingles: str) -> Column:
    """BANDS minhashes, one row to a band."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda i: F.array_min(F.transform(F.col(shingles), lambda s: F.xxhash64(s, i))))


def words_of(template: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", template.lower()) if w]


def by_size(templates: Mapping[str, str]) -> dict[int, dict[str, str]]:
    """The templates by the length of their runs: WORDS words, or all of a shorter template's. Templates without words are refused."""
    sizes = {name: min(WORDS, len(words_of(body))) for name, body in templates.items()}
    if empty := [name for name, size in sizes.items() if not size]:
        raise ValueError(f"templates without words: {empty}")
    return {size: {n: templates[n] for n in templates if sizes[n] == size} for size in sorted(set(sizes.values()))}


def template_table(spark: SparkSession, templates: Mapping[str, str], size: int = WORDS) -> DataFrame:
    """license, own (distinct shingles), width (shingles of its windows), bands.

    The width is the least power of two that is at least twice the template's size.
    """
    given = spark.createDataFrame(list(templates.items()), T.StructType([T.StructField("license", T.StringType()), T.StructField("body", T.StringType())]))
    table = _with_shingles(given, size).select("license", F.array_distinct("shingles").alias("own"))
    rows = [(r["license"], r["own"], 2 ** ceil(log2(2 * len(r["own"])))) for r in table.collect()]
    return spark.createDataFrame(rows, "license string, own array<long>, width int").withColumn("bands", _bands("own"))


def license_matches(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, contained: float = CONTAINED, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """ident, k1, k2 (hash of id and text), license, containment, n_windows, first_word: the templates found in each row of docs.

    Runs are five words, or a shorter template as a whole: "All rights reserved."
    is found where its three words stand. Texts are read once for each length of runs.

    A window holds twice to four times as many runs as its template
    and starts every half width, so any place a template can stand lies whole in
    one. If the window holds a share `contained` of the template's runs, their
    Jaccard similarity is at least 0.8 / 4.2, and 32 bands of one minhash miss
    it once in 800 times or less (once in 10,000 for a whole copy). Windows found
    are checked by exact containment; the best, the number of windows that pass
    and the word at which the first starts are returned. Null, empty and
    shorter texts have no match; rows that repeat in full are one.

    A minhash of a window equals a template's only if the window holds that run
    of the template, so windows without any run of a template are never built:
    all texts are hashed, but only the few such windows get minhashes. The
    templates, a parameter, are the only thing broadcast; no text is shuffled.
    """
    parts = [_matches(docs, own, size, contained, text, ident) for size, own in by_size(templates).items()]
    return reduce(DataFrame.unionByName, parts)


def _matches(docs: DataFrame, templates: Mapping[str, str], size: int, contained: float, text: str, ident: str) -> DataFrame:
    """`license_matches` for templates whose runs have `size` words."""
    spark = docs.sparkSession
    table = template_table(spark, templates, size)
    known = table.select("own", "width").collect()
    wanted = sorted({run for r in known for run in r["own"]})
    widths = sorted({r["width"] for r in known})
    rows = docs.select(col(ident).alias("ident"), col(text).alias("body")).select("ident", *key_pair(F.col("ident"), F.col("body")), "body")
    rows = _with_shingles(rows, size)
    places = F.filter(F.transform("shingles", lambda s, i: F.when(s.isin(wanted), i)), lambda i: i.isNotNull())

    def windows(i: Column) -> Column:
        found = []
        for w in widths:
            half = w // 2
            at = F.floor(i / half).cast("int")
            found += [F.struct(F.lit(w).alias("width"), at.alias("at")), F.struct(F.lit(w).alias("width"), F.greatest(at - 1, F.lit(0)).alias("at"))]
        return F.array(*found)

    rows = rows.withColumn("windows", F.array_distinct(F.flatten(F.transform(places, windows))))
    # The outer explode, and the filter behind it: a filter in front would hash all texts once more to find out.
    opened = rows.withColumn("window", F.explode_outer("windows")).where(F.col("window").isNotNull()).select(
        "ident", "k1", "k2", F.col("window.width").alias("width"), (F.col("window.at") * (F.col("window.width") / 2).cast("int")).alias("first_word"), "shingles"
    )
    opened = opened.select("ident", "k1", "k2", "width", "first_word", F.array_distinct(F.slice("shingles", F.col("first_word") + 1, F.col("width"))).alias("inside"))
    banded = opened.withColumn("bands", _bands("inside")).select("*", F.posexplode_outer("bands").alias("band", "value")).drop("bands")
    looked_up = table.select("license", "own", F.col("width").alias("width"), F.posexplode("bands").alias("band", "value"))
    share = F.size(F.array_intersect("own", "inside")) / F.size("own")
    found = banded.join(F.broadcast(looked_up), ["width", "band", "value"]).select("ident", "k1", "k2", "license", "first_word", share.alias("containment"))
    return found.where(F.col("containment") >= contained).groupBy("ident", "k1", "k2", "license").agg(
        F.max("containment").alias("containment"), F.count_distinct("first_word").alias("n_windows"), F.min("first_word").cast("long").alias("first_word")
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(read(spark, sf_dir, "documents")).select(F.col("ident").alias("doc_id"), "license", "containment", "n_windows", "first_word")


def _sql() -> str:
    names = ", ".join("('" + name + "', '" + body.replace("'", "''") + "')" for name, body in TEMPLATES.items())
    words = "list_filter(string_split_regex(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return f"""
WITH templates(license, body) AS (VALUES {names}),
template_words AS (
    SELECT license, words, least({WORDS}, len(words)) AS run_words FROM (SELECT license, {words.format("body")} AS words FROM templates)
),
template_runs AS (
    SELECT DISTINCT license, array_to_string(words[i + 1 : i + run_words], ' ') AS run
    FROM (SELECT license, words, run_words, unnest(range(0, len(words) - run_words + 1)) AS i FROM template_words)
), sizes AS (
    SELECT license, count(*) AS size, pow(2, ceil(log2(2 * count(*))) - 1)::BIGINT AS half FROM template_runs GROUP BY license
), doc_words AS (SELECT doc_id, {words.format("text")} AS words FROM documents),
doc_runs AS (
    SELECT doc_id, i, array_to_string(words[i + 1 : i + run_words], ' ') AS run
    FROM (SELECT doc_id, words, run_words, unnest(range(0, len(words) - run_words + 1)) AS i
          FROM doc_words, (SELECT DISTINCT run_words FROM template_words))
), hits AS (
    SELECT DISTINCT doc_id, license, run, size, half, unnest([i // half, greatest(i // half - 1, 0)]) AS place
    FROM doc_runs JOIN template_runs USING (run) JOIN sizes USING (license)
), windows AS (
    SELECT doc_id, license, place * half AS first_word, count(DISTINCT run) / any_value(size) AS containment
    FROM hits GROUP BY doc_id, license, place, half
)
SELECT doc_id, license, max(containment) AS containment, count(*) AS n_windows, min(first_word) AS first_word
FROM windows WHERE containment >= {CONTAINED} GROUP BY doc_id, license
"""


OP6_SQL = _sql()
