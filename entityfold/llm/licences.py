"""Licence scans: templates found by MinHash bands over overlapping windows, then verified.

Texts and templates are lower-cased runs of letters and digits, in shingles of five words; a
template of fewer words is one shingle, its whole word sequence. A template of n words is found
where one and a half n words in a row (n words, if it is a single shingle) hold four fifths of its
shingles, whatever word they begin with, so that other words may stand in between.

Bands only retrieve. With s a quarter of n, a text is looked at through windows that start every s
words and are s - 1 words longer than the passage, so that each passage lies whole in one of them.
Such a window has a Jaccard similarity of at least a third with the template; with one row per band
and 32 bands the two share a band with a probability above 1 - 1e-6.
Each retrieved window is verified by exact shingle containment from every word in it.

A band can only be shared through a shingle that both have. Windows without any shingle of a
template of their length are therefore not hashed; none of them could be a candidate.

All of it is DataFrame expressions; the templates are a fixed list, so broadcasting them is
bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 32
THRESHOLD = 0.8

# Published licence notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd-2-clause": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-bsd-3-clause": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-cc0-1.0": "SPDX-License-Identifier: CC0-1.0",
    "spdx-gpl-2.0": "SPDX-License-Identifier: GPL-2.0",
    "spdx-gpl-3.0": "SPDX-License-Identifier: GPL-3.0",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-mpl-2.0": "SPDX-License-Identifier: MPL-2.0",
}


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, as an array; empty for a null or blank text."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def shingles(of_words: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words, in order."""
    at = F.sequence(F.lit(0), F.size(of_words) - n)
    each = F.transform(at, lambda i: F.xxhash64(*(of_words[i + k] for k in range(n))))
    return F.when(F.size(of_words) >= n, each).otherwise(F.array().cast("array<bigint>"))


def grain(n: int) -> int:
    """Words per shingle for templates of ``n`` words."""
    return min(SHINGLE, n)


def passage(n: int) -> int:
    """Words in which a template of ``n`` words has to be found."""
    return n + n // 2 if n > SHINGLE else n


def step(n: int) -> int:
    """How far apart the windows for templates of ``n`` words start."""
    return max(1, n // 4)


def width(n: int) -> int:
    """Shingles per window: a passage that starts at any word is whole in one window."""
    return passage(n) + step(n) - grain(n)


def bands(hashes: Column) -> Column:
    """One key per band: the least of the shingles' hashes under the band's hash function."""

    def least(seed: Column) -> Column:
        return F.xxhash64(seed, F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, seed))))

    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), least)


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``template``, ``n`` (its words), ``reach`` (shingles of a passage after the first),
    ``shingles`` (distinct) and ``keys`` (bands). Templates without a word are left out."""
    made = spark.createDataFrame(list(templates.items()), "template string, text string")
    made = made.withColumn("words", words(F.col("text"))).withColumn("n", F.size("words")).where("n > 0")
    n = F.col("n")
    whole = shingles(F.col("words"), SHINGLE)
    for k in range(1, SHINGLE):
        whole = F.when(n == k, shingles(F.col("words"), k)).otherwise(whole)
    made = made.withColumn("shingles", F.array_distinct(whole))
    reach = F.when(n > SHINGLE, n + F.floor(n / 2) - SHINGLE).otherwise(0).cast("int")
    return made.select("template", "n", reach.alias("reach"), "shingles", bands(F.col("shingles")).alias("keys"))


def scan(
    df: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per key and template found: ``template``, ``n_matched``, ``containment`` and ``word``.

    ``containment`` is the largest share of the template's shingles in a passage (0.8 or more),
    ``word`` the word at which the first such passage begins. Rows with one key are scanned apart
    and reported together; null keys are one key. Templates of fewer than five words are found
    where all their words stand in a row; null and empty texts hold none.
    """
    spark = df.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates)
    listed = known.collect()  # a fixed list
    classes = sorted({r["n"] for r in listed})
    if not classes:
        return df.select(key, F.lit("").alias("template"), F.lit(0).alias("n_matched"), F.lit(0.0).alias("containment"), F.lit(0).alias("word")).limit(0)

    grains = sorted({grain(n) for n in classes})
    own = {n: sorted({h for r in listed if r["n"] == n for h in r["shingles"]}) for n in classes}
    every = {g: sorted({h for n in classes if grain(n) == g for h in own[n]}) for g in grains}

    # Values that several parts need are arguments of a function, so that they are made once.
    def with_hits(w: Column) -> Column:
        return F.transform(F.array(F.struct(*(shingles(w, g).alias(f"of_{g}") for g in grains))), found_in)[0]

    def found_in(x: Column) -> Column:
        def hits(g: int) -> Column:
            at = F.transform(x[f"of_{g}"], lambda h, i: F.when(h.isin(every[g]), F.struct(i.alias("at"), h.alias("h"))))
            return F.filter(at, lambda i: i.isNotNull()).alias(f"hits_{g}")

        return F.struct(*(x[f"of_{g}"].alias(f"of_{g}") for g in grains), *(hits(g) for g in grains))

    def windows_of(n: int) -> Column:
        """The windows that hold a shingle of a template of n words, each with its shingles."""
        all_hashes, s = F.col(f"x.of_{grain(n)}"), step(n)
        held = F.filter(F.col(f"x.hits_{grain(n)}"), lambda x: x["h"].isin(own[n]))
        first = F.transform(held, lambda x: F.sequence(
            F.greatest(F.lit(0).cast("long"), F.ceil((x["at"] - (width(n) - 1)) / s)), F.floor(x["at"] / s)
        ))
        return F.transform(F.array_distinct(F.flatten(first)), lambda k: F.struct(
            F.lit(n).alias("n"), (k * s).cast("int").alias("word"),
            F.slice(all_hashes, (k * s).cast("int") + 1, width(n)).alias("held"),
        ))

    hashed = df.select(key, F.transform(F.array(words(F.col(text))), with_hits)[0].alias("x"))
    windows = hashed.select(key, F.explode(F.concat(*(windows_of(n) for n in classes))).alias("w"))
    keys = sorted({k for r in listed for k in r["keys"]})
    windows = windows.select(key, "w.n", "w.word", "w.held")
    shared = F.transform(F.array("held"), bands)[0]
    collided = windows.select(key, "n", "word", "held", F.explode(F.array_distinct(F.filter(shared, lambda k: k.isin(keys)))).alias("band"))
    entries = F.broadcast(known.select("template", "n", "reach", "shingles", F.explode("keys").alias("band")))
    pairs = collided.join(entries, ["n", "band"])
    reach, size = F.col("reach"), F.size("shingles")

    def best_passage(hits: Column) -> Column:
        """How many shingles the best passage that begins with a hit holds, and where it begins."""

        def passage_from(first: Column, place: Column) -> Column:
            near = F.filter(F.slice(hits, place + 1, reach + 1), lambda x: x["at"] <= first["at"] + reach)
            n = F.size(F.array_distinct(F.transform(near, lambda x: x["h"])))
            return F.struct(n.alias("n_matched"), (-(F.col("word") + first["at"])).alias("back"))

        return F.array_max(F.transform(hits, passage_from))

    at = F.transform("held", lambda h, i: F.when(F.array_contains("shingles", h), F.struct(i.alias("at"), h.alias("h"))))
    best = F.transform(F.array(F.filter(at, lambda x: x.isNotNull())), best_passage)[0]
    enough = F.size(F.array_intersect("shingles", "held")) / size >= THRESHOLD
    verified = pairs.select(key, "template", size.alias("size"), F.when(enough, best).alias("best"))
    groups = verified.groupBy(key, "template", "size").agg(F.max("best").alias("best"))
    share = F.col("best.n_matched") / F.col("size")
    return groups.where(share >= THRESHOLD).select(
        key, "template", "best.n_matched", share.alias("containment"), (-F.col("best.back")).alias("word")
    )


def scan_sql(templates: dict[str, str]) -> str:
    """DuckDB SQL for the rows of ``scan`` over ``documents``: every passage, without windows or bands."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())

    def split(column: str) -> str:
        return rf"string_split(trim(regexp_replace(lower(coalesce({column}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"

    def runs(table: str, names: str) -> str:
        return f"""SELECT {names}, g, i - 1 AS p, array_to_string(w[i:i + g - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - g + 2)) AS i FROM {table})"""

    return rf"""
        WITH t0 AS (SELECT template, w, len(w) AS n, least(len(w), {SHINGLE}) AS g
              FROM (SELECT template, {split("body")} AS w FROM (VALUES {values}) v(template, body))),
        t1 AS (SELECT DISTINCT template, n, g, s FROM ({runs("t0", "template, n")})),
        t AS (SELECT *, count(*) OVER (PARTITION BY template) AS size,
              CASE WHEN n > {SHINGLE} THEN n + n // 2 - {SHINGLE} ELSE 0 END AS reach FROM t1),
        d0 AS (SELECT doc_id, o, w, g FROM (SELECT DISTINCT g FROM t),
              (SELECT doc_id, row_number() OVER () AS o, {split("text")} AS w FROM documents)),
        d AS ({runs("d0", "doc_id, o")}),
        h AS (SELECT doc_id, o, template, size, reach, p, s FROM d JOIN t USING (g, s)),
        c AS (SELECT a.o AS text_no, a.doc_id, a.template, a.p AS word, a.size, count(DISTINCT b.s) AS m
              FROM h a JOIN h b ON a.o = b.o AND a.template = b.template
                   AND b.p BETWEEN a.p AND a.p + a.reach GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY m DESC, word) AS o
              FROM c WHERE m >= {THRESHOLD} * size)
        SELECT doc_id, template, m::INT AS n_matched, m / size AS containment, word::INT AS word FROM r WHERE o = 1"""
