"""License scan with DataFrame functions only: MinHash bands over text windows, then exact containment.

Texts are words of letters and digits in lower case; a shingle is five words. A window is two
neighbouring shingles, and the windows overlap at every position. For each of ``BANDS`` hash functions
a window's signature is the lesser hash of its shingles (one row a band). A template is a candidate
when one of its windows shares a band with one of the text's. Then the share of the template's
shingles that the text holds decides.

How sure a band is: a template of two or more shingles has a window in common with any text that holds
two of them in a row, so no band can miss it; at a containment of 0.8 some two are in a row. A template
of one shingle is met unless both neighbours in the text hash below it under every function: 3^-8, or
0.015 %. The first and the last shingle of a text are windows of their own too, so there it can't be
missed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, BANDS, CONTAINMENT = 5, 8, 0.8

# Sentences by which licenses are given, as their texts, their stewards' notices, common
# READMEs and SPDX lines have them. Two entries may name one license.
TEMPLATES = (
    ("AGPL-3.0 notice", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0 notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Artistic-2.0", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble This license establishes the terms under which a given free software Package may be copied, modified, distributed"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD notice", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD readme", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0 notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("GPL-2.0 notice", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0 notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL notice", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT distributed", "Distributed under the MIT License."),
    ("MIT licensed", "licensed under the MIT License."),
    ("MIT notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("SPDX AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("SPDX Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("SPDX BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("SPDX BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("SPDX GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("SPDX GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("SPDX LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1"),
    ("SPDX MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
)


_ALL = 2_000_000_000  # more words than an array holds


def _words(text: Column) -> Column:
    """Hashes of the words."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(found, ""), lambda w: F.xxhash64(w))


def _shingles(words: Column) -> Column:
    """Hashes of all runs of ``WIDTH`` = 5 words: of 2, of 4, then of 5 in a row."""
    run = words
    for others, step in ((None, 1), (None, 2), (words, 4)):
        run = F.zip_with(run, F.slice(run if others is None else others, step + 1, _ALL), lambda a, b: F.xxhash64(a, b))
    return F.slice(run, 1, F.greatest(F.size(words) - (WIDTH - 1), F.lit(0)))


def _band(shingles: Column, k: int) -> Column:
    """The lesser hash under function k of every two neighbours; the first and last shingle also alone."""
    return F.zip_with(
        F.concat(F.slice(shingles, 1, 1), shingles), shingles,
        lambda a, b: F.least(F.xxhash64(a, F.lit(k)), F.xxhash64(F.coalesce(b, a), F.lit(k))),
    )


def _of_band(k: int) -> Callable[[Column], Column]:
    # One parameter: a lambda with two is given the element's index as the second.
    return lambda least: F.struct(F.lit(k).alias("band"), least.alias("least"))


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """``license, shingles`` of every template; as many rows as templates are given."""
    rows = F.array(*(F.struct(F.lit(n).alias("license"), F.lit(t).alias("notice")) for n, t in templates))
    listed = spark.range(1).select(F.inline(rows))
    hashed = listed.select("license", _words(F.col("notice")).alias("words"))
    return hashed.select("license", F.array_distinct(_shingles(F.col("words"))).alias("wanted"), _shingles(F.col("words")).alias("shingles"))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, license, n_shingles, n_found, containment`` of every template that a text holds.

    Whole texts are scanned; NULL and empty texts, and templates of fewer than five words, match
    nothing. One row per doc_id, license and measure: repeated rows don't repeat results; rows without
    doc_id are reported with a NULL id. Only the two named columns are read. One narrow pass over the
    texts; the templates' bands are literals and their shingles are broadcast, as many as are given.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates).where(F.size("wanted") > 0)
    bands = known.select("license", F.explode(F.array(*(
        F.struct(F.lit(k).alias("band"), _band(F.col("shingles"), k).alias("least")) for k in range(BANDS)
    ))).alias("b")).select("license", "b.band", F.explode("b.least").alias("least")).distinct()
    literal: dict[int, list[int]] = {k: [] for k in range(BANDS)}
    for row in bands.select("band", "least").distinct().collect():  # bounded by the templates given
        literal[row.band].append(row.least)
    hashed = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        _words(F.col(f"`{text}`")).alias("words"),
    ).select("doc_id", _shingles(F.col("words")).alias("shingles"))
    met = F.concat(*(
        F.transform(
            F.array_intersect(_band(F.col("shingles"), k), F.array(*map(F.lit, literal[k])).cast("array<bigint>")),
            _of_band(k),
        )
        for k in range(BANDS)
    ))
    candidates = hashed.select("doc_id", "shingles", F.explode(met).alias("m")).select("doc_id", "shingles", "m.band", "m.least")
    named = candidates.join(F.broadcast(bands), ["band", "least"]).join(F.broadcast(known.select("license", "wanted")), "license")
    measured = named.select(
        "doc_id", "license", F.size("wanted").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("wanted", "shingles")).cast("long").alias("n_found"),
    ).distinct()
    share = F.col("n_found") / F.col("n_shingles")
    return measured.withColumn("containment", F.round(share, 6)).where(share >= containment)


def scan_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """The same matches by comparing all shingles, in SQL."""
    quoted = ", ".join(f"('{n}', '{t}')" for n, t in ((n, t.replace("'", "''")) for n, t in templates))
    cut = f"""
  SELECT DISTINCT {{key}}, array_to_string(list_slice(w, i, i + {WIDTH - 1}), ' ') AS shingle
  FROM (SELECT {{key}}, w, unnest(range(1, len(w) - {WIDTH - 2})) AS i FROM (
    SELECT {{key}}, string_split(trim(regexp_replace(lower({{text}}), '[^\\p{{{{L}}}}\\p{{{{N}}}}]+', ' ', 'g')), ' ') AS w FROM {{table}}))"""
    wanted = cut.format(key="license", text="notice", table=f"(VALUES {quoted}) AS t(license, notice)").replace("{{", "{").replace("}}", "}")
    found = cut.format(key="doc_id", text="text", table="documents").replace("{{", "{").replace("}}", "}")
    return f"""WITH wanted AS ({wanted}),
held AS ({found}),
sizes AS (SELECT license, count(*) AS n_shingles FROM wanted GROUP BY license),
counted AS (SELECT doc_id, license, count(*) AS n_found FROM held JOIN wanted USING (shingle) GROUP BY doc_id, license)
SELECT doc_id, license, n_shingles, n_found, round(n_found / n_shingles, 6) AS containment
FROM counted JOIN sizes USING (license) WHERE n_found / n_shingles >= {containment}"""
