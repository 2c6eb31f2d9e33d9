"""License scans: MinHash bands over text windows retrieve templates, shingles verify them.

A template of t word shingles is looked for in windows of 2t shingles that start every t
shingles, so each run of t shingles lies whole in some window. A window that holds a
share c of the template has a Jaccard similarity of at least c / (3 - c) with it; with
``BANDS`` bands of one MinHash value and c = 0.8 it is missed with a chance of
(1 - 0.8 / 2.2) ** BANDS, below 1e-9 at 48.

A band can only agree where the window holds the very shingle that gives the template's
minimum. So windows are formed around these shingles alone, which changes nothing in
what the bands retrieve.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.common import whole_text

#: Words of a shingle; bands of one MinHash value.
SHINGLE, BANDS = 5, 48
#: Most template rows. What is broadcast has this bound, whatever the corpus.
MOST_TEMPLATES = 2000

# Fixed values, down to _WORDINGS: what public licenses say of themselves.

# Sentences by which they are usually named.
_SENTENCES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification,"
        " are permitted provided that the following conditions are met",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose"
        " with or without fee is hereby granted",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Headers and paragraphs of the licenses. At 0.8 containment one of 45 words stands an
# edited word or two; longer ones are stated paragraph by paragraph.
_PARAGRAPHS = (
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        ' License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,'
        " either express or implied.",
    ),
    (
        "BSD",
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
    ),
    (
        "BSD",
        "Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a"
        " copy of the software and accompanying documentation covered by this license",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License 2.0",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation; either"
        " version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation; either"
        " version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MIT",
        "to deal in the Software without restriction, including without limitation the rights to"
        " use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so",
    ),
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ),
    (
        "MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,"
        " either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial"
        " applications, and to alter it and redistribute it freely, subject to the following"
        " restrictions",
    ),
)

# Names that a short notice puts after one of _WORDINGS.
_NAMES = (
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License")),
    ("BSD", ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "3-Clause BSD License")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("EPL-2.0", ("Eclipse Public License 2.0", "Eclipse Public License v2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3")),
    ("ISC", ("ISC License",)),
    ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0")),
    ("MIT", ("MIT License",)),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0")),
)

# Creative Commons licenses: the code in names and addresses, and the long name.
_COMMONS = (
    ("BY", "Attribution"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-SA", "Attribution-ShareAlike"),
)

_WORDINGS = (
    "Licensed under the {}",
    "Released under the {}",
    "Distributed under the {}",
    "Available under the {}",
    "Under the terms of the {}",
)


def _templates() -> tuple[tuple[str, str], ...]:
    """Sentences, paragraphs, names in every wording, Creative Commons forms and SPDX lines.

    An SPDX line of four words (``MIT``, ``ISC``) is too short for a shingle and left out.
    """
    found = [*_SENTENCES, *_PARAGRAPHS]
    found += [(code, wording.format(name)) for code, names in _NAMES for name in names for wording in _WORDINGS]
    for code, name in _COMMONS:
        license = f"CC-{code}-4.0"
        found += [
            (license, f"Licensed under CC {code} 4.0"),
            (license, f"Licensed under a Creative Commons {name} 4.0 International License"),
            (license, f"Licensed under the Creative Commons {name} 4.0 International License"),
            (license, f"creativecommons.org/licenses/{code.lower()}/4.0"),
            (license, f"SPDX-License-Identifier: {license}"),
        ]
    found += [(code, f"SPDX-License-Identifier: {code}") for code, _ in _NAMES if code[-1].isdigit()]
    found += [("BSD", f"SPDX-License-Identifier: BSD-{k}-Clause") for k in (2, 3)]
    by_words: dict[tuple[str, str], tuple[str, str]] = {}
    for code, text in found:
        by_words.setdefault((code, " ".join(re.findall(r"[^\W_]+", text.lower()))), (code, text))
    return tuple(by_words.values())


#: The default templates, no two of the same license and words.
NOTICES = _templates()


def notices(spark: SparkSession) -> DataFrame:
    """The templates above as a table."""
    return spark.createDataFrame(list(NOTICES), "license string, text string")


def license_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashes(words: Column) -> Column:
    """A hash for each shingle, in order."""
    return F.when(
        F.size(words) >= SHINGLE,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)),
            lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(SHINGLE)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _shingles(words: str, start: str, count: str) -> Column:
    """The distinct shingles themselves, of ``count`` starts from ``start`` (from 0)."""
    last = f"least({start} + {count}, size({words}) - {SHINGLE - 1})"
    return F.expr(
        f"array_distinct(transform(sequence({start} + 1, {last}),"
        f" i -> array_join(slice({words}, i, {SHINGLE}), ' ')))"
    )


def _first_held() -> Column:
    """Where in the text (from 0) the window's first shingle of the template starts."""
    return F.expr(
        f"first + array_position(transform(sequence(int(first) + 1,"
        f" least(int(first) + 2 * t, size(w) - {SHINGLE - 1})),"
        f" i -> array_contains(shingles, array_join(slice(w, i, {SHINGLE}), ' '))), true) - 1"
    )


def find_licenses(
    docs: DataFrame,
    templates: DataFrame | None = None,
    min_containment: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``license``, ``containment``, ``n_windows`` for every license in a text.

    ``templates`` has columns ``license`` and ``text`` (default: ``notices``), at most
    ``MOST_TEMPLATES`` rows; those of fewer than five words can't be looked for and are
    left out. ``containment``: the best share of a template's distinct shingles in one
    window, at least ``min_containment``; ``n_windows``: windows that reach it, over the
    license's templates. Where notices of several licenses start within ten words of each
    other, only those with the best containment count. DataFrame functions only; texts are read once, and only
    matches are shuffled.

    Null, empty and short texts have no license; repeated rows are reported each; other
    columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    templates = notices(spark) if templates is None else templates
    known = (
        templates.select("license", license_words(F.coalesce("text", F.lit(""))).alias("tw"))
        .filter(F.size("tw") >= SHINGLE)
        .distinct()
        .withColumn("th", _hashes(F.col("tw")))
        .withColumn("t", F.size("th"))
        .withColumn("shingles", _shingles("tw", "0", "t"))
        .withColumn(
            "lowest",
            F.expr(
                f"transform(sequence(1, {BANDS}), b -> array_min(transform(th,"
                " s -> struct(xxhash64(s, b) AS m, s AS s))))"
            ),
        )
        .select(
            F.xxhash64("license", F.array_join("tw", " ")).alias("template"),
            "license",
            "t",
            "shingles",
            F.col("lowest.m").alias("minima"),
            F.array_distinct("lowest.s").alias("signs"),
        )
    )
    rows = known.limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    known = spark.createDataFrame(rows, known.schema)
    signs = sorted({s for r in rows for s in r.signs})
    wanted = F.lit(signs) if signs else F.array().cast("array<bigint>")
    marked = (
        whole_text(docs, id_col, text_col)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            license_words(F.col("text")).alias("w"),
        )
        .withColumn("h", _hashes(F.col("w")))
        .filter(F.arrays_overlap("h", wanted))
        .withColumn("signs", F.array_intersect("h", wanted))
    )
    placed = (
        marked.select("*", F.posexplode("h").alias("place", "sign"))
        .filter(F.expr("array_contains(signs, sign)"))
        .drop("signs")
    )
    windows = (
        placed.join(
            F.broadcast(known.withColumn("sign", F.explode("signs")).drop("signs")), "sign"
        )
        .withColumn("first", F.explode(F.expr("array_distinct(array(greatest(place div t - 1, 0), place div t)) ")))
        .withColumn("first", F.col("first") * F.col("t"))
        .withColumn("near", F.expr("slice(h, int(first) + 1, 2 * t)"))
        .filter(
            F.expr(
                f"exists(sequence(1, {BANDS}), b -> array_min(transform(near,"
                " s -> xxhash64(s, b))) = element_at(minima, b))"
            )
        )
        .withColumn("held", _shingles("w", "int(first)", "2 * t"))
        .withColumn(
            "containment",
            F.size(F.array_intersect("held", "shingles")) / F.size("shingles"),
        )
        .filter(F.col("containment") >= min_containment)
        .withColumn("place", _first_held())
    )
    # a notice may hold most of another license's: of what lies close together the best stays
    close = Window.partitionBy("row").orderBy("place").rangeBetween(-2 * SHINGLE, 2 * SHINGLE)
    return (
        windows.groupBy("row", "doc_id", "license", "template", "first")
        .agg(F.max("containment").alias("containment"), F.min("place").alias("place"))
        .withColumn("best", F.max("containment").over(close))
        .filter("containment = best")
        .groupBy("row", "doc_id", "license")
        .agg(F.max("containment").alias("containment"), F.count("*").alias("n_windows"))
        .drop("row")
    )
