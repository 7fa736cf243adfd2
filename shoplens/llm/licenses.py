"""Licence scans: lines, paragraphs and whole texts compared to licence templates.

Both are normalised (lower case, letters and digits only) and cut into word bigrams. Their likeness is the Dice
coefficient of the two sets, 2 |A and B| / (|A| + |B|). It can reach a threshold t only if neither set is
more than (2 - t) / t times as large as the other, so most templates are left out by size before any bigram is
compared, and a bigram meets only templates that hold it. Everything is a column expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.tables import pick

THRESHOLD = 0.8
#: Template bigrams that are broadcast at most; beyond it Spark chooses the join.
BROADCAST_BIGRAMS = 100_000

# Notices in public use.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "MIT": "Released under the MIT License.",
    "MIT grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions:""",
    "MIT warranty": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
        TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "ISC grant": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD grant": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _templates(spark, templates: dict[str, str], threshold: float) -> DataFrame:
    """license, bigram, size and the sizes of units that it can match."""
    rows = [(name, bigram, len(found)) for name, text in templates.items() for found in [template_bigrams(text)] for bigram in found]
    widest = (2 - threshold) / threshold
    values = [f"('{name}', '{bigram}', {size}L)" for name, bigram, size in ((n.replace("'", "''"), b, s) for n, b, s in rows)]
    # A table of literals, so that no Python data source is on the path.
    known = spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS t(license, bigram, size)")
    known = known.withColumns({"least": F.ceil(F.col("size") / widest - 1e-9), "most": F.floor(F.col("size") * widest + 1e-9)})
    return F.broadcast(known) if len(rows) <= BROADCAST_BIGRAMS else known


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per unit of a text that is like a template: key, unit, place, license, dice, n_bigrams.

    Units are lines, paragraphs of several lines (between blank lines) and texts of several paragraphs; place
    counts them from 0 within their kind. Of templates that are equally like a unit the first by name is given.
    Null and empty texts have no units with bigrams, so no rows; repeated rows have each their own. Whole texts
    are scanned; their bigrams are compared as sets.
    """
    templates = TEMPLATES if templates is None else templates
    rows = pick(docs, key=key, text=text).withColumn("row", F.monotonically_increasing_id())
    schema = "key {}, unit string, place int, license string, dice double, n_bigrams long".format(rows.schema["key"].dataType.simpleString())
    sizes = [len(template_bigrams(t)) for t in templates.values() if template_bigrams(t)]
    if not sizes:
        return docs.sparkSession.createDataFrame([], schema)
    widest = (2 - threshold) / threshold
    least, most = max(1, min(sizes) / widest - 1e-9), max(sizes) * widest + 1e-9
    plain = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}\\p{N}\n]+", " ")
    shown = rows.select("key", "row", plain.alias("plain"))

    def bigrams(said: Column) -> Column:
        """Distinct bigrams of a unit. Its words are bound once, as the one element of an array."""
        words = F.array(F.filter(F.split(said, "[ \n]+"), lambda w: w != ""))
        pairs = F.transform(words, lambda w: F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)))
        return F.array_distinct(F.filter(F.get(pairs, F.lit(0)), lambda p: p.isNotNull()))

    def units(kind: str, pieces: Column) -> Column:
        return F.transform(pieces, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.alias("place"), bigrams(x).alias("bigrams")))

    paragraphs = F.split("plain", "\n(?: ?\n)+")
    # Only paragraphs of several lines; the place is counted before the others go.
    longer = F.filter(
        F.transform(paragraphs, lambda x, i: F.struct(i.alias("place"), x.alias("said"))),
        lambda p: F.contains(F.trim(p["said"]), F.lit("\n")),
    )
    several = F.when(F.size(paragraphs) > 1, F.array("plain")).otherwise(F.array().cast("array<string>"))
    all_units = F.concat(
        units("line", F.split("plain", "\n")),
        F.transform(longer, lambda p: F.struct(F.lit("paragraph").alias("unit"), p["place"].alias("place"), bigrams(p["said"]).alias("bigrams"))),
        units("text", several),
    )
    fitting = F.filter(all_units, lambda u: F.size(u["bigrams"]).between(F.lit(least), F.lit(most)))
    said = shown.select("key", "row", F.explode(fitting).alias("u")).select(
        "key", "row", "u.unit", "u.place", F.size("u.bigrams").cast("long").alias("n"), F.explode("u.bigrams").alias("said")
    )
    known = _templates(docs.sparkSession, templates, threshold)
    met = said.join(known, (F.col("said") == F.col("bigram")) & F.col("n").between(F.col("least"), F.col("most")))
    shared = met.groupBy("row", "key", "unit", "place", "n", "license", "size").agg(F.count("*").alias("shared"))
    alike = shared.withColumn("dice", F.lit(2.0) * F.col("shared") / (F.col("n") + F.col("size"))).where(F.col("dice") >= threshold)
    best = alike.groupBy("row", "key", "unit", "place", "n").agg(
        F.min(F.struct((-F.col("dice")).alias("less"), F.col("license").alias("license"))).alias("best")
    )
    return best.select(
        "key", "unit", "place", F.col("best.license").alias("license"), (-F.col("best.less")).alias("dice"), F.col("n").alias("n_bigrams")
    )
