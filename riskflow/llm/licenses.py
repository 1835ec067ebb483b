"""Licence scans: sparse TF-IDF cosine of passages to templates, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import ascii_lower, saved, text_of

# Licence identifiers with the sentences that state them and the headers that are longer than a sentence.
BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
BSD_FIRST = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
BSD_SECOND = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
BSD_THIRD = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
BSD_END = "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."
MIT_HEADER = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
TEMPLATES = {
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", BSD_OPENING + BSD_FIRST + BSD_SECOND + BSD_END, "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        BSD_OPENING + BSD_FIRST + BSD_SECOND + BSD_THIRD + BSD_END,
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL-2.1": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        MIT_HEADER,
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)(\.[a-z]+)?$"
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
LEAD = r"(?m)^[^\w\n]+(?:[0-9][.)][\x20\t]+)?|^[0-9][.)][\x20\t]+"  # comment and list marks at the start of a line
SENTENCE_END = r"\n{2,}|(?<=[.!?:])\s+"
BUCKETS = 1 << 18  # terms are counted in so many hashed buckets, which bounds the table that is broadcast


def terms(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def sentences(text: str) -> list[str]:
    return re.split(SENTENCE_END, re.sub(LEAD, "", text, flags=re.ASCII))


def sentence_list(text: Column) -> Column:
    """Sentences over wrapped lines: marks of comments and lists go, blank lines end a sentence as well."""
    return F.split(F.regexp_replace(text, LEAD, ""), SENTENCE_END)


def term_list(text: Column) -> Column:
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS))


def term_weights(texts: DataFrame, n: int) -> DataFrame:
    """(bucket, idf) over all texts: each counts a bucket once. Buckets that no text has are left out."""
    once = texts.select(F.explode(F.array_distinct(F.transform(term_list(F.col("text")), bucket))).alias("bucket"))
    counts = once.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    return saved(counts.select("bucket", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf")), "idf")


def template_rows(spark: SparkSession, weights: DataFrame, unseen: float, templates: dict[str, list[str]], threshold: float) -> tuple[DataFrame, list[str]]:
    """(template, licence, term, weight) with unit length, and the anchors: the terms of which a passage must have one to reach
    the threshold with any template of one sentence, or with the first sentence of a longer one, since the rest is too light
    for that. The commonest terms make up the rest, so few passages hold an anchor."""
    texts = [(name, text) for name, all_ in sorted(templates.items()) for text in all_]
    every = sorted({(t,) for _, text in texts for t in terms(text)})
    listed = spark.createDataFrame(every, "term string").withColumn("bucket", bucket(F.col("term")))
    idf = {r["term"]: r["idf"] for r in listed.join(weights, "bucket", "left").select("term", F.coalesce("idf", F.lit(unseen)).alias("idf")).collect()}
    anchors, out = set(), []
    for i, (name, text) in enumerate(texts):
        own = unit({t: n * idf[t] for t, n in Counter(terms(text)).items()})
        out += [(i, name, t, w) for t, w in own.items()]
        light = 0.0
        opening = unit({t: n * idf[t] for t, n in Counter(terms(sentences(text)[0])).items()})
        for t in sorted(opening, key=lambda t: (idf[t], t)):
            light += opening[t] ** 2
            if math.sqrt(light) >= threshold - 1e-9:
                anchors.add(t)
    return spark.createDataFrame(out, "template int, licence string, term string, weight double"), sorted(anchors)


def unit(weights: dict[str, float]) -> dict[str, float]:
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()}


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = 0.7,
    file_share: float = 0.5,
) -> DataFrame:
    """Per row: id, path, ``licence`` (own), ``score``, ``passage`` (its number), ``licence_file``, ``effective_licence``,
    ``inherited_from`` (directory).

    Passages are the lines of the whole text, cut at sentence ends, and its sentences over wrapped lines, without marks of
    comments and lists; where a template has more sentences, as many from each sentence on. Each passage whose first
    sentence holds an anchor term is weighed by TF-IDF, with document frequencies over all texts, and compared with all
    templates; the best gives the row its licence (ties: first passage by its number among lines or sentences, lines
    first, then first licence by name). A row is a licence file if its path says so or ``file_share`` of its words stand
    in matching lines, in matching sentences, or in one matching header. Rows without licence take that of the nearest ancestor directory that holds a
    licence file (of several, the best score, then the smallest path).

    Null and empty texts have no licence of their own; a null path has no directories. Rows that repeat an id or path
    each have their result. An empty table gives no rows. Extra columns are ignored.
    """
    spark, templates = docs.sparkSession, TEMPLATES if templates is None else templates
    texts = docs.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), text_of(text_col).alias("text"))
    n = texts.count()
    weights, unseen = term_weights(texts, n), math.log(1 + n) + 1
    listed, anchors = template_rows(spark, weights, unseen, templates, threshold)
    any_anchor = r"(?i)(?<![a-z0-9])(?:" + "|".join(map(re.escape, anchors)) + r")(?![a-z0-9])" if anchors else r"(?!)"
    lines = F.when(F.col("text").rlike(any_anchor), F.split("text", r"\n|(?<=[.!?;])\s+"))
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("passage"), line.alias("line")))
    lone = F.filter(numbered, lambda p: p["line"].rlike(any_anchor))
    sizes = sorted({len(sentences(text)) for all_ in templates.values() for text in all_})
    whole = F.when(F.col("text").rlike(any_anchor), sentence_list(F.col("text")))
    size = F.when(F.col("text").rlike(any_anchor), F.size(term_list(F.col("text"))))
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "id", "path", size.alias("words"), lone.alias("lone"), whole.alias("whole"))
    starts = F.filter(F.transform("whole", lambda line, i: F.struct(i.alias("passage"), line.alias("line"))), lambda p: p["line"].rlike(any_anchor))

    def joined(n: int) -> Column:
        return F.transform(starts, lambda p: F.struct(p["passage"].alias("passage"), F.lit(n).alias("size"), F.array_join(F.slice("whole", p["passage"] + 1, n), " ").alias("line")))

    alone = F.transform("lone", lambda p: F.struct(p["passage"].alias("passage"), F.lit(0).alias("size"), p["line"].alias("line")))
    found = F.concat(alone, *[joined(n) for n in sizes])
    each = rows.select("row", "id", "path", "words", F.explode_outer(found).alias("p"))
    passages = saved(each.select("row", "id", "path", "words", "p.passage", "p.size", "p.line"), "passages")

    words = passages.where("line IS NOT NULL").select("row", "passage", "size", F.explode(term_list(F.col("line"))).alias("term"))
    counted = words.groupBy("row", "passage", "size", "term").agg(F.count(F.lit(1)).alias("tf")).withColumn("bucket", bucket(F.col("term")))
    weighed = counted.join(F.broadcast(weights), "bucket", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    norms = weighed.groupBy("row", "passage", "size").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("tf").alias("words_in"))
    dots = weighed.join(F.broadcast(listed), "term").groupBy("row", "passage", "size", "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, ["row", "passage", "size"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= threshold)
    top = F.min(F.struct((-F.col("score")).alias("minus"), "passage", "size", "licence"))
    one = scored.groupBy("row", "passage", "size", "words_in").agg(top.alias("top"))
    apart = [F.coalesce(F.sum(F.when(F.col("size") == n, F.col("words_in"))), F.lit(0)) for n in (0, 1)]
    best = one.groupBy("row").agg(F.min("top").alias("best"), F.greatest(*apart, F.max("words_in")).alias("matched"))
    files = passages.groupBy("row").agg(F.first("id").alias("id"), F.first("path").alias("path"), F.max("words").alias("words"))
    own = files.join(best, "row", "left").select(
        "row",
        "id",
        "path",
        F.col("best.licence").alias("licence"),
        (-F.col("best.minus")).alias("score"),
        F.col("best.passage").alias("passage"),
        F.coalesce(F.col("best").isNotNull() & (F.col("path").rlike(LICENCE_FILE) | (F.col("matched") >= file_share * F.col("words"))), F.lit(False)).alias("licence_file"),
    )
    own = saved(own, "licences")

    first = F.min(F.struct((-F.col("score")).alias("minus"), "path", "licence")).alias("top")
    folders = own.where(F.col("licence_file") & F.col("path").isNotNull()).groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).agg(first)
    folders = saved(folders.select("folder", F.col("top.licence").alias("given")), "folders")
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("folder")))
    bare = own.where("licence IS NULL AND path IS NOT NULL").select("row", F.explode(above).alias("up")).select("row", "up.*")
    nearest = bare.join(folders, "folder").groupBy("row").agg(F.max(F.struct("depth", "folder", "given")).alias("near"))
    return own.join(nearest, "row", "left").select(
        F.col("id").alias(id_col),
        F.col("path").alias(path_col),
        "licence",
        "score",
        "passage",
        "licence_file",
        F.coalesce("licence", F.col("near.given")).alias("effective_licence"),
        F.col("near.folder").alias("inherited_from"),
    )

