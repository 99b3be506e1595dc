"""License scans (DataFrame functions only).

`licensed_windows` is what the query runs. A text is one run of words, across its lines, and every window of a passage's length that
starts at a word of the passage and holds one of its telling words is compared with it by cosine. Weights are inverse document
frequencies over all rows given, of the texts' words as of the passages'. All licenses reached are kept; own_license is the best.
A file covers its directory if it has a license and its name says so (FILE_NAME), or FILE_SHARE of its words belong to the license.

`scan` and `licensed` compare single lines with one sentence per license, weighed by the sentences alone. Each line of a text is a sparse TF-IDF vector over words (lower-case runs of letters and digits, joined by dots and hyphens) and is
compared by cosine with the templates' vectors. Inverse document frequencies are those of the templates; a word that no template
has weighs most. A line reaches a template at THRESHOLD or more. Only lines with a telling word of a template are taken apart: a
template's other words make up less than THRESHOLD of its vector, so a line with those alone can't reach it.

A text's license is that of its best line. A licence file (a text of few words, whose license is found by itself) covers its
directory and all below: every directory inherits from its nearest ancestor that holds one, by a join of ancestor paths, and texts
without a license of their own take the directory's. Directories, not texts, are joined with ancestors.

Nulls and ties, where windows of equal cosine go to the license with more words of the text first: null and empty texts have no license of their own. Equal cosines go to the template first by name, then the first
line; among licence files of a directory the best cosine, then the least license name. A null path has no directory and inherits
nothing. Repeated rows are scanned alike. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.llm.shared import cut, n_words
from specspark.operators.layout import maybe_broadcast

THRESHOLD = 0.7
FILE_WORDS = 40
#: Names of licence files, in any case: LICENSE, COPYING and their kin, with or without an ending.
FILE_NAME = r"(?i)^(?:un)?(?:licen[sc]es?|copying|copyright)(?:[._-].*)?$"
#: A text of any name is a licence file if this part of its words belongs to a reached passage.
FILE_SHARE = 0.8
#: Wording of common license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
STOP = frozenset("a and any for in is of on or that the this to under with".split())
WORDS = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


#: Passages of the notices and texts themselves, besides TEMPLATES. A license can have several.
PASSAGES = tuple((name.removesuffix("-text"), text) for name, text in TEMPLATES.items()) + (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MIT", "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("MIT", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    ("ISC", "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("ISC", "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
) + tuple((name, text) for name in ("BSD-2-Clause", "BSD-3-Clause") for text in (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage",
)) + (("BSD-2-Clause", TEMPLATES["BSD-3-Clause"]),)


def template_vectors(templates: dict[str, str]) -> tuple[dict[str, dict[str, float]], dict[str, float], float]:
    """Unit vectors of the templates, the weights of their words, and the weight of a word that none has."""
    counts = {name: Counter(re.findall(WORDS, text.lower())) for name, text in templates.items()}
    seen = Counter(w for c in counts.values() for w in c)
    weight = {w: math.log((1 + len(counts)) / (1 + n)) + 1 for w, n in seen.items()}
    unit = {}
    for name, c in counts.items():
        size = math.sqrt(sum((n * weight[w]) ** 2 for w, n in c.items()))
        unit[name] = {w: n * weight[w] / size for w, n in c.items()}
    return unit, weight, math.log(1 + len(counts)) + 1


def telling(unit: dict, common: dict[str, int] | None = None) -> set[str]:
    """Words of which a line must have one to reach any template. By Cauchy and Schwarz a line that shares only the words W with a
    template has a cosine of at most the length of the template's part in W; common words (by their counts, if given) are left out up to that length."""
    kept = set()
    for vector in unit.values():
        left = THRESHOLD ** 2 * 0.999
        for word in sorted(vector, key=lambda w: (-common.get(w, 0), w) if common is not None else (w not in STOP, len(w), w)):
            left -= vector[word] ** 2
            if left <= 0:
                kept.add(word)
    return kept


def scan(texts: DataFrame, key: str, text: str, templates: dict[str, str] | None = None) -> DataFrame:
    """key, license, similarity, line: the best line of every row that has one. key: unique name of a row."""
    spark = texts.sparkSession
    unit, weight, other = template_vectors(templates or TEMPLATES)
    own = "|".join(re.escape(w) for w in sorted(telling(unit)))
    lines = texts.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line", "_words")).where(F.lower("_words").rlike(rf"(?<![a-z0-9])(?:{own})(?![a-z0-9])"))
    words = lines.select(key, "line", F.explode(F.regexp_extract_all(F.lower("_words"), F.lit(rf"({WORDS})"), F.lit(1))).alias("word"))
    counted = words.groupBy(key, "line", "word").agg(F.count(F.lit(1)).alias("n"))
    # a table of the templates' words, as large as the templates
    vocabulary = spark.createDataFrame([(w, weight[w], [(name, v[w]) for name, v in unit.items() if w in v]) for w in weight],
                                       "word string, weight double, at array<struct<name:string,part:double>>")
    weighed = counted.join(F.broadcast(vocabulary), "word", "left").withColumn("tf", F.col("n") * F.coalesce("weight", F.lit(other)))
    names = sorted(unit)
    part = lambda name: F.sum(F.col("tf") * F.coalesce(F.get(F.filter("at", lambda x: x["name"] == name), F.lit(0))["part"], F.lit(0.0)))
    found = weighed.groupBy(key, "line").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("size"), *[part(n).alias(f"t{i}") for i, n in enumerate(names)])
    best = F.greatest(*[F.struct(F.round(F.col(f"t{i}") / F.col("size"), 9).alias("similarity"), F.lit(-i).alias("i")) for i in range(len(names))])
    reached = found.select(key, "line", best.alias("best")).where(F.col("best.similarity") >= THRESHOLD)
    top = reached.groupBy(key).agg(F.max(F.struct("best.similarity", "best.i", (-F.col("line")).alias("line"))).alias("top"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), 1 - F.col("top.i"))
    return top.select(key, name.alias("license"), F.col("top.similarity").alias("similarity"), (-F.col("top.line")).alias("line"))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(rf"({WORDS})"), F.lit(1))


def scan_windows(texts: DataFrame, key: str, text: str, passages: Sequence[tuple[str, str]] = PASSAGES) -> DataFrame:
    """key, license, similarity, line, covered: a row for every license that a text reaches, with the best window's cosine and the line
    it starts in, and the number of words of the text that belong to a reached passage of the license. key: unique name of a row."""
    spark = texts.sparkSession
    rows = texts.count()
    seen = cut(texts.select(F.explode(F.array_distinct(words_of(F.col(text)))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    counts = [Counter(re.findall(WORDS, passage.lower())) for _, passage in passages]
    known = sorted({w for c in counts for w in c})
    # as many rows as the passages have words
    common = {r["word"]: r["n"] for r in seen.where(F.col("word").isin(known)).collect()}
    weight = {w: math.log((1 + rows) / (1 + common.get(w, 0))) + 1 for w in known}
    template, part = [], []
    for i, ((name, _), c) in enumerate(zip(passages, counts)):
        size = math.sqrt(sum((n * weight[w]) ** 2 for w, n in c.items()))
        unit = {w: n * weight[w] / size for w, n in c.items()}
        template.append((i, name, sum(c.values()), sorted(telling({i: unit}, common)), {w: (weight[w] * u, weight[w] ** 2) for w, u in unit.items()}))
        part.append((name, unit))
    tells = sorted({w for t in template for w in t[3]})
    longest = max(t[2] for t in template)
    asked = spark.createDataFrame(template, "t int, license string, length int, tell array<string>, parts map<string,struct<dot:double,own:double>>")
    asked = F.broadcast(asked.withColumn("word", F.explode("tell")))

    some = texts.where(F.lower(text).rlike(rf"(?<![a-z0-9])(?:{'|'.join(map(re.escape, tells))})(?![a-z0-9])"))
    lines = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.transform(words_of(x), lambda w: F.struct(w.alias("word"), i.alias("line"))))
    run = some.select(key, F.flatten(lines).alias("w"))
    told = F.array(*[F.lit(w) for w in tells])
    places = F.filter(F.transform("w", lambda x, i: F.when(F.array_contains(told, x["word"]), i)), lambda i: i.isNotNull())
    # what a window that holds the word at p can reach, and p's place in it
    near = run.select(key, "w", F.explode(places).alias("p")).select(
        key, F.greatest(F.col("p") - longest + 1, F.lit(0)).alias("from"), "p", F.col("w")[F.col("p")]["word"].alias("word"),
        F.expr(f"slice(w, greatest(p - {longest} + 1, 0) + 1, p - greatest(p - {longest} + 1, 0) + {longest})").alias("w"))
    at = near.join(asked, "word").withColumn("a", F.col("p") - F.col("from"))
    # each window belongs to its first telling word, so none is met twice
    before = F.expr("coalesce(array_max(filter(transform(slice(w, 1, a), (x, i) -> if(array_contains(tell, x.word), i, null)), i -> i is not null)), -1)")
    least = F.greatest(F.col("a") - F.col("length") + 1, before + 1)
    begins = F.filter(F.sequence(least, F.col("a")), lambda s: F.array_contains(F.map_keys("parts"), F.col("w")[s]["word"]))
    windows = at.select(key, "t", "license", "length", "parts", "from", "w", F.explode(begins).alias("s")).select(
        key, "t", "license", "parts", (F.col("from") + F.col("s")).alias("s"), F.col("w")[F.col("s")]["line"].alias("line"),
        F.expr("transform(slice(w, s + 1, length), x -> x.word)").alias("w"))
    # a word weighs 1 at least and counts once at least: no window is left out that could reach THRESHOLD
    most = F.expr("aggregate(w, struct(0D AS dot, 0D AS own), (z, x) -> struct(z.dot + coalesce(parts[x].dot, 0D) AS dot, z.own + coalesce(parts[x].own, 1D) AS own), z -> z.dot / sqrt(z.own))")
    windows = cut(windows.where(most >= THRESHOLD * 0.999999).drop("parts"))

    words = windows.select(key, "t", "license", "s", "line", F.posexplode("w").alias("i", "word"))
    needed = maybe_broadcast(seen.join(words.select("word").distinct(), "word", "left_semi"))
    vectors = spark.createDataFrame([(i, w, u) for i, (_, v) in enumerate(part) for w, u in v.items()], "t int, word string, part double")
    # repeated rows have one key: a place counts once
    counted = words.join(F.broadcast(vectors), ["t", "word"], "left").groupBy(key, "t", "license", "s", "line", "word", "part").agg(F.collect_set("i").alias("i"))
    counted = counted.withColumn("at", F.when(F.col("part").isNotNull(), F.transform("i", lambda i: F.col("s") + i)))
    tf = F.size("i") * (F.log(F.lit(1.0 + rows) / (1 + F.col("n"))) + 1)
    scored = counted.join(needed, "word").groupBy(key, "t", "license", "s", "line").agg(
        F.round(F.sum(tf * F.coalesce("part", F.lit(0.0))) / F.sqrt(F.sum(tf * tf)), 9).alias("similarity"), F.flatten(F.collect_list("at")).alias("at"))
    reached = scored.where(F.col("similarity") >= THRESHOLD)
    return reached.groupBy(key, "license").agg(
        F.max(F.struct("similarity", (-F.col("line")).alias("line"))).alias("top"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")).select(
        key, "license", F.col("top.similarity").alias("similarity"), (-F.col("top.line")).alias("line"), F.size("at").alias("covered"))


def _placed(files: DataFrame, path: Column, key: str, text: str) -> DataFrame:
    rows = files.select(F.col(key), path.alias("path"), F.col(text).alias("_text"), F.xxhash64(key, text, path).alias("_row"))
    return rows.withColumn("dir", F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit("")))


def _inherit(own: DataFrame, carry: list[str]) -> DataFrame:
    """carry, license, inherited_from: own, a written table with path, dir, own_license, similarity and _file, and what its
    directories inherit."""
    covers = own.where(F.col("_file") & F.col("own_license").isNotNull() & F.col("path").isNotNull()).groupBy("dir").agg(
        F.min(F.struct((-F.col("similarity")).alias("far"), "own_license")).alias("best")).select(
        F.col("dir").alias("ancestor"), F.col("best.own_license").alias("covering"))
    asks = own.where(F.col("own_license").isNull() & F.col("path").isNotNull()).select("dir").distinct()
    ancestors = asks.select("dir", F.explode(F.expr("transform(sequence(0, size(split(dir, '/'))), i -> array_join(slice(split(dir, '/'), 1, i), '/'))")).alias("ancestor"))
    nearest = ancestors.join(covers, "ancestor").groupBy("dir").agg(
        F.max(F.struct(F.length("ancestor").alias("depth"), "ancestor", "covering")).alias("near")).select(
        "dir", F.col("near.ancestor").alias("from"), F.col("near.covering").alias("covering"))
    joined = own.join(cut(nearest), "dir", "left")
    bare = F.col("own_license").isNull()
    return joined.select(*carry, F.when(bare, F.col("covering")).otherwise(F.col("own_license")).alias("license"),
                         F.when(bare, F.col("from")).alias("inherited_from"))


def licensed(files: DataFrame, path: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, path, own_license, similarity, line, license, inherited_from (the directory, if it is not the text's own): one row a
    file, by single lines. path: directories joined by /, the file's name last."""
    rows = _placed(files, path, key, text)
    found = scan(rows.select("_row", "_text"), "_row", "_text")
    slim = rows.select(key, "path", "dir", "_row", (n_words(F.col("_text")) <= FILE_WORDS).alias("_file"))
    own = cut(slim.join(found, "_row", "left").withColumnRenamed("license", "own_license"))
    return _inherit(own, [key, "path", "own_license", "similarity", "line"])


def licensed_windows(files: DataFrame, path: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, path, own_license, similarity, line, found (license, similarity and line of every license reached, by name), license,
    inherited_from: one row a file, by windows over the whole text."""
    rows = _placed(files, path, key, text)
    each = scan_windows(rows.select("_row", "_text"), "_row", "_text")
    found = each.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("license", "similarity", "line", "covered"))).alias("_all"))
    called = F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(FILE_NAME), F.lit(False))
    slim = rows.select(key, "path", "dir", "_row", called.alias("_called"), F.coalesce(F.size(words_of(F.col("_text"))), F.lit(0)).alias("_words"))
    best = F.array_min(F.transform("_all", lambda x: F.struct((-x["similarity"]).alias("far"), (-x["covered"]).alias("few"), x["license"].alias("license"), x["line"].alias("line"))))
    named = F.transform("_all", lambda x: F.struct(x["license"].alias("license"), x["similarity"].alias("similarity"), x["line"].alias("line")))
    file = F.col("_called") | (-F.col("_best.few") >= FILE_SHARE * F.col("_words"))
    own = cut(slim.join(found, "_row", "left").withColumn("_best", best).select(
        key, "path", "dir", file.alias("_file"), F.col("_best.license").alias("own_license"), (-F.col("_best.far")).alias("similarity"),
        F.col("_best.line").alias("line"), F.coalesce(named, F.array().cast("array<struct<license:string,similarity:double,line:int>>")).alias("found")))
    return _inherit(own, [key, "path", "own_license", "similarity", "line", "found"])
