"""Operator 3: licence scans, in DataFrame functions only.

Texts are normalised (ASCII letters and digits, lower case, single spaces) and
cut into units: every line, every paragraph of several lines, and the whole
text if it has several paragraphs. A unit and a licence template are sets of
word bigrams; they match if their Dice coefficient 2|A n B| / (|A| + |B|) is
at least ``least``. That needs |A| within [least / (2 - least), (2 - least) /
least] times |B|, which prunes templates before any bigram is compared. Units
that still have a template are joined on their bigrams to the templates'
(a fixed list, a few thousand rows) and counted.

Passages are the notices that are no unit of their own: inside a sentence, or
over several lines or paragraphs above other text. A passage is a run of
consecutive words, at most (2 - least) / least times as long as the template;
it may begin at every bigram that the template has, and ends where its Dice
coefficient is greatest. Every template's bigrams are found in chunks of the
text, and only chunks that hold enough of one template are looked at closer.
Of passages that overlap the best stays, then the best of the others, and so on.
Inside a chunk a bigram is a hash of which one bit says whether the template
has it, so runs are arrays of longs and no bigram is compared as text twice.

Defined results: a null or empty text, or a unit of one word, has no bigram
and no match; a unit that matches several templates gets the best, of equals
the first by name; of equal passages the first name, then the first place;
rows with equal doc_id and equal text report once; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

LEAST = 0.8
CHUNK = 4096  # words in which one row looks for the beginnings of passages

# The wording of public licences and of their usual notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
     "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
     "See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
     "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
     "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
     "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
     "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
     "your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
     "rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-Rights-Reserved", "All rights reserved. No part of this publication may be reproduced."),
)


def _pairs(text: Column) -> Column:
    """Pairs of neighbouring words, in order. The pattern finds the pair that
    begins at each word without moving on, so the text is normalised once."""
    words = F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " "))
    return F.regexp_extract_all(words, F.lit("(?<![^ ])(?=([^ ]+ [^ ]+))"), F.lit(1))


def _bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return F.array_distinct(_pairs(text))


def template_bigrams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, size, bigram): a row for each bigram."""
    rows = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(templates)],
                                 "template int, license string, body string")
    rows = rows.withColumn("set", _bigrams(F.col("body")))
    return rows.select("template", "license", F.size("set").alias("size"), F.explode("set").alias("bigram"))


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, unit, unit_no, mark, set): lines, paragraphs and whole texts
    with a hash of their text and their bigrams."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    several = F.col("body").rlike(r"\n[ \t\r]*\n")
    paragraphs = F.filter(F.transform(F.split("body", r"\n[ \t\r]*\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                          lambda p: F.instr(p["x"], "\n") > 0)

    def unit(name: str, x: Column, i: Column) -> Column:
        return F.struct(F.lit(name).alias("unit"), i.cast("int").alias("unit_no"), F.xxhash64(x).alias("mark"),
                        _bigrams(x).alias("set"))

    every = F.concat(
        F.transform(F.split("body", "\n"), lambda x, i: unit("line", x, i)),
        F.transform(paragraphs, lambda p: unit("paragraph", p["x"], p["i"])),
        F.transform(F.when(several, F.array("body")).otherwise(F.array().cast("array<string>")),
                    lambda x, i: unit("text", x, i)))
    return text.select("doc_id", F.explode(every).alias("u")).select("doc_id", "u.*")


def license_scan(docs: DataFrame, least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """(doc_id, unit, unit_no, license, dice): each unit's best template, if
    its Dice coefficient is at least ``least``."""
    known = template_bigrams(docs.sparkSession, templates)
    sizes = sorted({len(_python_bigrams(t)) for _, t in templates})  # |B| of the templates
    low, high = least / (2 - least), (2 - least) / least
    n = F.size("set")
    fits = F.lit(False)
    for s in sizes:
        fits = fits | ((n >= low * s - 1e-9) & (n <= high * s + 1e-9))
    found = units(docs).where(fits).select("doc_id", "unit", "unit_no", "mark", n.alias("own"),
                                           F.explode("set").alias("bigram"))
    pairs = (found.join(F.broadcast(known), "bigram")  # a fixed list of templates
             .where((F.col("own") >= low * F.col("size") - 1e-9) & (F.col("own") <= high * F.col("size") + 1e-9)))
    dice = 2.0 * F.countDistinct("bigram") / (F.col("own") + F.col("size"))
    scored = (pairs.groupBy("doc_id", "unit", "unit_no", "mark", "own", "template", "license", "size")
              .agg(dice.alias("dice")).where(F.col("dice") >= least - 1e-9))
    # the greatest Dice first, of equals the first name
    return (scored.groupBy("doc_id", "unit", "unit_no", "mark")
            .agg(F.min(F.struct((-F.col("dice")).alias("worst"), "license")).alias("best"))
            .select("doc_id", "unit", "unit_no", F.col("best.license").alias("license"),
                    (-F.col("best.worst")).alias("dice")))


def license_passages(docs: DataFrame, least: float = LEAST, templates=TEMPLATES, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, first_word, last_word, license, dice): the passages of each
    text, words counted from 0."""
    low, high = least / (2 - least), (2 - least) / least
    longest, fewest, rows, sets = 1, 1 << 30, [], []
    for name, body in templates:
        pairs = [" ".join(p) for p in _python_pairs(body)]
        own = sorted(set(pairs))
        if own:
            need, span = math.ceil(low * len(own) - 1e-9), math.floor(high * len(pairs) + 1e-9)
            longest, fewest = max(longest, span), min(fewest, need)
            rows.append(F.struct(F.lit(len(sets)).alias("k"), F.lit(name).alias("license"), F.array(*map(F.lit, own)).alias("set"),
                                 F.lit(need).alias("need"), F.lit(span).alias("span"), F.lit(len(own)).alias("size")))
            sets.append(own)
    known = sorted({x for own in sets for x in own})
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    text = text.select("doc_id", F.xxhash64("body").alias("mark"), _pairs(F.col("body")).alias("seq"))

    # Each step explodes what it found, so that no array is made twice. A chunk
    # holds the whole of every passage that begins in its first ``chunk`` words.
    def cut(at: Column) -> Column:
        part = F.slice("seq", at + 1, chunk + longest)
        hits = F.filter(part, lambda x: x.isin(known))
        return F.struct(at.alias("at"), part.alias("part"), F.array_distinct(hits).alias("hits"))

    begins = F.sequence(F.lit(0), F.greatest(F.size("seq") - 1, F.lit(0)), F.lit(chunk))
    chunks = text.select("doc_id", "mark", F.explode(F.transform(begins, cut)).alias("c")).select("doc_id", "mark", "c.*")
    able = F.filter(F.array(*rows), lambda t: F.size(F.array_intersect(t["set"], F.col("hits"))) >= t["need"])

    def has(t: Column, x: Column) -> Column:
        out = F.when(t["k"] == 0, x.isin(sets[0]))
        for k, own in enumerate(sets[1:], 1):
            out = out.when(t["k"] == k, x.isin(own))
        return out.cast("long")

    # the lowest bit of a code says whether the template has the bigram
    code = lambda t: F.struct(*(t[c].alias(c) for c in ("license", "need", "span", "size")), F.transform(
        "part", lambda x: F.xxhash64(x).bitwiseAND(-2).bitwiseOR(has(t, x))).alias("codes"))
    close = (chunks.where(F.size("hits") >= fewest)
             .select("doc_id", "mark", "at", F.explode(F.transform(able, code)).alias("t")))
    hit = lambda v: v.bitwiseAND(1) == 1

    # a beginning is a hit, and enough hits lie within the span from there
    places = F.transform(F.filter(F.transform("t.codes", lambda v, i: F.struct(i.alias("i"), v.alias("v"))),
                                  lambda s: hit(s["v"])), lambda s: s["i"])
    ahead = F.zip_with(places, F.slice(places, F.col("t.need"), F.size("t.codes")),
                       lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    ahead = F.filter(ahead, lambda s: (s["q"] - s["p"] < F.col("t.span")) & (s["p"] < chunk))
    runs = F.transform(ahead, lambda s: F.struct(s["p"].alias("p"), F.slice("t.codes", s["p"] + 1, F.col("t.span")).alias("run")))
    runs = close.select("doc_id", "mark", "at", "t.license", "t.size", F.explode(runs).alias("r"))

    # Up to the e-th distinct hit, the i-th distinct bigram, |A| is i and |A n B| is e.
    hits = F.filter(F.transform(F.array_distinct("r.run"), lambda v, i: F.struct((i + 1).alias("i"), v.alias("v"))),
                    lambda s: hit(s["v"]))
    ends = F.transform(hits, lambda s, e: F.struct((-2.0 * (e + 1) / (s["i"] + F.col("size"))).alias("worst"),
                                                   s["i"].alias("i"), s["v"].alias("v")))
    best = runs.select("doc_id", "mark", "at", "license", "r.p", "r.run", F.explode(F.array(F.array_min(ends))).alias("b"))
    first = F.col("at") + F.col("p")
    found = best.where(F.col("b.worst") <= -least + 1e-9).select("doc_id", "mark", F.struct(
        F.col("b.worst").alias("worst"), "license", first.alias("first"),
        (first + F.array_position("run", F.col("b.v")).cast("int")).alias("last")).alias("f"))

    every = found.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("f")).alias("every"))
    apart = F.aggregate("every", F.slice("every", 1, 0), lambda kept, x: F.when(
        F.exists(kept, lambda y: (y["first"] <= x["last"]) & (x["first"] <= y["last"])), kept)
        .otherwise(F.concat(kept, F.array(x))))
    return every.select("doc_id", F.explode(apart).alias("f")).select(
        "doc_id", F.col("f.first").alias("first_word"), F.col("f.last").alias("last_word"), "f.license",
        (-F.col("f.worst")).alias("dice"))


def able_docs(docs: DataFrame, least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """(doc_id, text) of the documents that can have a match: a unit's or a
    passage's bigrams are the text's, and one that matches a template has at
    least ``need`` of its ``size``, so at least one of any ``size - need + 1``
    of them. The longest are looked for, as they are the rarest."""
    fewest, known, rare = 1 << 30, set(), set()
    for _, body in templates:
        own = sorted({" ".join(p) for p in _python_pairs(body)}, key=lambda x: (-len(x), x))
        if own:
            need = max(1, math.ceil(least / (2 - least) * len(own) - 1e-9))
            fewest, known, rare = min(fewest, need), known.union(own), rare.union(own[:len(own) - need + 1])
    known, rare = sorted(known), sorted(rare)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = F.array_distinct(F.filter(_pairs(F.col("text")), lambda x: x.isin(known)))
    # one lambda over the hits, so that a text is paired once
    return text.where(F.exists(F.array(hits), lambda h: (F.size(h) >= fewest) & F.exists(h, lambda x: x.isin(rare))))


def license_notices(docs: DataFrame, least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """(doc_id, unit, unit_no, first_word, last_word, license, dice): units
    (line, paragraph, text; without word places) and passages (without a unit
    number) together. The documents that can have one are found in one pass
    over all texts and written; only their units and passages are looked at."""
    none = F.lit(None).cast("int")
    docs = shared.stored(able_docs(docs, least, templates), "license-docs")
    units_found = license_scan(docs, least, templates).select(
        "doc_id", "unit", "unit_no", none.alias("first_word"), none.alias("last_word"), "license", "dice")
    return units_found.unionByName(license_passages(docs, least, templates).select(
        "doc_id", F.lit("passage").alias("unit"), none.alias("unit_no"), F.col("first_word").cast("int").alias("first_word"),
        F.col("last_word").cast("int").alias("last_word"), "license", "dice"))


def _python_pairs(text: str) -> list[tuple[str, str]]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()
    return list(zip(words, words[1:]))


def _python_bigrams(text: str) -> set[tuple[str, str]]:
    return set(_python_pairs(text))
