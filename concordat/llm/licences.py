"""License scans: word-bigram Dice against licence templates. DataFrame functions only."""

from __future__ import annotations

import functools
import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices and short licence texts as their publishers word them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
}
# Complete licence texts; a copy's title and copyright lines are few words beside them.
TEMPLATES |= {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "texts").glob("*.txt"))}


def normalised(text: Column) -> Column:
    """Lower case A-Z, everything but letters a-z and digits one space, no space at either end."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


@functools.lru_cache(1 << 16)
def bigrams_of(text: str) -> list[str]:
    """The same, of a template, on the driver."""
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def literal(values: list[str]) -> Column:
    """An array of bigrams, in one call: they hold letters, digits and spaces only."""
    return F.expr("array(" + ", ".join(f"'{x}'" for x in values) + ")")


def license_scan(docs: DataFrame, *, text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """Every row of `docs` plus `licences`, structs (unit, template, dice), and `licence_passages`, structs (template,
    first, words, dice), dice >= threshold.

    Units are the whole text (unit -1) and each of its lines (0, 1, ...). A unit's set holds its distinct word
    bigrams after normalisation; Dice is 2|A and B| / (|A| + |B|). Dice can't reach the threshold t unless
    t/(2-t) <= |A|/|B| <= (2-t)/t, and unless the text holds t/(2-t) of the template's bigrams: so a text is looked
    through once for bigrams of any template, and only templates with that many go on. Matches are ordered by unit,
    then template.

    Passages are runs of words, over line breaks or inside a line: a notice that is wrapped, or has other words
    beside it. A window grows in Dice with every further bigram of the template next to it, so the best ones begin
    and end with such a run; all windows of that kind are compared whose bigrams, repeated ones too, are at most
    (2-t)/t times the template's or belong to it without a gap. Of windows that overlap the one with the larger Dice
    stays. A passage that overlaps a unit matched to the same template isn't given again. `first` counts the text's
    words from 0; passages are ordered by template, then first.

    Null, empty and one-word texts match nothing; equal lines count each; the templates are a fixed small list that
    stands in the plan, so nothing is shuffled. `docs` may have columns of any names but these two.
    """
    sets = {name: bigrams_of(t) for name, t in sorted(templates.items())}
    sets = {name: b for name, b in sets.items() if b}
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    fewest = {name: max(1, math.ceil(low * len(b) - 1e-9)) for name, b in sets.items()}
    least = min(low * len(b) for b in sets.values())
    whole, words = F.col(f"`{text}`"), F.col("licence_words")
    quoted = lambda b: ", ".join(f"'{x}'" for x in b)
    pair = lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1))
    among = lambda places, b: F.expr(f"filter({places}, i -> concat(get(licence_words, i), ' ', get(licence_words, i + 1)) IN ({quoted(b)}))")

    # Where the text holds a bigram of any template, then, by template, for those of which it holds enough.
    hits = F.when(F.size(words) > 1, among("sequence(0, size(licence_words) - 2)", dict.fromkeys(x for b in sets.values() for x in b)))
    bounds = lambda name, b: [F.lit(x).alias(k) for k, x in (("template", name), ("n", len(b)), ("fewest", fewest[name]), ("low", low * len(b)), ("high", high * len(b)), ("most", int(high * (len(re.sub("[^a-z0-9]+", " ", templates[name].lower()).split()) - 1))))]
    near = F.array(*[F.struct(*bounds(name, b), literal(b).alias("b"), among("licence_hits", b).alias("at")) for name, b in sets.items()])
    near = F.when(F.size("licence_hits") >= min(fewest.values()), F.filter(near, lambda x: F.size(F.array_distinct(F.transform(x["at"], pair))) >= x["fewest"]))
    found = docs.withColumn("licence_words", F.split(normalised(whole), " ")).withColumn("licence_hits", hits).withColumn("licence_near", near)

    # Words are counted by a native regular expression before anything is split.
    count = lambda x: F.regexp_count(x, F.lit("[a-zA-Z0-9]+"))
    lines = F.split(whole, "\n", -1)
    units = F.concat(
        F.array(F.struct(F.lit(-1).alias("unit"), whole.alias("t"))),
        F.when(F.size(lines) > 1, F.transform(lines, lambda x, i: F.struct(i.alias("unit"), x.alias("t")))).otherwise(F.array().cast("array<struct<unit:int,t:string>>")),
    )
    # A set of n bigrams takes at least n + 1 words; distinct bigrams can be far fewer than words, so only the lower bound prunes here.
    units = F.filter(units, lambda u: count(u["t"]) > least)

    def sized(u: Column) -> Column:
        words = F.split(normalised(u["t"]), " ")
        return F.struct(u["unit"].alias("unit"), words.alias("w"))

    def paired(u: Column) -> Column:
        return F.struct(u["unit"].alias("unit"), F.size(u["w"]).alias("words"), F.array_distinct(F.zip_with(F.slice(u["w"], F.lit(1), F.size(u["w"]) - 1), F.slice(u["w"], F.lit(2), F.size(u["w"]) - 1), lambda a, b: F.concat(a, F.lit(" "), b))).alias("pairs"))

    def scored(u: Column) -> Column:
        n = F.size(u["pairs"])
        dice = lambda x: F.when(n.between(x["low"], x["high"]), 2 * F.size(F.array_intersect(u["pairs"], x["b"])) / (n + x["n"])).otherwise(0.0)
        all_ = F.transform("licence_near", lambda x: F.struct(u["unit"].alias("unit"), x["template"].alias("template"), dice(x).alias("dice")))
        return F.filter(all_, lambda m: m["dice"] >= threshold)

    some = F.size("licence_near") > 0
    result = F.flatten(F.transform(F.transform(F.transform(units, sized), paired), scored))
    result = F.when(some, result).otherwise(F.array().cast("array<struct<unit:int,template:string,dice:double>>"))

    def windows(x: Column) -> Column:
        at, last = x["at"], F.size(x["at"]) - 1
        gap = lambda i: F.coalesce(F.get(at, i) - F.get(at, i - 1) > 1, F.lit(True))
        starts = F.filter(F.sequence(F.lit(0), last), lambda i: gap(i) & (F.get(at, i + x["fewest"] - 1) - F.get(at, i) < x["most"]))
        ends = F.filter(F.sequence(F.lit(0), last), lambda j: gap(j + 1))
        size = lambda i, j: F.get(at, j) - F.get(at, i) + 1
        fits = lambda i, j: (j - i + 1 >= x["fewest"]) & ((size(i, j) <= x["most"]) | (size(i, j) == j - i + 1))
        all_ = F.flatten(F.transform(starts, lambda i: F.transform(F.filter(ends, lambda j: fits(i, j)), lambda j: F.struct(F.get(at, i).alias("first"), size(i, j).alias("size")))))
        sets_ = F.transform(all_, lambda c: F.struct(c["first"].alias("first"), (c["size"] + 1).alias("words"), F.array_distinct(F.transform(F.sequence(c["first"], c["first"] + c["size"] - 1), pair)).alias("pairs")))
        dice = lambda c: 2 * F.size(F.array_intersect(c["pairs"], x["b"])) / (F.size(c["pairs"]) + x["n"])
        ranked = F.array_sort(F.filter(F.transform(sets_, lambda c: F.struct((-dice(c)).alias("worse"), c["first"].alias("first"), c["words"].alias("words"))), lambda c: c["worse"] <= -threshold))
        kept = F.aggregate(ranked, F.array().cast("array<struct<worse:double,first:int,words:int>>"), lambda k, c: F.when(F.exists(k, lambda o: overlap(o, c)), k).otherwise(F.concat(k, F.array(c))))
        return F.transform(F.array_sort(F.transform(kept, lambda c: F.struct(c["first"].alias("first"), c["words"].alias("words"), c["worse"].alias("worse")))), lambda c: F.struct(x["template"].alias("template"), c["first"].alias("first"), c["words"].alias("words"), (-c["worse"]).alias("dice")))

    overlap = lambda a, b: (a["first"] < b["first"] + b["words"]) & (b["first"] < a["first"] + a["words"])
    # The words before each line, and those of the whole text, for the units that matched.
    long = F.transform(lines, lambda x: F.when(normalised(x) == "", 0).otherwise(F.size(F.split(normalised(x), " "))))
    before = lambda u: F.aggregate(F.slice("licence_long", F.lit(1), F.greatest(u, F.lit(0))), F.lit(0), lambda a, n: a + n)
    taken = F.transform("licences", lambda m: F.struct(m["template"].alias("template"), before(m["unit"]).alias("first"), F.when(m["unit"] < 0, F.size(words)).otherwise(F.get("licence_long", m["unit"])).alias("words")))
    passages = F.filter(F.flatten(F.transform("licence_near", windows)), lambda p: ~F.exists("licence_taken", lambda u: (u["template"] == p["template"]) & overlap(u, p)))
    passages = F.when(some, passages).otherwise(F.array().cast("array<struct<template:string,first:int,words:int,dice:double>>"))
    found = found.withColumn("licences", result).withColumn("licence_long", F.when(some, long)).withColumn("licence_taken", F.when(some, taken))
    return found.withColumn("licence_passages", passages).drop("licence_words", "licence_hits", "licence_near", "licence_long", "licence_taken")
