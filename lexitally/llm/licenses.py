"""Licence scan: texts, their lines and passages in them against licence templates by Dice coefficient over word bigrams.

Text and templates are normalised alike: lower case, runs of anything but letters
and digits become one space. A unit is a whole text or one of its lines; its set is
its distinct bigrams of neighbouring words. With set sizes a and b a coefficient of
at least t needs (t / (2 - t)) b <= a <= ((2 - t) / t) b, so a unit meets only the
templates whose size lies within those bounds.

Notices wrapped over lines, or within longer lines, are found as passages: stretches
of words, of a number of bigrams within a template's bounds, that begin and end with a
bigram of the template. They are units besides, not within a line that matches as a
whole, and over such lines only if they match better. A text is searched for a template
only if it has as many of its bigrams as any match needs. Of passages that overlap the
best one counts, and its unit is the line where it starts.

The templates are a literal of the plan, so the scan is one projection of built-in
functions: no shuffle, no join, no user function.

Defined results: a null text has no units and no match; a unit of less than two
words has an empty set and matches nothing; of equal coefficients the first unit
(0: the whole text, then lines and passages from 1) and then the first name wins; equal rows give
equal rows; an empty table gives no rows.
"""

from fractions import Fraction
from math import ceil, floor

from pyspark.sql import functions as F

PERCENT = 75

#: Names and wordings of licences and their usual notices.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _let(value, body):
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(unit):
    return F.array_remove(F.split(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "), " "), "")


def _pairs(w):
    return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))


def bigrams(unit):
    """Distinct bigrams of neighbouring words of a normalised text."""
    return _let(_words(unit), lambda w: F.array_distinct(_pairs(w)))


def _split(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def normal_bigrams(text):
    """The same of a template."""
    words = _split(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(size, percent=PERCENT):
    """Smallest and largest set size that can reach the threshold with a set of `size`."""
    t = Fraction(percent, 100)
    return ceil(t / (2 - t) * size), floor((2 - t) / t * size)


def _literal(templates, percent):
    rows = []
    for name, text in templates:
        grams = normal_bigrams(text)
        low, high = size_bounds(len(grams), percent)
        repeats = len(_split(text)) - 1 - len(grams)
        rows.append(F.struct(
            F.lit(name).alias("name"), F.lit(low).alias("low"), F.lit(high).alias("high"), F.lit(len(grams)).alias("size"), F.lit(high + repeats).alias("longest"),
            F.array(*[F.lit(g) for g in grams]).alias("grams"),
        ))
    return F.array(*rows)


def _passages(text, found, known, every, percent):
    """(loss, unit, name) of the passages of a text with the matches `found` of its lines."""

    def windows(loss, line, grams, t):
        """(loss, unit, name, start, end): the best stretch from every start, for one template."""
        hits = F.array_compact(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i)))

        def counts(x):
            last = F.get(line, x["end"] + 1)
            lines = F.slice(loss, x["unit"], last - x["unit"] + 1)
            return ~F.exists(lines, lambda y: (y <= x["loss"]) | (y < 0) & (x["unit"] == last))

        def scored(start, end):
            return _let(F.array_distinct(F.slice(grams, start + 1, end - start + 1)), lambda g: _let(F.size(F.array_intersect(g, t["grams"])), lambda common: F.when(
                200 * common >= percent * (F.size(g) + t["size"]),
                F.struct((-2.0 * common / (F.size(g) + t["size"])).alias("loss"), F.get(line, start).alias("unit"), t["name"].alias("name"), start.alias("start"), end.alias("end")),
            )))

        def from_start(start):
            ends = F.filter(hits, lambda e: (e - start + 1).between(t["low"], t["longest"]))
            return F.array_min(F.filter(F.array_compact(F.transform(ends, lambda e: scored(start, e))), counts))

        return F.array_compact(F.transform(hits, from_start))

    def apart(taken, x):
        return F.when(F.exists(taken, lambda y: (y["start"] <= x["end"] + 1) & (x["start"] <= y["end"] + 1)), taken).otherwise(F.concat(taken, F.array(x)))

    def searched(near, lines):
        """`lines`: the words of every line."""
        loss = F.transform(lines, lambda w, i: F.coalesce(F.array_min(F.transform(F.filter(found, lambda x: x["unit"] == i + 1), lambda x: x["loss"])), F.lit(0.0)))
        numbers = F.flatten(F.transform(lines, lambda w, i: F.array_repeat(i + 1, F.size(w))))
        every = _let(loss, lambda x: _let(numbers, lambda line: _let(_pairs(F.flatten(lines)), lambda g: F.flatten(F.transform(near, lambda t: windows(x, line, g, t))))))
        return _let(F.array_sort(every), lambda x: F.aggregate(x, F.slice(x, 1, 0), apart))

    lines = F.transform(F.split(text, "\n"), _words)
    least = F.array_min(F.transform(known, lambda t: t["low"]))
    near = _let(F.array_intersect(bigrams(text), every), lambda some: F.when(
        F.size(some) >= least, F.filter(known, lambda t: F.size(F.array_intersect(some, t["grams"])) >= t["low"])
    ))
    chosen = _let(near, lambda t: F.when(F.size(t) > 0, _let(lines, lambda x: searched(t, x))))
    return F.coalesce(F.transform(chosen, lambda x: F.struct(x["loss"].alias("loss"), x["unit"].alias("unit"), x["name"].alias("name"))), F.slice(found, 1, 0))


def scan(docs, text="text", templates=TEMPLATES, percent=PERCENT):
    """Every row (its columns as a struct `row`) with n_units, n_matches and the best match: license, dice, unit."""
    known = _literal(templates, percent)
    bounds = [size_bounds(len(normal_bigrams(t)), percent) for _, t in templates]
    least, most = min(b[0] for b in bounds), max(b[1] for b in bounds)

    def matches(grams, unit):
        near = F.filter(known, lambda t: F.size(grams).between(t["low"], t["high"]))
        scored = F.transform(near, lambda t: F.struct(
            F.size(F.array_intersect(grams, t["grams"])).alias("common"), (F.size(grams) + t["size"]).alias("total"), t["name"].alias("name"),
        ))
        reached = F.filter(scored, lambda s: 200 * s["common"] >= percent * s["total"])
        best = F.array_min(F.transform(reached, lambda s: F.struct((-2.0 * s["common"] / s["total"]).alias("loss"), unit.alias("unit"), s["name"].alias("name"))))
        return F.when(F.size(grams).between(least, most), best)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("_text"))
    units = F.concat(F.array("_text"), F.split("_text", "\n"))
    found = F.array_compact(F.transform(units, lambda u, i: _let(bigrams(u), lambda g: matches(g, i))))
    every = F.array(*[F.lit(g) for g in sorted({g for _, t in templates for g in normal_bigrams(t)})])
    found = _let(found, lambda x: F.concat(x, _passages(F.col("_text"), x, known, every, percent)))
    scanned = rows.select("row", F.size(units).alias("_n"), F.when(F.col("_text").isNotNull(), found).alias("_found"))
    best = F.array_min("_found")
    return scanned.select(
        "row", F.greatest(F.coalesce("_n", F.lit(0)), F.lit(0)).cast("long").alias("n_units"),
        F.coalesce(F.greatest(F.size("_found"), F.lit(0)), F.lit(0)).cast("long").alias("n_matches"),
        best["name"].alias("license"), (-best["loss"]).alias("dice"), best["unit"].cast("long").alias("unit"),
    )
