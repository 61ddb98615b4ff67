"""Licence scan: Dice coefficient over word bigrams against licence templates.

Every line of a text, and a text of several lines as a whole, is normalised
(lower case, only letters and digits) and compared with the templates whose
bigram count lies within the bounds that the threshold allows: with Dice
``2|A∩B| / (|A|+|B|) >= t`` the smaller set has at least ``t / (2 - t)`` of the
larger one's bigrams, so most pairs are dropped on their sizes alone.  The
best template of a unit is reported; ties go to the first name.  A unit has to hold every
bigram of the template that has a digit, so that versions agree.

Passages cover what lies across lines or inside a longer one: windows of as many
consecutive bigrams as the bounds allow that begin and end with a bigram of the
template (others cannot score higher).  Only texts that hold two thirds
of a template's bigrams (at a threshold of 0.8) are searched, which loses nothing.
Of overlapping windows the best stays, and none that overlaps a matching line or text.

Templates are literals of the plan, so their number is checked
(``MAX_TEMPLATES``).  One narrow pass, no shuffle, DataFrame functions only.

Defined results: NULL and empty texts and units of less than two words match
nothing; NULL ids stay NULL; repeated rows are reported as often as they
occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import let, table

MAX_TEMPLATES = 500

# Notices as the licences' own publishers word them
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 2 of the "
                      "License, or (at your option) any later version.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                 "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                 "subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

def template_bigrams(text: str) -> list[str]:
    found = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(found, found[1:])})


def versions(grams: list[str]) -> list[str]:
    """The bigrams with a digit: a unit that lacks one has another version of the licence."""
    return [g for g in grams if any(c.isdigit() for c in g)]


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of the normalised text."""
    found = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return let(found, lambda w: F.array_distinct(F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: i < F.size(w)),
        lambda i: F.concat(F.get(w, i - 1), F.lit(" "), F.get(w, i)))))


def _all_bigrams(w: Column) -> Column:
    return F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: i < F.size(w)),
                       lambda i: F.concat(F.get(w, i - 1), F.lit(" "), F.get(w, i)))


def passages(text: Column, taken: Column, templates: dict[str, str], threshold: float) -> Column:
    """Array of (dice, first, last, license): best windows, by bigram, outside the ``taken`` ranges."""
    sets = {name: template_bigrams(t) for name, t in sorted(templates.items())}
    sets = {name: grams for name, grams in sets.items() if grams}
    empty = F.array().cast("array<struct<dice:double,first:int,last:int,license:string>>")
    if not sets:
        return empty
    known = sorted({g for grams in sets.values() for g in grams})
    forms = F.array(*[F.struct(
        F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"),
        F.array(*map(F.lit, versions(grams))).cast("array<string>").alias("digits"),
        F.lit(size_bounds(len(grams), threshold)[0]).alias("least"), F.lit(size_bounds(len(grams), threshold)[1]).alias("most"),
        F.lit(math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)).alias("need")) for name, grams in sets.items()])

    def window(g, t, a, e):
        return let(F.array_distinct(F.slice(g, a + 1, e - a + 1)), lambda x: F.struct(
            (2 * F.size(F.array_intersect(x, t["grams"])) / (F.size(x) + F.size(t["grams"]))).alias("dice"),
            a.alias("first"), e.alias("last"),
            F.when(F.size(F.array_except(t["digits"], x)) == 0, t["name"]).alias("license")))

    def windows(g, t):
        places = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: F.array_contains(t["grams"], F.get(g, i)))
        found = let(places, lambda p: F.flatten(F.transform(p, lambda a: F.transform(
            F.filter(p, lambda e: (e >= a + t["least"] - 1) & (e < a + t["most"])), lambda e: window(g, t, a, e)))))
        return F.filter(found, lambda x: (x["dice"] >= threshold) & x["license"].isNotNull())

    def choose(found):
        ranked = F.sort_array(F.transform(found, lambda x: F.struct(
            (-x["dice"]).alias("dice"), x["first"].alias("first"), x["last"].alias("last"), x["license"].alias("license"))))
        return F.aggregate(ranked, empty, lambda kept, x: F.when(
            F.exists(F.concat(F.transform(kept, lambda k: F.struct(k["first"].alias("first"), k["last"].alias("last"))), taken),
                     lambda k: (k["first"] <= x["last"]) & (x["first"] <= k["last"])), kept)
            .otherwise(F.concat(kept, F.array(x))))

    def search(g):
        held = F.array_distinct(F.filter(g, lambda b: b.isin(known)))
        likely = let(held, lambda h: F.filter(forms, lambda t: F.size(F.array_intersect(h, t["grams"])) >= t["need"]))
        return let(likely, lambda ts: F.when(F.size(ts) > 0, let(
            F.flatten(F.transform(ts, lambda t: windows(g, t))), choose)).otherwise(empty))

    return let(normal_words(text), lambda w: let(_all_bigrams(w), search))


def normal_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can reach the threshold against ``size`` ones."""
    share = threshold / (2 - threshold)
    return math.ceil(size * share - 1e-9), math.floor(size / share + 1e-9)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, unit, line_no, license, dice): units that match a template; ``line_no`` is 0 for a whole text
    and the line of the first word for a passage."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    sets = {name: template_bigrams(text) for name, text in sorted(templates.items())}
    sets = {name: grams for name, grams in sets.items() if grams}
    none = F.lit(None).cast("struct<dice:double,license:string>")
    if not sets:
        sets = {"": [""]}
    least = min(size_bounds(len(grams), threshold)[0] for grams in sets.values())

    def best(grams):
        out = none
        for name, wanted in sets.items():
            size = F.size(grams)
            # when() is lazy: the intersection is taken only inside the size bounds
            dice = F.when(size.between(*size_bounds(len(wanted), threshold)),
                          2 * F.size(F.array_intersect(grams, F.lit(wanted))) / (size + len(wanted)))
            same = [F.array_contains(grams, v) for v in versions(wanted)]
            hit = F.when(reduce(lambda a, b: a & b, same, dice >= threshold), F.struct((-dice).alias("dice"), F.lit(name).alias("license")))
            out = F.least(out, hit)
        return out

    text = F.col(text_col).cast("string")
    lines = F.split(text, "\n", -1)
    units = let(lines, lambda x: F.concat(
        F.transform(x, lambda line, i: F.struct(F.lit("line").alias("unit"), (i + 1).alias("line_no"), line.alias("t"))),
        F.when(F.size(x) > 1, F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("line_no"), text.alias("t"))))
        .otherwise(F.array().cast("array<struct<unit:string,line_no:int,t:string>>"))))
    # a unit too short for the smallest template is not taken apart
    found = F.transform(units, lambda u: F.struct(
        u["unit"].alias("unit"), u["line_no"].alias("line_no"),
        F.when(F.length(u["t"]) >= least * 2, let(bigrams(u["t"]), best)).alias("best")))
    hits = F.filter(found, lambda u: u["best"].isNotNull())
    # first word of every line, and the bigrams of what matched already
    begins = let(lines, lambda x: F.aggregate(
        x, F.array(F.lit(0)), lambda at, line: F.concat(at, F.array(F.element_at(at, -1) + F.size(normal_words(line))))))
    taken = F.transform(F.col("_hits"), lambda u: F.when(u["unit"] == "text", F.struct(
        F.lit(0).alias("first"), F.lit((1 << 31) - 1).alias("last"))).otherwise(F.struct(
            F.get(F.col("_begins"), u["line_no"] - 1).alias("first"), (F.get(F.col("_begins"), u["line_no"]) - 2).alias("last"))))
    more = F.transform(passages(F.col("_text"), F.col("_taken"), templates, threshold), lambda p: F.struct(
        F.lit("passage").alias("unit"),
        F.size(F.filter(F.col("_begins"), lambda b: b <= p["first"])).alias("line_no"),
        F.struct(p["dice"].alias("dice"), p["license"].alias("license")).alias("best")))
    rows = (docs.select(F.col(id_col).alias("_id"), text.alias("_text"), hits.alias("_hits"), begins.alias("_begins"))
            .withColumn("_taken", taken)
            .select("_id", F.explode(F.concat("_hits", F.coalesce(more, F.array().cast(
                "array<struct<unit:string,line_no:int,best:struct<dice:double,license:string>>>")))).alias("u")))
    return rows.select(F.col("_id").alias(id_col), "u.unit", "u.line_no", F.col("u.best.license").alias("license"),
                       (-F.col("u.best.dice")).alias("dice"))


def query(spark, sf_dir):
    """op7: licence notices of all documents."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    listed = lambda grams: "[" + ", ".join(f"'{g}'" for g in grams) + "]::VARCHAR[]"                 # noqa: E731
    rows = ", ".join(f"('{name}', {listed(template_bigrams(t))}, {listed(versions(template_bigrams(t)))})"
                     for name, t in sorted(TEMPLATES.items()))
    return r"""
WITH tpl AS (SELECT * FROM (VALUES """ + rows + r""") AS v(license, tg, vs)),
ln AS (SELECT doc_id, i, ls[i] AS t, len(ls) AS n FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
       FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
unit AS (SELECT doc_id, 'line' AS unit, i AS line_no, t FROM ln
         UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE contains(text, chr(10))),
w AS (SELECT doc_id, unit, line_no, list_filter(regexp_split_to_array(lower(t), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM unit),
g AS (SELECT doc_id, unit, line_no, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i+1])) AS gs
      FROM w WHERE len(ws) > 1),
d AS (SELECT doc_id, unit, line_no, license, 2 * len(list_intersect(gs, tg)) / (len(gs) + len(tg)) AS dice FROM g, tpl
      WHERE len(gs) BETWEEN len(tg) * 0.6 AND len(tg) * 1.7 AND len(list_intersect(gs, vs)) = len(vs))
SELECT doc_id, unit, line_no::INT AS line_no, license, dice::DOUBLE AS dice FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, unit, line_no ORDER BY dice DESC, license) AS r FROM d WHERE dice >= 0.8)
WHERE r = 1
"""


SQL = _sql()
