"""Licence scan: normalised lines and paragraphs, and runs of words inside a
text, compared to licence templates by the Dice coefficient over their sets of
word bigrams.

Only DataFrame functions, and no shuffle: a document is judged where it is
read.  Two bounds spare most work and lose nothing.  A unit with ``a`` bigrams
can reach a coefficient of ``t`` with a template of ``b`` only if
``t / (2 - t) * b <= a <= (2 - t) / t * b``; and it shares at least
``t * b / (2 - t)`` bigrams with it, so it holds one of the template's anchor
words, which leave fewer bigrams than that uncovered.  A run of words is
compared only if the whole text shares that many bigrams with the template,
and so many bigrams of the template begin within the run.
"""
from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Common short forms (fixed values).
SHORT_FORMS = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
]

_GNU = ("{0} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation{2} either "
        "version {3} of the License, or (at your option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.")
_CC = ("This work is licensed under the Creative Commons {0} 4.0 International License. To view a copy of this license, visit "
       "http://creativecommons.org/licenses/{1}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.")

# Notices as their licences ask for them: headers and permission paragraphs (fixed values).
NOTICES = [
    ("AGPL-3.0", _GNU.format("This program is free software:", "Affero General Public License", ",", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                            "products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", _CC.format("Attribution", "by")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial", "by-nc")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike", "by-sa")),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her "
                "rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law."),
    ("GPL-2.0", _GNU.format("This program is free software;", "General Public License", ";", "2")),
    ("GPL-3.0", _GNU.format("This program is free software:", "General Public License", ",", "3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", _GNU.format("This library is free software;", "Lesser General Public License", ";", "2.1")),
    ("LGPL-3.0", _GNU.format("This library is free software:", "Lesser General Public License", ",", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

TEMPLATES = SHORT_FORMS + NOTICES

NOT_WORD = "[^a-z0-9]+"
PARAGRAPH = "\n[ \t\r\n]*\n"


def template_bigrams(text: str) -> list[str]:
    words = [w for w in re.split(NOT_WORD, text.lower()) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Bigram counts that can still reach ``threshold`` with a template of ``n``."""
    ratio = threshold / (2 - threshold)
    return math.ceil(n * ratio - 1e-9), math.floor(n / ratio + 1e-9)


#: Words too frequent in any text to tell a licence from other prose.
COMMON = {"all", "an", "and", "any", "as", "at", "be", "by", "can", "for", "from", "her", "his", "in", "is", "it", "may", "not", "of", "on", "or", "that", "the",
          "this", "to", "under", "use", "was", "with", "work", "you"}


def anchors(templates, threshold: float) -> list[str]:
    """Words of which any matching unit holds at least one: for each template
    the words that cover the most bigrams, until too few are left uncovered
    for a match.  A word that contains another anchor is left out."""
    chosen: list[str] = []
    for _, text in templates:
        grams = [g.split() for g in template_bigrams(text)]
        need = size_bounds(len(grams), threshold)[0]
        free = [g for g in grams if not any(c in w for c in chosen for w in g)]
        while len(free) >= need:
            covers = {w: sum(w in g for g in free) for g in free for w in g}
            word = min(covers, key=lambda w: (w in COMMON or len(w) < 2, -covers[w], -len(w), w))
            chosen.append(word)
            free = [g for g in free if not any(word in w for w in g)]
    return sorted(w for w in chosen if not any(o != w and o in w for o in chosen))


def _any_anchor(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def _pairs(unit: Column) -> Column:
    """All word bigrams, in their order (an array in an array of one)."""
    words = F.filter(F.split(F.regexp_replace(unit, NOT_WORD, " "), " "), lambda w: w != "")
    return F.transform(F.array(words), lambda w: F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b)))


def _bigrams(unit: Column) -> Column:
    return F.array_distinct(_pairs(unit)[0])


def _constant(grams: list[str]) -> Column:
    """An array literal (folded by the optimizer)."""
    return F.split(F.lit("\n".join(grams)), "\n")


def _runs(pairs: Column, seen: Column, name: str, text: str, threshold: float) -> Column:
    """(shared, d, name, start, end) of the runs of as many words as the
    template has (a shorter text is one run) that reach ``threshold``; the
    first two are negative, for sorting.  A run begins with a bigram of the
    template or ends the text: shifted to the next such place, it shares no
    less.  ``seen``: the text's bigrams that any template has."""
    own = template_bigrams(text)
    n = len([w for w in re.split(NOT_WORD, text.lower()) if w]) - 1
    need = size_bounds(len(own), threshold)[0]
    places = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(_constant(own), F.get(pairs, i)))
    last = F.greatest(F.size(pairs) - n, F.lit(0))
    starts = F.transform(F.array(places), lambda at: F.array_distinct(F.transform(
        F.filter(at, lambda i, k: (i > last) | (F.get(at, k + F.lit(need - 1)) - i < n)), lambda i: F.least(i, last))))[0]

    def judged(start: Column) -> Column:
        run = F.slice(pairs, start + 1, n)
        shared = F.size(F.array_intersect(run, _constant(own)))
        dice = 2.0 * shared / (F.size(F.array_distinct(run)) + len(own))
        return F.when(dice >= threshold, F.struct((-shared).alias("shared"), (-dice).alias("d"), F.lit(name).alias("name"),
                                                  start.alias("start"), (start + n).alias("end")))

    return F.when(F.size(F.array_intersect(seen, _constant(own))) >= need, F.filter(F.transform(starts, judged), lambda r: r.isNotNull()))


def _apart(found: Column) -> Column:
    """Of runs that overlap, the one that shares the most bigrams (then the
    best, the smaller name, the first)."""
    return F.transform(F.array(F.array_sort(found)), lambda runs: F.aggregate(runs, F.slice(runs, 1, 0), lambda kept, r: F.when(
        F.exists(kept, lambda o: (o["start"] < r["end"]) & (r["start"] < o["end"])), kept).otherwise(F.concat(kept, F.array(r)))))[0]


def _inside(low: Column, templates, threshold: float) -> Column:
    """(d, name) of the best run of each licence in the text."""
    known = _constant(sorted({g for _, text in templates for g in template_bigrams(text)}))

    def found(pairs: Column) -> Column:
        return F.transform(F.array(F.array_intersect(pairs, known)), lambda seen: F.flatten(F.filter(
            F.array(*[_runs(pairs, seen, name, text, threshold) for name, text in templates]), lambda r: r.isNotNull())))[0]

    def best(runs: Column) -> Column:
        return F.transform(F.array_distinct(F.transform(runs, lambda r: r["name"])), lambda n: F.struct(F.array_min(
            F.transform(F.filter(runs, lambda r: r["name"] == n), lambda r: r["d"])).alias("d"), n.alias("name")))

    return F.transform(F.transform(F.transform(_pairs(low), found), _apart), best)[0]


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_hits, license, dice, licenses``.

    Units are the distinct lines and paragraphs of a text (parts between
    blank lines; the whole text if there is none).  ``n_hits`` counts those
    that reach ``threshold`` with a template, and each further licence of
    which only a run of words inside the text does: as many words as the
    template has, across lines, blank lines and comment signs; of runs that
    overlap the one that shares the most bigrams counts.  ``license`` and
    ``dice`` are the best hit's (ties to the smaller name) and ``licenses``
    all names hit, sorted and joined by commas.  Without a hit, or with a null
    or empty text, ``n_hits`` is 0 and the others are null.  Repeated rows and
    null ids are judged each; other columns are ignored.
    """
    words = anchors(templates, threshold)
    low = F.lower(F.col("text"))
    lines = F.array_distinct(F.concat(F.split(low, "\n"), F.split(low, PARAGRAPH)))
    grams = F.transform(F.filter(lines, lambda u: _any_anchor(u, words)), _bigrams)

    def best(g: Column) -> Column:
        """(dice, name) of the unit's best template, or null."""
        found = []
        for name, text in templates:
            own = template_bigrams(text)
            lo, hi = size_bounds(len(own), threshold)
            shared = F.size(F.array_intersect(g, _constant(own)))
            dice = 2.0 * shared / (F.size(g) + len(own))
            found.append(F.when(F.size(g).between(lo, hi) & (dice >= threshold), F.struct((-dice).alias("d"), F.lit(name).alias("name"))))
        return F.array_min(F.array(*found))

    hits = F.when(_any_anchor(low, words), F.filter(F.transform(grams, best), lambda h: h.isNotNull()))
    inside = F.when(_any_anchor(low, words), _inside(low, templates, threshold))
    more = F.filter("inside", lambda r: ~F.exists("hits", lambda h: h["name"] == r["name"]))
    return (docs.select(F.col("doc_id"), hits.alias("hits"), inside.alias("inside"))
            .select("doc_id", F.concat("hits", more).alias("hits"))
            .select("doc_id", F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hits"), F.array_min("hits").alias("top"),
                    F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["name"]))), ",").alias("names"))
            .select("doc_id", F.greatest("n_hits", F.lit(0)).alias("n_hits"), F.col("top.name").alias("license"), (-F.col("top.d")).alias("dice"),
                    F.when(F.col("n_hits") > 0, F.col("names")).alias("licenses")))


def scan_sql(templates=SHORT_FORMS, threshold: float = THRESHOLD) -> str:
    """The scan of lines and paragraphs without its bounds, for DuckDB.  The
    registered SQL knows the short forms; ``templates`` takes any list."""
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in templates)
    grams = ("list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))")
    words = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"
    return f"""
WITH t AS (SELECT license, {grams.format('w')} AS g FROM (
  SELECT license, {words.format('body')} AS w FROM (VALUES {quoted}) v(license, body))),
d AS (SELECT doc_id, row_number() OVER () AS row, lower(text) AS text FROM documents),
u AS (SELECT row, {grams.format('w')} AS g FROM (SELECT row, {words.format('unit')} AS w FROM (
  SELECT DISTINCT row, unnest(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r\\n]*\\n'))) AS unit
  FROM d))),
s AS (SELECT row, u.g AS g, license, 2.0 * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice
      FROM u, t WHERE len(u.g) > 0),
h AS (SELECT row, count(*) OVER () AS n, dice, license, g FROM s WHERE dice >= {threshold}),
b AS (SELECT row, g, min(license) FILTER (dice = top) AS license, max(top) AS dice FROM (
  SELECT *, max(dice) OVER (PARTITION BY row, g) AS top FROM h) GROUP BY row, g),
r AS (SELECT row, count(*) AS n_hits, min(license) FILTER (dice = top) AS license, max(top) AS dice,
             array_to_string(list_sort(list_distinct(list(license))), ',') AS licenses
      FROM (SELECT *, max(dice) OVER (PARTITION BY row) AS top FROM b) GROUP BY row)
SELECT doc_id, coalesce(n_hits, 0) AS n_hits, license, dice, licenses FROM d LEFT JOIN r USING (row)"""
