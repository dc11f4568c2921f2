"""Licence scan: Dice coefficient over word bigrams against templates (SQL functions only).

A *unit* is a line of a text, a paragraph of several lines (between blank lines, where there
are several paragraphs), or a whole text of several lines. Normalised text is in
lower case with every run of other characters than letters and digits as one space. With
A and B the distinct word bigrams of unit and template, ``dice = 2 |A & B| / (|A| + |B|)``;
a unit reports its best template with ``dice >= MIN_DICE`` (ties: the smaller id).

Pruning is exact:

* Size bounds: dice >= t needs |A| within [t / (2 - t) * |B|, (2 - t) / t * |B|].
* Key words: dice >= t needs at least t / (2 - t) of the template's bigrams. ``key_words``
  picks words, the longest first, until fewer bigrams than that are free of them, so a
  unit without any of them cannot match. A text without key words is dropped whole, before
  it is cut into lines. Templates above ``LONG`` bigrams have key words of their own, which
  count only in a unit or text of as many words as the shortest of them needs.

``TEMPLATES`` holds notices and first paragraphs, ``COMPLETE`` the whole published texts
(``resources/licences``): a ``-text`` template matches a document or line that is the licence
itself. Query and SQL are of both.

Everything is one projection of the scan: no shuffle, no join. The templates are
configuration, a literal of fixed size.

Defined results: a null or empty text has no unit; a unit of fewer than two words has no
bigram and matches nothing; line numbers count from 0, the whole text is line -1, paragraph k (from 0) is -2 - k; repeated
rows report each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import table

MIN_DICE = 0.8

# Licence notices as published.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-line": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
# End of fixed values.

#: Whole texts as published, without copyright lines.
COMPLETE = {f"{p.name.removesuffix('.txt')}-text": p.read_text("utf-8") for p in sorted((files("tidewrack.resources") / "licences").iterdir(), key=lambda p: p.name)}
LONG = 128

PARAGRAPHS = r"\n[ \t\r]*\n"
OTHER = r"[^\p{L}\p{N}]+"


def words_of(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def key_words(templates: dict[str, str], min_dice: float) -> list[str]:
    """Words of which every unit that matches a template holds at least one."""
    chosen: set[str] = set()
    for text in templates.values():
        bigrams = {tuple(b.split()) for b in bigrams_of(text)}
        needed = min_dice / (2 - min_dice) * len(bigrams)
        rest = {b for b in bigrams if not chosen & {*b}}
        for word in sorted({w for b in bigrams for w in b}, key=lambda w: (-len(w), w)):
            if len(rest) < needed - 1e-9:
                break
            chosen.add(word)
            rest = {b for b in rest if word not in b}
    return sorted(chosen)


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), OTHER, " "))


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def bigrams(words: Column) -> Column:
    """Distinct bigrams of a word array; empty below two words."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, min_dice: float = MIN_DICE, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line, license, dice``: the best template of every matching unit."""
    low, high = min_dice / (2 - min_dice) - 1e-9, (2 - min_dice) / min_dice + 1e-9
    sizes = {name: len(bigrams_of(text)) for name, text in templates.items()}

    def may_match(words: Column) -> Column:
        out = F.lit(False)
        for group in ([n for n in templates if sizes[n] <= LONG], [n for n in templates if sizes[n] > LONG]):
            if group:
                enough = F.size(words) - 1 >= low * min(sizes[n] for n in group)
                out = out | (enough & F.arrays_overlap(words, strings(key_words({n: templates[n] for n in group}, min_dice))))
        return out

    known = F.array(*[F.struct(F.lit(name).alias("id"), strings(bigrams_of(text)).alias("b")) for name, text in sorted(templates.items())])
    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = held.select("doc_id", "text", once(F.split(normal(F.col("text")), " ")).alias("all")).where(may_match(F.col("all"))).select("doc_id", "text")
    lines = F.split(F.col("text"), "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))
    blocks = F.split(F.col("text"), PARAGRAPHS)
    several = F.filter(F.transform(blocks, lambda x, i: F.struct((-2 - i).alias("line"), x.alias("unit"))), lambda x: F.contains(x["unit"], F.lit("\n")))
    blocks = F.when(F.size(blocks) > 1, several).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))
    units = held.select("doc_id", F.explode(F.concat(F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit"))), whole, blocks)).alias("u"))
    words = units.select("doc_id", F.col("u.line").alias("line"), once(F.split(normal(F.col("u.unit")), " ")).alias("words")).where(may_match(F.col("words")))
    sized = words.select("doc_id", "line", once(bigrams(F.col("words"))).alias("a")).where(F.size("a") > 0)
    near = sized.select("doc_id", "line", "a", once(F.filter(known, lambda t: (F.size("a") >= low * F.size(t["b"])) & (F.size("a") <= high * F.size(t["b"])))).alias("near")).where(F.size("near") > 0)
    # The largest dice, then the first template: the negated place breaks ties.
    scored = F.transform("near", lambda t, i: F.struct(
        (F.lit(2.0) * F.size(F.array_intersect(F.col("a"), t["b"])) / (F.size("a") + F.size(t["b"]))).alias("dice"), (-i).alias("place"), t["id"].alias("license")))
    best = near.select("doc_id", "line", once(F.array_max(scored)).alias("m")).where(F.col("m.dice") >= min_dice)
    return best.select("doc_id", F.col("line").cast("long").alias("line"), F.col("m.license").alias("license"), F.col("m.dice").alias("dice"))


def once(value: Column) -> Column:
    """A generator column that computes ``value`` once per row: filters above it are not
    pushed below, where they would repeat the expression."""
    return F.explode(F.array(value))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), TEMPLATES | COMPLETE)


def _quoted(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


ORACLE = rf"""
WITH templates AS (SELECT * FROM (VALUES {', '.join(f"('{name}', {_quoted(bigrams_of(text))})" for name, text in sorted((TEMPLATES | COMPLETE).items()))}) AS v(license, b)),
lines AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
units AS (SELECT r, doc_id, generate_subscripts(l, 1) - 1 AS line, unnest(l) AS unit FROM lines
          UNION ALL SELECT r, doc_id, -1, text FROM lines WHERE len(l) > 1
          UNION ALL SELECT r, doc_id, line, unit FROM (
            SELECT r, doc_id, len(b) AS n, -1 - generate_subscripts(b, 1) AS line, unnest(b) AS unit
            FROM (SELECT r, doc_id, regexp_split_to_array(text, '{PARAGRAPHS}') AS b FROM lines)) WHERE n > 1 AND contains(unit, chr(10))),
words AS (SELECT r, doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units),
sized AS (SELECT r, doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS a FROM words WHERE len(w) > 1),
scored AS (SELECT r, doc_id, line, license, 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
           FROM sized JOIN templates ON len(a) BETWEEN 2.0 / 3 * len(b) - 1e-9 AND 1.5 * len(b) + 1e-9),
best AS (SELECT *, row_number() OVER (PARTITION BY r, line ORDER BY dice DESC, license) AS n FROM scored WHERE dice >= 0.8)
SELECT doc_id, line::BIGINT AS line, license, dice FROM best WHERE n = 1
"""
