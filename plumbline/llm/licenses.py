"""Licence scans: lines, whole texts and windows against licence templates by Dice coefficient.

A template and a unit of text are normalised to lower-case words of a-z and 0-9 and
compared by their sets of word bigrams: 2 * shared / (own + template's). Units are each
line, the whole text, and every window of consecutive words wherever lines break. A window
counts only with a shared bigram that is in no template which a line or the whole text
matches, so what these match is not counted again.

* A unit of s shared bigrams reaches the threshold only if 2 * s / (s + template's) does,
  so texts that hold too few of a template's bigrams are left out before any unit is made.
* A best window starts and ends at a bigram of the template, and its first bigram stands
  in it once (else the window without it has the same bigrams). So one window per start
  and end up to the start's next occurrence is enough: at most one step per word of the
  text and bigram of the template.

All is one projection of built-in functions without a shuffle; the templates are literals:
the notices below and the whole texts in ``license_texts``, some 15,000 bigrams together.
NULL has no units. Equal scores go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import let

LEAST_DICE = 0.8

# Notices, file headers and pointer sentences of public licences.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Whole texts, without title and copyright lines where these vary.
WHOLE = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
TEMPLATES = NOTICES + tuple((x, files("plumbline.llm").joinpath("license_texts", f"{x}.txt").read_text("utf-8")) for x in WHOLE)


@dataclass(frozen=True)
class Template:
    license_id: str
    bigrams: tuple[str, ...]

    @classmethod
    def of(cls, license_id: str, text: str) -> Template:
        kept = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()
        return cls(license_id, tuple(sorted({f"{a} {b}" for a, b in zip(kept, kept[1:])})))

    def fewest(self, least: float) -> int:
        """Shared bigrams without which no unit reaches the threshold."""
        n = len(self.bigrams)
        return next((s for s in range(1, n) if 2.0 * s / (s + n) >= least), n)


def words(text: Column) -> Column:
    """Normalised words: A-Z as a-z, all else but a-z and 0-9 separates."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")), " "), "")


def _pairs(words: Column) -> Column:
    """The word bigrams in order."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def _known(templates: list[Template], least: float) -> Column:
    """The templates as one literal."""
    one = lambda t: F.struct(F.lit(t.license_id).alias("license_id"), F.split(F.lit("|".join(t.bigrams)), "[|]").alias("bigrams"), F.lit(len(t.bigrams)).alias("n"), F.lit(t.fewest(least)).alias("fewest"))
    return F.array(*map(one, templates))


def _scores(bigrams: Column, able: Column, known: Column, least: float) -> Column:
    """(dice, license_id, i) of the able templates that a unit's bigrams reach."""

    def one(i: Column) -> Column:
        t = F.get(known, i)
        # an integer bound, loose enough for rounding; the comparison below decides
        fits = F.size(bigrams).between(F.floor(t["n"] * least / (2 - least)), F.floor(t["n"] * (2 - least) / least) + 1)
        shared = F.size(F.array_intersect(bigrams, t["bigrams"]))
        return F.struct(F.when(fits, 2.0 * shared / (F.size(bigrams) + t["n"])).alias("dice"), t["license_id"].alias("license_id"), i.alias("i"))

    return F.filter(F.transform(able, one), lambda s: s["dice"] >= least)


# Lengths at which a window's own bigrams are counted, in widest windows.
_LENGTHS = (2, 8, 32, 128, 512, 2048)


def _places(pairs: Column) -> Column:
    """Every bigram with its place and where the same bigram stands before and after."""
    far = (1 << 31) - 1

    def linked(sorted_: Column) -> Column:
        def one(x: Column, m: Column) -> Column:
            beside = lambda k, none: F.coalesce(F.when(F.get(sorted_, k)["pair"] == x["pair"], F.get(sorted_, k)["at"]), F.lit(none))
            return F.struct(x["at"].alias("at"), beside(m - 1, -1).alias("before"), beside(m + 1, far).alias("after"), x["pair"].alias("pair"))

        return F.array_sort(F.transform(sorted_, one))

    return let(F.array_sort(F.transform(pairs, lambda p, k: F.struct(p.alias("pair"), k.alias("at")))), linked)


def _reach(marked: Column, a: Column, span: Column, widest: Column) -> Column:
    """How many of the ``span`` places from ``a`` on the windows have to be followed: the first
    of some lengths, each four times the last, that holds more than ``widest`` own bigrams."""
    own = lambda n: F.size(F.filter(F.slice(marked, a["at"] + 1, n), lambda p: p["before"] < a["at"]))
    reach = None
    for times in _LENGTHS:
        n = widest * times
        enough = lambda c, then: F.when(c, then) if reach is None else reach.when(c, then)  # noqa: E731, B023
        reach = enough(span <= n, span)
        reach = reach.when(own(n) > widest, n)
    return reach.otherwise(span)


def _windows(places: Column, t: Column, fresh: Column, least: float) -> Column:
    """(dice, license_id, start, end) per start at which windows with a fresh bigram reach the
    threshold: the best Dice, and where the first of them ends."""

    # more own bigrams than this keep any window below the threshold
    widest = F.floor(t["n"] * (2 - least) / least).cast("int") + 1

    def from_(marked: Column, hits: Column) -> Column:
        def one(a: Column) -> Column:
            def step(w: Column, p: Column) -> Column:
                new = p["before"] < a["at"]
                more = new & p["hit"]
                seen = w["fresh"] | p["fresh"]
                dice = 2.0 * (w["shared"] + 1) / (w["own"] + 1 + t["n"])
                return F.struct(
                    F.when(new, w["own"] + 1).otherwise(w["own"]).alias("own"),
                    F.when(more, w["shared"] + 1).otherwise(w["shared"]).alias("shared"),
                    F.when(more & seen, F.greatest(w["dice"], dice)).otherwise(w["dice"]).alias("dice"),
                    F.when(more & seen & (w["end"] < 0) & (dice >= least), p["at"]).otherwise(w["end"]).alias("end"),
                    seen.alias("fresh"),
                )

            zero = F.struct(F.lit(0).alias("own"), F.lit(0).alias("shared"), F.lit(0.0).alias("dice"), F.lit(-1).alias("end"), F.lit(False).alias("fresh"))
            done = lambda w: F.struct(w["dice"].alias("dice"), t["license_id"].alias("license_id"), a["at"].alias("start"), w["end"].alias("end"))
            span = F.least(a["after"] - 1, F.element_at(hits, -1)["at"]) - a["at"] + 1
            fold = lambda n: F.aggregate(F.slice(marked, a["at"] + 1, n), zero, step, done)
            # a window without the fewest shared bigrams reaches nothing
            return let(_reach(marked, a, span, widest), lambda n: F.when(a["need"] < a["at"] + n, fold(n)))

        needed = F.transform(hits, lambda a, j: F.struct(a["at"].alias("at"), a["after"].alias("after"), F.get(hits, j + t["fewest"] - 1)["at"].alias("need")))
        starts = F.filter(needed, lambda a: a["need"] < a["after"])
        return F.filter(F.transform(starts, one), lambda w: w["end"] >= 0)

    marked = F.transform(places, lambda p: F.struct(p["at"].alias("at"), p["before"].alias("before"), p["after"].alias("after"), F.array_contains(t["bigrams"], p["pair"]).alias("hit"), F.array_contains(fresh, p["pair"]).alias("fresh")))
    return let(marked, lambda m: let(F.filter(m, lambda p: p["hit"]), lambda hits: from_(m, hits)))


def _apart(windows: Column) -> Column:
    """How many windows without a common word a licence has, all licences together."""

    def of(license_id: Column) -> Column:
        ends = F.array_sort(F.transform(F.filter(windows, lambda w: w["license_id"] == license_id), lambda w: F.struct(w["end"].alias("end"), w["start"].alias("start"))))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-2).alias("last"))
        step = lambda s, w: F.when(w["start"] > s["last"] + 1, F.struct((s["n"] + 1).alias("n"), w["end"].alias("last"))).otherwise(s)
        return F.aggregate(ends, zero, step, lambda s: s["n"])

    ids = F.array_distinct(F.transform(windows, lambda w: w["license_id"]))
    return F.aggregate(F.transform(ids, of), F.lit(0), lambda s, n: s + n)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, n_units, licenses, best_license, best_dice) per row of ``docs``: units that
    match, the sorted ids they match, and the best match. Of overlapping windows of a
    licence one is counted; a template that a line or the text matches is not counted again
    where it is wrapped."""
    kept = [t for t in (Template.of(*x) for x in templates) if t.bigrams] or [Template("", ("",))]
    known = _known(kept, least)
    sizes = [len(t.bigrams) for t in kept]
    most = int(max(sizes) * (2 - least) / least) + 2
    fewest = max(2, int(min(sizes) * least / (2 - least)) + 1)
    any_of = ",".join(f"'{b}'" for b in sorted({b for t in kept for b in t.bigrams}))
    out = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    out = out.withColumn("pairs", let(words(F.col("body")), _pairs))
    out = out.withColumn("hits", F.array_distinct(F.expr(f"filter(pairs, p -> p IN ({any_of}))")))
    numbers = F.sequence(F.lit(0), F.lit(len(kept) - 1))
    enough = lambda i: (F.size("hits") >= F.get(known, i)["fewest"]) & (F.size(F.array_intersect("hits", F.get(known, i)["bigrams"])) >= F.get(known, i)["fewest"])
    out = out.select("doc_id", "body", "pairs", "hits", F.filter(numbers, enough).alias("able"))

    # a unit of too few characters has too few words; one line is the document itself
    body, able = F.col("body"), F.col("able")
    units = let(F.split(body, "\n"), lambda x: F.when(F.size(x) > 1, F.concat(x, F.array(body))).otherwise(x))
    long_enough = F.filter(units, lambda u: F.length(u) >= 2 * fewest - 1)
    # words repeat, so many words may still be few bigrams: only the lower bound prunes words
    cut = F.filter(F.transform(long_enough, words), lambda w: F.size(w) >= fewest)
    sized = F.filter(F.transform(cut, lambda w: F.array_distinct(_pairs(w))), lambda b: F.size(b) <= most)
    found = F.filter(F.transform(sized, lambda b: _scores(b, able, known, least)), lambda s: F.size(s) > 0)
    none = lambda kind: F.expr(f"cast(array() AS {kind})")
    out = out.withColumn("found", F.when(F.size(able) > 0, found).otherwise(none("array<array<struct<dice: double, license_id: string, i: int>>>")))
    out = out.select("doc_id", "pairs", "hits", "able", F.size("found").alias("n"), F.flatten("found").alias("lines"))
    matched = F.flatten(F.transform(F.array_distinct("lines.i"), lambda i: F.get(known, i)["bigrams"]))
    fresh = let(matched, lambda m: F.transform("able", lambda i: F.struct(i.alias("i"), F.array_except(F.array_intersect("hits", F.get(known, i)["bigrams"]), m).alias("fresh"))))
    left = F.filter(fresh, lambda x: F.size(x["fresh"]) > 0)
    nothing = none("array<struct<i: int, fresh: array<string>>>")
    out = out.select("doc_id", "pairs", "n", "lines", F.when(F.size(able) > 0, left).otherwise(nothing).alias("left"))
    windows = let(_places(F.col("pairs")), lambda p: F.flatten(F.transform("left", lambda x: let(F.get(known, x["i"]), lambda t: _windows(p, t, x["fresh"], least)))))
    out = out.withColumn("windows", F.when(F.size("left") > 0, windows).otherwise(none("array<struct<dice: double, license_id: string, start: int, end: int>>")))
    bare = lambda x: F.transform(x, lambda w: F.struct(w["dice"].alias("dice"), w["license_id"].alias("license_id")))
    scored = out.select("doc_id", (F.col("n") + _apart(F.col("windows"))).cast("long").alias("n_units"), F.concat(bare("lines"), bare("windows")).alias("all"))
    best = lambda a, s: F.when(a["dice"].isNull() | (s["dice"] > a["dice"]) | ((s["dice"] == a["dice"]) & (s["license_id"] < a["license_id"])), s).otherwise(a)
    zero = F.struct(F.lit(None).cast("double").alias("dice"), F.lit(None).cast("string").alias("license_id"))
    top = scored.withColumn("best", F.aggregate("all", zero, best))
    return top.select("doc_id", "n_units", F.array_join(F.array_sort(F.array_distinct("all.license_id")), ",").alias("licenses"), F.col("best.license_id").alias("best_license"), F.col("best.dice").alias("best_dice"))
