"""Licence notices in texts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short notices by SPDX id.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1-only", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
]

WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def gnu_header(kind: str, version: str) -> str:
    what = "program" if kind == "General" else "library"
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public "
        f"License as published by the Free Software Foundation, either version {version} of the License, or (at your option) "
        f"any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"GNU {kind} Public License for more details. You should have received a copy of the GNU {kind} Public License "
        f"along with this {what}. If not, see <https://www.gnu.org/licenses/>."
    )


#: Whole licence texts and file headers. The SQL below knows TEMPLATES only.
FULL_TEXTS = [
    ("BSD-2-Clause", BSD_2),
    ("BSD-2-Clause", BSD_2 + WARRANTY_BSD),
    ("BSD-3-Clause", BSD_2 + BSD_3),
    ("BSD-3-Clause", BSD_2 + BSD_3 + WARRANTY_BSD),
    ("GPL-2.0-or-later", gnu_header("General", "2")),
    ("GPL-3.0-or-later", gnu_header("General", "3")),
    ("LGPL-2.1-or-later", gnu_header("Lesser General", "2.1")),
    ("LGPL-3.0-or-later", gnu_header("Lesser General", "3")),
    ("MIT", next(text for name, text in TEMPLATES if name == "MIT" and len(text) > 99) + " " + WARRANTY_MIT),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
]


def bigrams_of(text: str) -> set[str]:
    """As word_bigrams(), of a template."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def word_bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words; words are runs of letters and digits, lower-cased."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")
    # Bound to a name by a list of one, so that it is built once.
    pairs = F.transform(
        F.array(words),
        lambda w: F.when(
            F.size(w) > 1, F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", w[i], w[i + 1]))
        ),
    )[0]
    return F.array_distinct(F.coalesce(pairs, F.array().cast("array<string>")))


#: Words too frequent to look for.
COMMON = set("a an and any by for in is it may no not of on or the this to under with without you".split())


def needed_words(known: list[tuple[str, list[str]]], percent: int) -> list[str]:
    """Words of which any matching passage has one: for each template so many that without them all,
    too few of its bigrams are left to reach the coefficient. Rare, long words first."""
    out: set[str] = set()
    for _, bigrams in known:
        n = len(bigrams)
        least = -(-percent * (-(-percent * n // (200 - percent)) + n) // 200)
        left = [set(b.split(" ")) for b in bigrams]
        words = sorted({w for b in left for w in b}, key=lambda w: (w in COMMON, -len(w), w))
        for w in words:
            if len(left) < least:
                break
            left = [b for b in left if w not in b]
            out.add(w)
    return sorted(out)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Columns added by one pass of a list of one: expressions that read them would else build them again."""
    built = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select("*", F.explode(F.array(built)).alias("_built")).select("*", "_built.*").drop("_built")


def windows(rows: DataFrame, known: list[tuple[str, list[str], int, tuple[str, str]]], percent: int, is_notice) -> DataFrame:
    """Notices inside lines and over neighbouring lines of rows (doc_id, lines), as scan_licenses() returns them.

    Word pairs of a template that stand side by side in the text are a run. A window goes from the start of a run to the
    end of one, and where runs of several notices grow together from a template's first pair or to its last; it has at
    most (200 - percent) / percent times as many pairs as the template. To make it longer or shorter within a run would
    only lose pairs of the template, or win none. Of the windows of a template from one start the best counts: the one
    with most shared pairs less those of only one side, so that a longer licence wins over its own part, then the one
    of greater dice, then the shorter. Windows that touch a line, or are in a text, that is a notice by itself are left
    to it (is_notice). Of windows that overlap the best is taken, then the next that overlaps none taken; among equals
    the first by template, then by place. A long text is cut into pieces of twice the longest window once, so that a
    window costs its own length, however many notices a text holds.
    """
    spaced = lambda x: F.split(F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " ")), " ")
    of_line = lambda x, i: F.transform(
        F.filter(spaced(x), lambda w: w != ""), lambda w: F.struct(w.alias("w"), i.cast("long").alias("line"))
    )
    rows = once(rows, words=F.flatten(F.transform("lines", of_line))).where(F.size("words") > 1)
    words, pairs = F.col("words"), F.col("pairs")
    two = lambda p: F.concat_ws(" ", words[p]["w"], words[p + 1]["w"])
    rows = once(rows, pairs=F.transform(F.sequence(F.lit(0), F.size("words") - 2), two))
    every = sorted({b for _, bigrams, _, _ in known for b in bigrams})
    at = F.transform("pairs", lambda b, p: F.struct(p.alias("p"), b.alias("b")))
    hit = lambda bigrams: lambda h: h["b"].isin(bigrams)
    rows = once(rows, hits=F.filter(at, hit(every)))
    sizes = [(-(-percent * len(b) // (200 - percent)), (200 - percent) * n // percent) for _, b, n, _ in known]
    rows = rows.where(F.size("hits") >= min(least for least, _ in sizes))
    listed = [
        F.struct(
            F.lit(k).alias("nth"), F.lit(name).alias("name"), F.array(*map(F.lit, b)).alias("b"), F.lit(least).alias("least"), F.lit(most).alias("most"),
            F.lit(ends[0]).alias("first"), F.lit(ends[1]).alias("last"), F.filter("hits", hit(b)).alias("m"),
        )
        for k, ((name, b, _, ends), (least, most)) in enumerate(zip(known, sizes))
    ]
    piece = max(most for _, most in sizes)
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("pairs") - 1) / piece).cast("int")), lambda k: F.slice("pairs", k * piece + 1, 2 * piece))
    dealt = F.filter(F.array(*listed), lambda t: F.size(t["m"]) >= t["least"])
    some = once(rows, dealt=dealt).where(F.size("dealt") > 0)
    some = once(some, pieces=cut)

    place = lambda t, k: t["m"][k]["p"]

    def best_from(t: Column, k: Column, stops) -> Column:
        """The best window from the k-th hit, in an array; none if none is alike enough."""
        start = place(t, k)
        text = F.slice(F.get("pieces", F.floor(start / piece).cast("int")), F.pmod(start, F.lit(piece)) + 1, t["most"])
        near = F.sequence(k + t["least"] - 1, F.least(F.size(t["m"]), k + t["most"]) - 1)
        fit = F.transform(F.filter(near, lambda c: (place(t, c) < start + t["most"]) & stops(c)), lambda c: place(t, c))

        def window(own: Column, e: Column) -> Column:
            inside = F.array_distinct(F.slice(own, F.lit(1), e - start + 1))
            return F.transform(
                F.array(F.struct(F.size(inside).alias("size"), F.size(F.array_intersect(inside, t["b"])).alias("both"))),
                lambda c: F.struct(
                    (c["size"] + F.size(t["b"]) - 3 * c["both"]).alias("rank"), (-2.0 * c["both"] / (c["size"] + F.size(t["b"]))).alias("less"),
                    t["nth"].alias("nth"), start.alias("start"), (e + 1).alias("end"), t["name"].alias("license"),
                ),
            )[0]

        # Bound to a name by a list of one, so that the piece is cut once.
        found = F.transform(F.array(text), lambda own: F.transform(fit, lambda e: window(own, e)))[0]
        return F.slice(F.array_sort(F.filter(found, lambda x: -100 * x["less"] >= percent)), 1, 1)

    def of_template(t: Column) -> Column:
        last = F.size(t["m"]) - 1
        begins = lambda k: (k == 0) | (F.get(t["m"], k - 1)["p"] + 1 != place(t, k)) | (t["m"][k]["b"] == t["first"])
        stops = lambda k: (k == last) | (F.get(t["m"], k + 1)["p"] - 1 != place(t, k)) | (t["m"][k]["b"] == t["last"])
        # From there on the text holds as many hits as a window needs.
        dense = lambda k: place(t, k + t["least"] - 1) - place(t, k) < t["most"]
        starts = F.filter(F.sequence(F.lit(0), last + 1 - t["least"]), lambda k: dense(k) & begins(k))
        return F.flatten(F.transform(starts, lambda k: best_from(t, k, stops)))

    found = once(some, all=F.flatten(F.transform("dealt", of_template))).where(F.size("all") > 0)
    lined = F.transform("all", lambda x: x.withField("from", words[x["start"]]["line"]).withField("to", words[x["end"]]["line"]))
    numbered = F.transform("lines", lambda x, i: F.struct(i.cast("long").alias("i"), is_notice(x).alias("yes")))
    found = once(found, lined=lined, taken=F.filter(numbered, lambda x: x["yes"]), whole=is_notice(F.array_join("lines", "\n"))).where(~F.col("whole"))
    free = lambda x: ~F.exists("taken", lambda y: (y["i"] >= x["from"]) & (y["i"] <= x["to"]))
    found = once(found, free=F.array_sort(F.filter("lined", free)))
    apart = lambda out, x: ~F.exists(out, lambda y: (y["start"] <= x["end"]) & (x["start"] <= y["end"]))
    chosen = F.aggregate(
        "free", F.slice("free", 1, 0), lambda out, x: F.when(apart(out, x), F.concat(out, F.array(x))).otherwise(out)
    )
    spoken = lambda x: F.array_join(F.transform(F.slice("words", x["start"] + 1, x["end"] - x["start"] + 1), lambda w: w["w"]), " ")
    each = F.transform(chosen, lambda x: F.struct(x["from"].alias("place"), spoken(x).alias("passage"), x["license"].alias("license"), (-x["less"]).alias("dice")))
    return found.select("doc_id", F.explode(each).alias("x")).select("doc_id", "x.*")


def scan_licenses(
    docs: DataFrame,
    *,
    templates: list[tuple[str, str]] = TEMPLATES + FULL_TEXTS,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every licence notice found: (doc_id, place, passage, license, dice), a row for each passage.

    Passages are the lines of a text, where it has several lines the whole text (place -1), and what
    windows() finds beside these inside long lines and over neighbouring ones (place is the first line). A passage is normalised to words and
    compared with templates by the Dice coefficient of their word bigrams. A coefficient of percent
    needs bigram counts within percent / (200 - percent) of each other, so a passage is compared with the
    templates of fitting size only. Texts and passages without any word that a match must have
    (needed_words()) leave before their bigrams are built.
    The best template of at least percent wins, the first by (license, text) among equals.

    templates is a short list: it becomes literals of the plan. Null and empty texts have no passages;
    ids are passed on as they come, repeated rows are scanned each; an empty table gives no rows; other
    columns are not read. A text may be as long as a task's memory holds some tens of times; time grows with its words,
    and with the square of its notices by a small constant (a thousand in one text take seconds).
    """
    known = known_templates(templates)
    low = min(-(-percent * len(b) // (200 - percent)) for _, b in known)
    high = max((200 - percent) * len(b) // percent for _, b in known)
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = rf"(?<![\p{{L}}\p{{N}}])({'|'.join(needed_words(known, percent))})(?![\p{{L}}\p{{N}}])"
    rows = docs.where(F.lower(text).rlike(some)).select(F.col(id_col).alias("doc_id"), F.split(text, "\n").alias("lines"))
    each = F.transform("lines", lambda x, i: F.struct(i.cast("long").alias("place"), x.alias("passage")))
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("place"), F.array_join("lines", "\n").alias("passage")))
    passages = rows.select("doc_id", F.explode(F.when(F.size("lines") > 1, F.concat(each, whole)).otherwise(each)).alias("p"))
    passages = passages.select("doc_id", "p.place", "p.passage").where(F.lower("passage").rlike(some))
    # One pass of a list of one: the filters below would else build the bigrams again.
    built = F.struct("passage", word_bigrams(F.col("passage")).alias("bigrams"))
    passages = passages.select("doc_id", "place", F.explode(F.array(built)).alias("p")).select("doc_id", "place", "p.*")
    every = F.array(*[F.lit(x) for x in sorted({x for _, b in known for x in b})])
    passages = passages.where(F.size("bigrams").between(low, high) & F.arrays_overlap("bigrams", every))
    listed = F.array(
        *[
            F.struct(F.lit(-k).alias("nth"), F.lit(name).alias("name"), F.array(*map(F.lit, b)).alias("bigrams"))
            for k, (name, b) in enumerate(known)
        ]
    )

    def best(bigrams: Column) -> Column:
        n = F.size(bigrams)
        near = F.filter(
            listed,
            lambda t: (n * (200 - percent) >= percent * F.size(t["bigrams"]))
            & (F.size(t["bigrams"]) * (200 - percent) >= percent * n),
        )
        scored = F.transform(
            near,
            lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(bigrams, t["bigrams"])) / (n + F.size(t["bigrams"]))).alias("dice"),
                t["nth"].alias("nth"),
                t["name"].alias("license"),
            ),
        )
        return F.array_max(scored)

    def is_notice(passage: Column) -> Column:
        built = F.filter(F.array(word_bigrams(passage)), lambda b: F.size(b).between(low, high))
        yes = F.coalesce(100 * F.get(F.transform(built, best), F.lit(0))["dice"] >= percent, F.lit(False))
        return F.when(F.lower(passage).rlike(some), yes).otherwise(False)

    found = passages.select("doc_id", "place", "passage", best(F.col("bigrams")).alias("best"))
    found = found.where(100 * F.col("best.dice") >= percent).select("doc_id", "place", "passage", "best.license", "best.dice")
    texts = [text for _, text in sorted(templates)]
    counted = [(name, b, pairs_in(text), edges_of(text)) for (name, b), text in zip(known, texts)]
    return found.unionByName(windows(rows, counted, percent, is_notice))


def words_in(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def pairs_in(text: str) -> int:
    return len(words_in(text)) - 1


def edges_of(text: str) -> tuple[str, str]:
    """The first and the last pair of a template."""
    words = words_in(text)
    return " ".join(words[:2]), " ".join(words[-2:])


def known_templates(templates: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    return [(name, sorted(bigrams_of(text))) for name, text in sorted(templates)]


def oracle_sql(percent: int = 80) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(
        f"({k}, {quote(name)}, [{', '.join(map(quote, b))}])" for k, (name, b) in enumerate(known_templates(TEMPLATES))
    )
    return rf"""
WITH t(nth, license, b) AS (VALUES {values}),
d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
p AS (
  SELECT doc_id, i - 1 AS place, l[i] AS passage FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)
  UNION ALL SELECT doc_id, -1, array_to_string(l, chr(10)) FROM d WHERE len(l) > 1
), w AS (
  SELECT doc_id, place, string_split(trim(regexp_replace(lower(passage), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM p
), g AS (
  SELECT doc_id, place, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w
), s AS (
  SELECT doc_id, place, nth, license, 2.0 * len(list_intersect(g, b)) / (len(g) + len(b)) AS dice
  FROM g JOIN t ON {200 - percent} * len(g) >= {percent} * len(b) AND {200 - percent} * len(b) >= {percent} * len(g)
)
SELECT doc_id, CAST(place AS BIGINT) AS place, license, round(dice, 6) AS dice
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, place ORDER BY dice DESC, nth) AS r FROM s WHERE 100 * dice >= {percent})
WHERE r = 1
"""
