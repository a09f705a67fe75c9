"""Known licences in documents, by digests of canonical texts.

Canonical form: lower case, without copyright lines, everything but letters and
digits as one blank, and equivalent spellings alike. The whole text, each
paragraph and each line of a document are looked up: the SHA-256 of their
canonical form is joined with those of known licences and notices. The shipped list
(KNOWN, and DIGESTS of full licences) is small, so that side of the join is sent to
all tasks; a table of the caller's own is joined as Spark sees fit.
Of the units of a document only those as long as some known text are hashed, by
their length with single blanks and the most that spellings can change it; that
excludes none that could match.

A document is `whole` if its entire text is a licence; `found` lists all licences
whose notice, or whose every paragraph, it holds.

Results for odd input: null and empty texts hold nothing; a unit that repeats
counts once in `found` and each time in `n_units`; repeated rows and rows with
null ids get a row each; an empty table gives an empty one.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtable.llm.licence_digests import DIGESTS

# Short public licences and usual notices. Kind "text" is a licence's entire wording.
KNOWN: list[tuple[str, str, str]] = [
    ("ISC", "text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", "text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "notice", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
    ("reserved", "notice", "All rights reserved."),
]
# Spellings that count as the same, each as (pattern of whole words, spelling kept).
SPELLINGS: list[tuple[str, str]] = [
    ("licence|licences|licenses", "license"),
    ("licenced", "licensed"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("v 2 0|v2 0|version 2 0|version 2", "version 2 0"),
    ("v 3|v3|version 3 0|version 3", "version 3"),
    ("merchantibility", "merchantability"),
]
#: Ranges of lengths that a unit is tried for.
SPANS = 32
#: A copyright line begins with a sign, or with the word and a sign or a year (or a place for one) next to it; other lines that
#: begin with the word are text that happened to be wrapped there.
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n©]*(?:©|\(c\)|copyright\b[^\n]{0,12}?(?:©|\(c\)|\b(?:19|20)[0-9]{2}\b|\byyyy\b|\byear\b))[^\n]*$"
#: Words kept in SPELLINGS that others of more letters become, and those that come from fewer: "v3" has 7 fewer than "version 3", "version 2" 2 fewer than "version 2 0", "version 3 0" 2 more than "version 3".
LONGER, SHORTER = r"(?:license|noncommercial|sublicense|favor|honor)", r"version (?:2 0|3)"


def _blank(text: Column) -> Column:
    """Lower case, copyright lines gone, single blanks; lines stay apart."""
    text = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")
    return F.regexp_replace(text, r" ?\n ?", "\n")


def _spelled(unit: Column) -> Column:
    """A unit with equivalent spellings alike."""
    for pattern, kept in SPELLINGS:
        unit = F.regexp_replace(unit, rf"\b(?:{pattern})\b", kept)
    return unit


def _joined(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _lengths(canonical: Column) -> list[Column]:
    """Least and greatest length of the units that _spelled turns into this text."""
    longer, shorter = (F.regexp_count(canonical, F.lit(rf"\b{words}\b")) for words in (LONGER, SHORTER))
    return [(F.length(canonical) - 7 * shorter).alias("low"), (F.length(canonical) + 2 * (longer + shorter)).alias("high")]


UNITS = "digest string, licence string, unit string, parts int, low int, high int"


def units(texts: DataFrame) -> DataFrame:
    """(digest, licence, unit, parts, low, high) of whole texts (licence, text) and their paragraphs; lengths that other spellings of them may have."""
    blank = texts.select("licence", _blank(F.col("text")).alias("text"))
    parts = F.filter(F.transform(F.split("text", "\n\n+"), lambda p: _spelled(_joined(p))), lambda p: p != "")
    blank = blank.select("licence", _spelled(_joined(F.col("text"))).alias("text"), parts.alias("paragraphs"), F.size(parts).alias("parts")).filter("text <> ''")
    whole = blank.select("licence", F.lit("text").alias("unit"), "text", "parts")
    each = blank.filter("parts > 1").select("licence", "parts", F.posexplode("paragraphs").alias("at", "text"))
    every = whole.unionByName(each.select("licence", F.concat(F.lit("part "), "at").alias("unit"), "text", "parts"))
    return every.select(F.sha2("text", 256).alias("digest"), "licence", "unit", "parts", *_lengths(F.col("text")))


def known_units(spark: SparkSession) -> DataFrame:
    """The units of KNOWN and of the full licences in DIGESTS."""
    rows = []
    for licence, kind, text in KNOWN:
        paragraphs = text.split("\n\n")
        rows.append((licence, kind, text, len(paragraphs)))
        if len(paragraphs) > 1:
            rows += [(licence, f"part {i}", p, len(paragraphs)) for i, p in enumerate(paragraphs)]
    known = spark.createDataFrame(rows, "licence string, unit string, text string, parts int")
    canonical = _spelled(_joined(_blank(F.col("text"))))
    known = known.select(F.sha2(canonical, 256).alias("digest"), "licence", "unit", "parts", *_lengths(canonical))
    return known.unionByName(spark.createDataFrame(DIGESTS, UNITS))


def scan(documents: DataFrame, keep: str, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """The column `keep`, whole (a licence or null), found (licences, sorted) and n_units (lines and paragraphs that match).

    `known` is a table of known units, as `units` makes it of texts; `known_units` if it is left out.
    """
    own, once = known is None, F.row_number().over(Window.partitionBy("digest").orderBy("licence", "unit")) == 1
    known = known_units(documents.sparkSession) if own else known
    spans: list[list[int]] = []
    for low, high in sorted(tuple(r) for r in known.select("low", "high").distinct().collect()):  # different lengths
        if spans and low <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    while len(spans) > SPANS:  # the narrowest gap goes: more is hashed, nothing is lost
        i = min(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1])
        spans[i - 1 : i + 1] = [[spans[i - 1][0], spans[i][1]]]

    def fits(unit: Column) -> Column:
        size = F.length(unit)
        out = F.lit(False)
        for low, high in spans:
            out = out | size.between(max(low, 1), high)
        return out

    rows = documents.select(F.monotonically_increasing_id().alias("__row"), documents[keep].alias("__keep"), _blank(documents[text]).alias("__text"))
    unit = lambda of: lambda u: F.struct(F.lit(of).alias("of"), u.alias("unit"))
    lines = F.transform(F.filter(F.transform(F.split("__text", "\n"), lambda u: F.trim(u)), fits), unit("line"))
    blocks = F.filter(F.split("__text", "\n\n+"), lambda u: u.contains("\n"))
    blocks = F.transform(F.filter(F.transform(blocks, _joined), fits), unit("paragraph"))
    whole = F.transform(F.filter(F.array(_joined(F.col("__text"))), fits), unit("whole"))
    none = F.array().cast("array<struct<of:string,unit:string>>")
    units = F.concat(F.coalesce(lines, none), F.coalesce(blocks, none), F.coalesce(whole, none))
    named = rows.select("__row", "__keep", F.explode_outer(units).alias("u"))
    named = named.withColumn("digest", F.sha2(_spelled(F.col("u.unit")), 256))
    known = known.withColumn("counted", once)  # a paragraph that several texts share is one unit
    hits = named.join(F.broadcast(known) if own else known, "digest", "left")
    is_whole = F.col("u.of") == "whole"
    part = F.col("unit").startswith("part")
    # A licence may be known in several wordings (`parts` apart); each must be whole by itself.
    each = hits.groupBy("__row", "__keep", "licence", "parts").agg(
        F.max(is_whole & F.col("unit").isin("text", "notice")).alias("whole"),
        F.max(~part).alias("direct"),
        F.count_if(~is_whole & F.col("counted")).alias("n_units"),
        F.count_distinct(F.when(part, F.col("unit"))).alias("seen"),
    )
    is_found = F.col("licence").isNotNull() & (F.col("direct") | (F.col("seen") == F.col("parts")))
    return (
        each.groupBy("__row", "__keep")
        .agg(
            F.min(F.when(F.col("whole"), F.col("licence"))).alias("whole"),
            F.array_join(F.array_sort(F.collect_set(F.when(is_found, F.col("licence")))), ",").alias("found"),
            F.sum(F.when(F.col("licence").isNotNull(), F.col("n_units")).otherwise(0)).alias("n_units"),
        )
        .select(F.col("__keep").alias(keep), "whole", "found", "n_units")
    )
