"""Canonical forms, whole texts and notices; the query against a plain Python version."""

import re
import textwrap
from pathlib import Path

import pytest

from seqtable.llm import licences as L
from seqtable.llm import queries

TEXT = {name: text for name, kind, text in L.KNOWN if kind == "text"}


# Stated again, not taken from the operator.
ALIKE = [
    ("licence", "license"), ("licences", "license"), ("licenses", "license"), ("licenced", "licensed"), ("non commercial", "noncommercial"),
    ("sub license", "sublicense"), ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"), ("honour", "honor"),
    ("v 2 0", "version 2 0"), ("v2 0", "version 2 0"), ("version 2(?! 0)", "version 2 0"), ("v 3", "version 3"), ("v3", "version 3"), ("version 3 0", "version 3"),
    ("merchantibility", "merchantability"),
]


def is_copyright(line):
    """Whether a line (lower case) is about who holds the copyright."""
    line = re.sub(r"^[\W_]*?(?=©|\(c\)|\w)", "", line, count=1)
    if line.startswith(("©", "(c)")):
        return True
    return bool(re.match(r"copyright\b.{0,12}?(©|\(c\)|\b(19|20)\d\d\b|\byyyy\b|\byear\b)", line))


def blank(text):
    return [re.sub(r"[\W_]+", " ", line).strip() if not is_copyright(line) else "" for line in text.lower().split("\n")]


def spelled(unit):
    for old, new in ALIKE:
        unit = re.sub(rf"\b{old}\b", new, unit)
    return unit


def canon(text):
    return spelled(" ".join(" ".join(blank(text)).split()))


def brute(text):
    """(whole, found): every unit against every known text."""
    units, lines = [], blank(text or "")
    paragraphs = [" ".join(p.split()) for p in re.split("\n\n+", re.sub(" ?\n ?", "\n", "\n".join(lines)))]
    units = {spelled(u) for u in [*lines, *paragraphs, canon(text or "")] if u}
    whole = sorted({n for n, _, t in L.KNOWN if canon(t) == canon(text or "")})
    found = {n for n, _, t in L.KNOWN if canon(t) in units or all(canon(p) in units for p in t.split("\n\n"))}
    return (whole[0] if whole else None), ",".join(sorted(found))


CASES = [
    (TEXT["MIT"], "MIT", "MIT"),
    ("MIT Licence\n\nCopyright (c) 2020 A. Person\n\n" + TEXT["MIT"].upper().replace("\n\n", "\n \n"), None, "MIT"),
    ("© 2001 X\n(C) Y\n" + TEXT["ISC"].replace(", ", " ,\n"), "ISC", "ISC"),
    ("words\n\n" + "\n\n".join(TEXT["MIT"].split("\n\n")[:2]) + "\n\nmore", None, ""),
    ("Licenced under the Apache Licence, v2.0", "Apache-2.0", "Apache-2.0"),
    ("a line\n  * All rights reserved! *\nAll Rights Reserved\nend", None, "reserved"),
    ("All rights reserved. But not here", None, ""),
    ("", None, ""),
    (None, None, ""),
]


@pytest.mark.parametrize(("text", "whole", "found"), CASES)
def test_plain_version(text, whole, found):
    assert brute(text) == (whole, found)


def test_rows(spark):
    frame = spark.createDataFrame([(i % 5 or None, c[0], "x") for i, c in enumerate(CASES * 2)], "doc_id long, text string, licence string")
    found = L.scan(frame, "doc_id").collect()
    assert sorted(map(str, [(r.doc_id, r.whole, r.found) for r in found])) == sorted(map(str, [(i % 5 or None, *c[1:]) for i, c in enumerate(CASES * 2)]))
    twice = L.scan(frame.filter("text like 'a line%'"), "doc_id").first()
    assert twice.n_units == 2
    assert L.scan(frame.limit(0), "doc_id").count() == 0


def test_known_texts_differ(spark):
    known = L.known_units(spark).filter("not unit like 'part%'").collect()
    assert len({r.digest for r in known}) == len(known)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: (r.whole, r.found) for r in queries.op4_licences(spark, folder).collect()}
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert found == {d.doc_id: brute(d.text) for d in documents}
    assert len({f for _, f in found.values()}) > 3


@pytest.mark.parametrize("name", sorted(TEXT))
def test_shipped_texts_at_any_width(spark, name):
    """Wrapped at 40 to 120 letters a line, behind many copyright lines, and with a long text around."""
    paragraphs = TEXT[name].split("\n\n")
    owners = "".join(f"Copyright (c) {1990 + i}, Holder {i}\n" for i in range(30))
    rows = []
    for width in range(40, 121):
        text = "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in paragraphs)
        rows += [(3 * width, f"{owners}\n{text}\n"), (3 * width + 1, text), (3 * width + 2, "words and more\n\n" * 50 + f"{text}\n\nend " + "x " * 5000)]
    found = L.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    assert {r.doc_id: r.whole for r in found} == {i: None if i % 3 == 2 else name for i, _ in rows}
    assert all(name in r.found.split(",") for r in found)


def test_wrapped_text_is_no_copyright_line(spark):
    lines = ["copyright notice and this permission notice appear", "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "copyright owner that is granting the license"]
    gone = ["Copyright (c) 2020 A", "Copyright 1999-2003 B", "© C", "  * Copyright: 2001, D", "(C) E", "copyright [yyyy] [name]", "Copyright (C) <year> <name>"]
    assert [is_copyright(x.lower()) for x in lines + gone] == [False] * len(lines) + [True] * len(gone)
    frame = spark.createDataFrame([(x,) for x in lines + gone], "text string").select("text", L._joined(L._blank(L.F.col("text"))).alias("left"))
    assert {r.text for r in frame.collect() if r.left} == set(lines)


def test_line_breaks_do_not_count(spark):
    texts = [
        "".join(f"Copyright (c) {1990 + i} Holder {i}\n" for i in range(30)) + "\n" + TEXT["MIT"],
        TEXT["ISC"].replace("and", "\n\nand") + "\n" * 40,
        "\n" * 60 + TEXT["0BSD"].replace(" ", "\n"),
        "before\n\n" + "\n\n".join("\n* * *\n".join(p.split(" ")).replace("\n\n", "\n") for p in TEXT["MIT"].split("\n\n")) + "\n\nafter",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r.doc_id, r.whole, r.found) for r in L.scan(frame, "doc_id").collect())
    assert found == [(i, *brute(t)) for i, t in enumerate(texts)]
    assert [f[1] for f in found] == ["MIT", "ISC", "0BSD", None]


def test_spellings_change_lengths_within_bounds(spark):
    texts = [(x,) for x in ("licences " * 60, "v 2 0 v2 version 2 v3 version 3 0 v2 0 " * 9, "sub licences non commercial honour favour " * 30)]
    rows = spark.createDataFrame(texts, "text string").select(L._joined(L._blank(L.F.col("text"))).alias("unit"))
    for r in rows.select("unit", *L._lengths(L._spelled(L.F.col("unit")))).collect():
        assert r.low <= len(r.unit) <= r.high


def test_full_licences(spark):
    own = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    if not all((own / f).exists() for f in names):
        pytest.skip("no licence files here")
    texts = [(n, (own / f).read_text()) for f, n in names.items()]
    texts += [(n, "before\n\n" + t + "\n\nafter") for n, t in texts]
    found = L.scan(spark.createDataFrame(texts, "name string, text string"), "name").collect()
    assert sorted((r.name, r.whole or "") for r in found) == sorted((n, n * (i < 4)) for i, (n, _) in enumerate(texts))
    assert all(r.name in r.found.split(",") for r in found)
    assert {"BSD-2-Clause", "BSD-3-Clause", "Unlicense"} <= {r.licence for r in L.known_units(spark).filter("unit = 'text'").collect()}


def test_known_texts_of_the_caller(spark):
    known = L.units(spark.createDataFrame([("mine", "Do as you like.\n\nBut be kind."), ("other", "words " * 50)], "licence string, text string"))
    texts = [("a", "do as  you LIKE\n\n\nbut be kind!"), ("b", "x\nBut be kind.\nDo as you like"), ("c", "But be kind"), ("d", TEXT["MIT"])]
    found = L.scan(spark.createDataFrame(texts, "name string, text string"), "name", known=known).collect()
    assert sorted((r.name, r.whole, r.found) for r in found) == [("a", "mine", "mine"), ("b", None, "mine"), ("c", None, ""), ("d", None, "")]
