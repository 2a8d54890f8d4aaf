"""Licence scans: phrases, tags and expressions."""

import re

import pytest

import __spark_entry__ as entry
from statflow.llm import licenses as L

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]


def brute(text):
    """Every phrase at every word, by plain comparison."""
    words = words_of(text)
    base = {label: places(words, p) for p, label in L.BASE_PHRASES.items()}
    at = sorted(i for v in base.values() for i in v)
    labels = {k for k, v in base.items() if v} | {x for p, x, _ in L.NOTICES if places(words, p)}
    return (len(words), len(at), at[0] if at else None, at[-1] if at else None,
            ",".join(sorted(k for k, v in base.items() if v)), ",".join(sorted(labels)))


HARD = [None, "", " \n", "CC BY", "cc-by cc.by CC by", "ccby cc bye", "cc by" * 3, "cc cc by by", "GNU General Public License",
        "general public license general public license", "all rights reserved" + ", all rights reserved" * 400,
        "Épublic cc by é", "cc byé", "écc by", "ALL\tRIGHTS\x0bRESERVED.", "İ cc by ſ K", "\x00cc\x00by\x00",
        "Licensed under CC BY-NC 4.0.", "GNU Lesser General Public License", "x " * 200_000 + "cc by",
        "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "\x7fcc by\x7f", "cc\U0001F600by"]


@pytest.mark.parametrize("text", HARD)
def test_base_columns_by_brute_force(text):
    s = L.LicenceScanner().scan(text)
    got = (s.n_words, len(s.base_places), min(s.base_places, default=None), max(s.base_places, default=None),
           ",".join(sorted(s.base_labels)), ",".join(sorted(s.labels)))
    assert got == brute(text)


def test_op13_contract(spark):
    """The query against brute force on every document."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = entry.queries()["op13_license_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == want
        assert 0.0 <= r.score <= 1.0 and (r.score > 0) == bool(r.labels)
    assert any(r.labels for r in rows)


@pytest.mark.parametrize("text,ids,level", [
    ("MIT", ("mit",), "permissive"),
    ("MIT OR GPL-3.0-only", ("mit", "gpl-3.0-only"), "permissive"),
    ("MIT AND GPL-3.0-only", ("mit", "gpl-3.0-only"), "strong-copyleft"),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ("gpl-2.0-or-later",), "weak-copyleft"),
    # with before and before or
    ("MIT OR Apache-2.0 AND GPL-3.0-only", ("mit", "apache-2.0", "gpl-3.0-only"), "permissive"),
    ("(MIT OR Apache-2.0) AND GPL-3.0-only", ("mit", "apache-2.0", "gpl-3.0-only"), "strong-copyleft"),
    ("AGPL-3.0-only AND (GPL-2.0 WITH GCC-exception-3.1 OR (MIT))", ("agpl-3.0-only", "gpl-2.0", "mit"),
     "network-copyleft"),
    ("gpl-2.0+ or mpl-2.0 */", ("gpl-2.0+", "mpl-2.0"), "weak-copyleft"),
    ("MIT and some prose", ("mit",), "permissive"),
    ("MIT OR", ("mit",), "permissive"),
    ("MIT Apache-2.0", ("mit",), "permissive"),
    ("(MIT OR Apache-2.0", ("mit", "apache-2.0"), "permissive"),
    ("MIT) OR GPL-3.0", ("mit",), "permissive"),
    ("MIT WITH nonsense", ("mit",), "permissive"),
    ("LicenseRef-own AND MIT", ("licenseref-own", "mit"), "restricted"),
    ("  CC0-1.0", ("cc0-1.0",), "public-domain"),
])
def test_expressions(text, ids, level):
    got = L.parse_expression(text)
    assert got.ids == ids and L.TERMS[got.level] == level


@pytest.mark.parametrize("text", ["", "nonsense", "OR MIT", "() MIT", "WITH MIT", ")", "(((", "and"])
def test_no_expression(text):
    assert L.parse_expression(text) is None


def test_random_expressions():
    """Shunting-yard against a recursive evaluation of the same tree."""
    import random
    rng, ids = random.Random(3), ["mit", "gpl-3.0", "mpl-2.0", "cc0-1.0", "agpl-3.0"]

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(ids)
            if rng.random() < 0.2:
                level = L.licence_level(name)
                return f"{name} WITH llvm-exception", 3, level - 1 if level == 3 else level
            return name, 3, L.licence_level(name)
        op, fn, rank = rng.choice([("OR", min, 1), ("AND", max, 2)])
        (a, ra, la), (b, rb, lb) = tree(depth - 1), tree(depth - 1)
        a, b = (f"({a})" if ra < rank else a), (f"({b})" if rb <= rank else b)
        return f"{a} {op} {b}", rank, fn(la, lb)

    for _ in range(500):
        text, _, level = tree(4)
        assert L.parse_expression(text).level == level, text


def test_rows_and_tags(spark):
    """Tags, nulls, repeated rows, an empty table and clashing columns."""
    schema = "doc_id long, text string, labels string, n_words int, id string"
    rows = [(1, "// SPDX-License-Identifier: MIT OR GPL-2.0-only\nint x;", "old", 0, "a"),
            (1, "// SPDX-License-Identifier: MIT OR GPL-2.0-only\nint x;", "old", 0, "a"),
            (None, None, None, None, None), (2, "", "x", 1, "b"),
            (3, "SPDX license identifier without a colon\nSPDX-License-Identifier:\nMIT", "x", 1, "b"),
            (4, "SPDX-License-Identifier: GPL-3.0-only\n" * 3 + "All rights reserved. SPDX-License-Identifier:MIT", "", 1, "")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, L.licence_digest(df).collect()), key=str)
    assert [g[:2] for g in got] == [(1, 11), (1, 11), (2, 0), (3, 10), (4, 28), (None, 0)]
    by = {g[0]: g for g in got}
    assert by[1][6] == "gpl-2.0-only,mit" and by[1][8] == "permissive" and by[1][5] == "" and by[1][7] > 0.99
    assert by[2][2:] == (0, None, None, "", "", 0.0, None) == by[None][2:]
    assert by[3][6] == "" and by[3][8] is None
    assert by[4][5:7] == ("reserved", "gpl-3.0-only,mit,reserved") and by[4][8] == "strong-copyleft"
    assert L.licence_digest(df.limit(0)).count() == 0
    notes = [n for r in L.scan_licences(df.where("doc_id = 4")).collect() for n in r.notices]
    assert [(n.word, n.label) for n in notes] == [(0, "gpl-3.0-only"), (7, "gpl-3.0-only"),
                                                  (14, "gpl-3.0-only"), (24, "mit")]
    with pytest.raises(ValueError):
        L.scan_licences(df.drop("text"))
