"""Operator 13: licence scans.

An Aho-Corasick automaton over the words of each whole text finds notice phrases and the
identifier tag; after a tag, a shunting-yard parser reads the licence expression and
evaluates ``AND``, ``OR`` and ``WITH`` on a scale of obligations.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. The text
becomes one line of words with single spaces around them, and each phrase is searched with
its own spaces around it: a match is then a run of whole words, and matches may overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import names, release_memory

# The base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notice phrases of common licences: (words, label, weight). The weight is how surely the
# phrase alone says that the text is under that licence.
NOTICES = [
    ("released under the mit license", "mit", 0.95),
    ("licensed under the mit license", "mit", 0.95),
    ("permission is hereby granted free of charge to any person", "mit", 0.9),
    ("the software is provided as is without warranty of any kind", "mit", 0.6),
    ("licensed under the apache license", "apache-2.0", 0.95),
    ("apache license version 2 0", "apache-2.0", 0.9),
    ("redistribution and use in source and binary forms", "bsd", 0.9),
    ("licensed under the bsd license", "bsd", 0.95),
    ("licensed under the gnu general public license", "gpl", 0.95),
    ("gnu general public license version 2", "gpl-2.0", 0.9),
    ("gnu general public license version 3", "gpl-3.0", 0.9),
    ("gnu lesser general public license", "lgpl", 0.9),
    ("gnu affero general public license", "agpl", 0.9),
    ("gnu free documentation license", "gfdl", 0.9),
    ("mozilla public license", "mpl", 0.9),
    ("eclipse public license", "epl", 0.9),
    ("isc license", "isc", 0.7),
    ("boost software license", "bsl", 0.9),
    ("creative commons attribution", "cc-by", 0.8),
    ("licensed under cc by", "cc-by", 0.95),
    ("cc by sa", "cc-by-sa", 0.9),
    ("cc by nc", "cc-by-nc", 0.9),
    ("cc by nd", "cc-by-nd", 0.9),
    ("cc by nc sa", "cc-by-nc-sa", 0.9),
    ("cc by nc nd", "cc-by-nc-nd", 0.9),
    ("cc0 1 0", "cc0", 0.9),
    ("dedicated to the public domain", "public-domain", 0.9),
    ("released into the public domain", "public-domain", 0.9),
    ("this is free and unencumbered software released into the public domain", "unlicense", 0.95),
    ("open database license", "odbl", 0.9),
]
BASE_WEIGHTS = {"cc-by": 0.7, "gpl": 0.7, "reserved": 0.5}
TAG = "spdx license identifier"
TAG_WEIGHT = 0.99

# The scale of obligations that expressions are evaluated on.
TERMS = ["public-domain", "permissive", "weak-copyleft", "strong-copyleft", "network-copyleft",
         "restricted"]

# Licence identifiers by their place on that scale (lower case; a trailing "-only",
# "-or-later" or "+" is taken off before the look-up).
IDENTIFIERS = {
    "public-domain": ["0bsd", "cc0-1.0", "unlicense", "wtfpl"],
    "permissive": ["afl-3.0", "apache-1.1", "apache-2.0", "artistic-2.0", "bsd-2-clause", "bsd-3-clause",
                   "bsd-4-clause", "bsl-1.0", "cc-by-3.0", "cc-by-4.0", "isc", "mit", "mit-0", "ncsa",
                   "openssl", "php-3.01", "postgresql", "psf-2.0", "python-2.0", "ruby", "unicode-3.0",
                   "upl-1.0", "w3c", "x11", "zlib"],
    "weak-copyleft": ["cddl-1.0", "cddl-1.1", "cecill-c", "epl-1.0", "epl-2.0", "lgpl-2.0", "lgpl-2.1",
                      "lgpl-3.0", "mpl-1.1", "mpl-2.0", "ms-pl", "odbl-1.0"],
    "strong-copyleft": ["cc-by-sa-3.0", "cc-by-sa-4.0", "cecill-2.1", "eupl-1.1", "eupl-1.2", "gfdl-1.2",
                        "gfdl-1.3", "gpl-1.0", "gpl-2.0", "gpl-3.0", "osl-3.0"],
    "network-copyleft": ["agpl-1.0", "agpl-3.0", "sspl-1.0"],
    "restricted": ["bsl-1.1", "busl-1.1", "cc-by-nc-3.0", "cc-by-nc-4.0", "cc-by-nc-nd-4.0",
                   "cc-by-nc-sa-4.0", "cc-by-nd-4.0", "elastic-2.0"],
}
EXCEPTIONS = ["autoconf-exception-3.0", "bison-exception-2.2", "classpath-exception-2.0",
              "font-exception-2.0", "gcc-exception-3.1", "libtool-exception", "linux-syscall-note",
              "llvm-exception", "openssl-exception", "qt-gpl-exception-1.0"]

_LEVEL = {name: TERMS.index(term) for term, ids in IDENTIFIERS.items() for name in ids}
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACED = bytes(c if _WORD.match(bytes([c])) else 32 for c in _LOWER)


@dataclass(frozen=True)
class Expression:
    """``ids``: the licences named, in order; ``level``: the value of the whole on TERMS."""

    ids: tuple[str, ...]
    level: int


def licence_level(name: str) -> int | None:
    """Place of a licence identifier on TERMS; an own reference (``licenseref-``) is
    restricted, anything else unknown (None)."""
    name = name.lower()
    if name.startswith(("licenseref-", "documentref-")):
        return TERMS.index("restricted")
    for ending in ("+", "-only", "-or-later"):
        name = name.removesuffix(ending)
    return _LEVEL.get(name)


def _apply(op: str, values: list) -> None:
    right, left = values.pop(), values.pop()
    if op == "with":
        # An exception takes strong copyleft down one step; it changes nothing else.
        level = left.level - 1 if left.level == TERMS.index("strong-copyleft") else left.level
        values.append(Expression(left.ids, level))
    else:
        level = (min if op == "or" else max)(left.level, right.level)
        values.append(Expression(left.ids + right.ids, level))


def parse_expression(text: str) -> Expression | None:
    """The licence expression that ``text`` begins with (one line), by shunting-yard.

    ``with`` binds tighter than ``and``, and that tighter than ``or``; operators of one kind
    group to the left; case does not matter. ``or`` leaves the choice (the lighter side),
    ``and`` holds both (the heavier side). Reading stops before the first token that
    cannot go on (prose after a tag): operators without a right side and brackets that
    are never closed are dropped. None if no known licence begins the text.
    """
    values: list[Expression] = []
    ops: list[str] = []
    at, operand_next, whole = 0, True, None

    def reduced():
        """Value of what was read so far, open brackets dropped."""
        vs, os = list(values), [o for o in ops if o != "("]
        while os:
            _apply(os.pop(), vs)
        return vs[0] if len(vs) == 1 else None

    while (m := _TOKEN.match(text, at)) is not None:
        token = m.group(1).lower()
        if operand_next:
            if token == "(":
                ops.append("(")
            elif ops and ops[-1] == "with":
                if token not in EXCEPTIONS:
                    break
                values.append(Expression((), 0))
                operand_next = False
            elif (level := licence_level(token)) is not None:
                values.append(Expression((token,), level))
                operand_next = False
            else:
                break
        elif token == ")":
            if "(" not in ops:
                break
            while (op := ops.pop()) != "(":
                _apply(op, values)
        elif token in _PRECEDENCE:
            # Only a licence takes an exception, not a bracket or another exception.
            if token == "with" and (not values[-1].ids or len(values[-1].ids) > 1):
                break
            while ops and ops[-1] != "(" and _PRECEDENCE[ops[-1]] >= _PRECEDENCE[token]:
                _apply(ops.pop(), values)
            ops.append(token)
            operand_next = True
        else:
            break
        if not operand_next:
            whole = reduced()
        at = m.end()
    return whole


@dataclass
class Scan:
    """What one text holds. ``base``: starting words of base matches by label."""

    n_words: int
    base_places: list[int]
    base_labels: set[str]
    labels: dict[str, float]
    terms: int | None
    notices: list[tuple[int, str]]


class LicenceScanner:
    """The automaton of all phrases; one object a task."""

    def __init__(self, notices: Sequence[tuple[str, str, float]] = tuple(NOTICES)):
        import ahocorasick
        phrases: dict[str, list[tuple[str, str, float]]] = {}
        for words, label in BASE_PHRASES.items():
            phrases.setdefault(words, []).append(("base", label, BASE_WEIGHTS[label]))
        for words, label, weight in notices:
            phrases.setdefault(words, []).append(("notice", label, weight))
        phrases.setdefault(TAG, []).append(("tag", "", TAG_WEIGHT))
        # One character a byte, so that no text needs decoding and any bytes will do.
        self._automaton = ahocorasick.Automaton()
        for words, found in phrases.items():
            key = f" {words} ".encode().decode("latin-1")
            self._automaton.add_word(key, (len(key), found))
        self._automaton.make_automaton()

    def scan(self, text: str | None) -> Scan:
        raw = (text or "").encode()
        words = raw.translate(_SPACED).split()
        line = b" %b " % b" ".join(words)
        out = Scan(len(words), [], set(), {}, None, [])
        tags, seen, word = [], 0, 0
        for end, (length, found) in self._automaton.iter(line.decode("latin-1")):
            begin = end - length + 1
            # Matches end in rising order: words are counted from the last one on.
            word += line.count(b" ", seen, end)
            seen = end
            first = word - line.count(b" ", begin, end)
            for kind, label, weight in found:
                if kind == "tag":
                    tags.append(word - 1)  # its last word
                    continue
                out.labels[label] = max(weight, out.labels.get(label, 0.0))
                if kind == "base":
                    out.base_places.append(first)
                    out.base_labels.add(label)
                else:
                    out.notices.append((first, label))
        if tags:
            self._read_tags(raw, tags, out)
        return out

    @staticmethod
    def _read_tags(raw: bytes, tags: list[int], out: Scan) -> None:
        """The expression after each tag: on its line, behind a colon."""
        wanted = set(tags)
        for k, m in enumerate(_WORD.finditer(raw.translate(_LOWER))):
            if k not in wanted:
                continue
            end = raw.find(b"\n", m.end())
            rest = raw[m.end():end if end >= 0 else len(raw)].decode("utf-8", "replace").lstrip(" \t")
            if not rest.startswith(":"):
                continue
            found = parse_expression(rest[1:])
            if found is None:
                continue
            out.terms = found.level if out.terms is None else max(out.terms, found.level)
            for name in found.ids:
                out.labels[name] = max(TAG_WEIGHT, out.labels.get(name, 0.0))
                out.notices.append((k - 2, name))


def _score(weights) -> float:
    """Chance that at least one label is right, taken as independent."""
    left = 1.0
    for w in sorted(weights):
        left *= 1.0 - w
    return 1.0 - left


SCHEMA = ("n_words long, base_places array<long>, base_labels string, labels string, score double, "
          "terms string, notices array<struct<word: long, label: string>>")


def scan_licences(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  notices: Sequence[tuple[str, str, float]] = tuple(NOTICES)) -> DataFrame:
    """``(doc_id, n_words, base_places, base_labels, labels, score, terms, notices)`` of every
    row of ``df``, over its whole text.

    ``base_places``: starting words of all matches of BASE_PHRASES. ``labels``: the labels of
    these, of notice phrases and of licences named by identifier tags
    (``SPDX-License-Identifier: <expression>``), distinct, sorted, comma-joined.
    ``score``: the chance that at least one label is right, from the labels' weights.
    ``terms``: what the tags' expressions come to on TERMS (several tags: the heaviest; null
    without one). ``notices``: ``(starting word, label)`` of the method's own matches, in order.

    Null and empty texts have no words, empty label strings, score 0. Repeated rows give
    repeated results; null ids pass through; columns of other names are not read.
    """
    names(df, [doc_id, text])
    notices = list(notices)

    def run(batches) -> Iterator:
        import pyarrow as pa
        scanner = LicenceScanner(notices)
        for b in batches:
            scans = [scanner.scan(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_pydict({
                "id": b.column(0),
                "n_words": pa.array([s.n_words for s in scans], pa.int64()),
                "base_places": pa.array([sorted(s.base_places) for s in scans], pa.list_(pa.int64())),
                "base_labels": pa.array([",".join(sorted(s.base_labels)) for s in scans]),
                "labels": pa.array([",".join(sorted(s.labels)) for s in scans]),
                "score": pa.array([_score(s.labels.values()) for s in scans], pa.float64()),
                "terms": pa.array([None if s.terms is None else TERMS[s.terms] for s in scans], pa.string()),
                "notices": pa.array([[{"word": w, "label": x} for w, x in sorted(set(s.notices))] for s in scans],
                                    pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
            })
        release_memory()

    kind = df.schema[doc_id].dataType.simpleString()
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", doc_id)


def licence_digest(df: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_licences``, with ``terms`` beside them."""
    s = scan_licences(df)
    return s.select("doc_id", "n_words", F.size("base_places").cast("long").alias("n_base"),
                    F.array_min("base_places").alias("first_word"),
                    F.array_max("base_places").alias("last_word"), "base_labels", "labels", "score", "terms")
