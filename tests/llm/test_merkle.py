"""Merkle manifest against a plain tree over sorted leaves."""

import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from statflow.llm import merkle as M

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, h int, key string, slot int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, k):
    out = []
    for level in levels[:-1]:
        a = k - k % 8
        out.append((level[a:k], level[k + 1:a + 8]))
        k //= 8
    return out


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the contract's result rows."""
    by = {}
    for d, s, g, n, t in rows:
        leaf = H(field(d), field(s), field(g), field(n), field(t))
        shown = H(field(d), field(s), field(g), field(n), field(lower(t)))
        tamper = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        by.setdefault(g, []).append((d, leaf, shown if tamper else leaf))
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        by[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [tree([x[1] for x in by[g]]) for g in order]
    top = tree([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for i, g in enumerate(order):
        for k, (d, leaf, shown) in enumerate(by[g]):
            p, h = path(trees[i], k) + path(top, i), shown
            for a, b in p:
                h = H(*a, h, *b)
            out.append((d, leaf, trees[i][-1][0], root, H(*(x for a, b in p for x in a + b)), h, h == root))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA).repartition(3)
    got = M.manifest_digest(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_rank_bitmap():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 150, 900, 4096):
        v = np.sort(rng.choice(4096, n, replace=False))
        b = M.RankBitmap.unpack(M.RankBitmap.of(v).pack())
        assert b.size == n and np.array_equal(b.members(), v)
        q = np.arange(4096)
        assert np.array_equal(b.rank(q), np.searchsorted(v, q))


def test_paths_round_trip():
    p = [([b"a" * 32], []), ([], [b"b" * 32] * 7), ([], [])]
    assert M.unpack_path(M.pack_path(p)) == p


def test_hard_rows(spark):
    """Nulls in every column, repeated rows, different rows with one id, extreme ids, clashing
    columns (h, key, slot), groups of one."""
    rows = [(None, None, None, None, None)] * 3 + [(None, "a", "en", 1, f"T{i}") for i in range(12)]
    rows += [(5, "a", "en", 3, "Same")] * 700 + [(5, "b", "en", 3, f"Other {i}") for i in range(20)]
    rows += [(i * 37, "s", "en", i, "Text É %d" % i) for i in range(40)]
    rows += [(-(1 << 63), "s", "en", 0, ""), ((1 << 63) - 1, "s", "en", 0, "x" * 9000), (-1, None, "en", 0, "A")]
    rows += [(i, "s", g, 1, "Z") for i, g in enumerate(["", "é", "z", "Z", "zz", "-", "0:", "fr", "de"])]
    check(spark, rows)


def test_several_rounds(spark):
    """More leaves than one array, more groups than one run, ids over many ranges."""
    rows = [(i * 11 % 20011, "s", "en" if i % 3 else f"g{i % 30}", i, f"Row {i}") for i in range(1500)]
    check(spark, rows)


def test_one_row_and_none(spark):
    check(spark, [(3, "s", "en", 1, "Only")])
    empty = spark.createDataFrame([], SCHEMA)
    m = M.build_manifest(empty, M.FIELDS)
    assert m.root is None and M.proofs(m).count() == 0 and M.manifest_digest(empty).count() == 0
    with pytest.raises(ValueError):
        M.build_manifest(empty.drop("text"), M.FIELDS)


def test_proofs_lead_to_the_root(spark):
    m = M.build_manifest(spark.read.parquet(f"{SF}/documents.parquet"), M.FIELDS)
    rows = M.proofs(m).collect()
    assert len(rows) == 200
    for r in rows:
        steps = [([bytes.fromhex(x) for x in s["left"]], [bytes.fromhex(x) for x in s["right"]]) for s in r["path"]]
        assert M.fold(bytes.fromhex(r["leaf"]), steps) == m.root


def test_op11_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*M.FIELDS).collect()
    got = entry.queries()["op11_merkle_manifest"](spark, SF).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(d) for d in docs])
