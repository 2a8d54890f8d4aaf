"""Conversation tries against plain prefix lists."""

import hashlib
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from statflow.llm import prefix_trie as P

SF = "/root/testdata/sf0.001"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, c int, key string, d double"


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: (t[:3], digest(t[2], t[3])))] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return trie(rebuilt)


def trie(rebuilt):
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for p, cs in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        kids = [q for q in sub if len(q) == len(p) + 1]
        leaves = [q for q in sub if not any(r[:len(q)] == q and len(r) == len(q) + 1 for r in sub)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        ends = ",".join(map(str, sorted(c for c in cs if len(rebuilt[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k", 0.5) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, P.conversation_trie(df).select(*COLS).collect()))


def test_hard_rows(spark):
    """Nulls everywhere, ties, repeated rows, absent bases, turnless conversations, ids below
    zero, clashing columns."""
    rows = [(c, t, "user" if t % 2 else None, f"é{t % 3}" * (t % 4)) for c in range(-7, 14) if c != 5
            for t in range(c % 7)]
    rows += [(3, None, "x", None), (3, None, "x", None), (3, 1, "b", "2"), (3, 1, "a", "2"), (3, 1, "a", "1")]
    rows += [(None, 1, "a", "b"), (40, 0, "", ""), (41, 0, "", ""), (42, None, None, None)]
    rows += [(c, t, "user", "same") for c in range(100, 130) for t in range(12)]
    assert run(spark, rows) == brute(rows)


def test_random_conversations(spark):
    import random
    rng = random.Random(5)
    rows = [(c, t, rng.choice("ab"), rng.choice(["x", "yy", ""])) for c in rng.sample(range(300), 120)
            for t in range(rng.randrange(7))]
    assert run(spark, rows) == brute(rows)


def test_one_long_conversation(spark):
    rows = [(10, t, "u", str(t % 7)) for t in range(2000)] + [(11, 0, "u", "0")]
    got = run(spark, rows)
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in (10, 11)}
    depth = max(r[1] for r in got)
    assert depth == 2000 and sum(r[3] for r in got if r[1] == 0) == 2
    assert [r for r in got if r[1] == h[11]][0][3] == 2


def test_ends_in_many_pieces(spark, monkeypatch):
    """The ids that end at one node, hashed over several pieces and tasks."""
    monkeypatch.setattr(P, "_CHUNK", 64)
    convs = spark.range(0, 500).withColumnRenamed("id", "c").repartition(4)
    turns = convs.selectExpr("c", "1L d", "cast('t' as binary) dig", "3L bytes").where("c % 2 = 0")
    got = {r.depth: r for r in P.build_trie(convs, turns).collect()}
    sha = [hashlib.sha256(",".join(map(str, range(k, 500, 2))).encode()).hexdigest() for k in (0, 1)]
    assert (got[1].ends_sha256, got[0].ends_sha256) == tuple(sha)
    assert (got[0].n_convs, got[1].n_convs, got[1].saved_tokens) == (500, 250, 249 * 3)


def test_turnless_only_and_empty(spark):
    one = spark.range(2, 4).withColumnRenamed("id", "c")
    none = one.selectExpr("c", "1L d", "cast('t' as binary) dig", "3L bytes").where("c < 0")
    assert [tuple(r) for r in P.build_trie(one, none).select(*COLS).collect()] == [
        (2, 0, None, 2, 0, 1, 0, hashlib.sha256(b"2,3").hexdigest())]
    assert run(spark, [(None, 1, "a", "b")]) == []
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        P.conversation_trie(spark.createDataFrame([], "conv_id long, turn long"))


def test_op12_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = entry.queries()["op12_prefix_trie"](spark, SF).select(*COLS).collect()
    assert sorted(map(tuple, got)) == brute(rows)
