"""Sharding and mixing (DataFrame functions only)."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from statflow.llm import mixing, sharding

SF = "/root/testdata/sf0.001"
ROWS = [(1, "Hello there", "a", 7, 7), (1, "Hello there", "a", 7, 7), (None, None, None, 7, 7),
        (None, "x y", None, 7, 7), (2, "", "a", 7, 7), (3, " \n", "b", 7, 7), (4, "é " * 9000, "b", 7, 7)]
SCHEMA = "doc_id long, text string, source string, shard int, slot int"


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "MapInArrow"))


def check_shards(rows, docs, n):
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                  for i, t in docs)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, by_key = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        by_key[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        assert 0 <= r["shard"] < n and r["grown_shard"] in (r["shard"], n)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_key.values())


def test_op1_contract(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = entry.queries()["op1_hash_tree_shards"](spark, SF)
    no_python(df)
    check_shards(df.collect(), docs, 8)


def test_shards_odd_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).drop("shard")
    check_shards(sharding.shard_digest(df).collect(), [(r[0], r[1]) for r in ROWS], 8)
    assert sharding.shard_digest(df.limit(0)).count() == 0


def test_weights_and_confined_movement(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "k")
    tree = {"e": {"e1": {0: 1.0, 1: 2.0}, "e2": {2: 1.0}}, "w": {"w1": {3: 4.0}, "w2": {4: 0.0, 5: 2.0}}}
    count = {r["shard"]: r["count"] for r in sharding.place(ids, "k", tree).groupBy("shard").count().collect()}
    for shard, weight in {0: 1, 1: 2, 2: 1, 3: 4, 5: 2}.items():
        assert abs(count[shard] / 20_000 - weight / 10) < 0.015
    assert 4 not in count
    # Inside rack e1 the weights trade places: nothing outside that rack moves.
    other = {**tree, "e": {"e1": {0: 2.0, 1: 1.0}, "e2": {2: 1.0}}}
    both = sharding.place(sharding.place(ids, "k", tree, "before"), "k", other, "after")
    assert both.where("before <> after and (before not in (0, 1) or after not in (0, 1))").count() == 0
    moved = both.where("before <> after")
    assert moved.count() > 0 and moved.where("not (before = 1 and after = 0)").count() == 0
    # A heavier shard draws rows into its own path only.
    more = {**tree, "w": {"w1": {3: 4.0}, "w2": {4: 0.0, 5: 6.0}}}
    grown = sharding.place(sharding.place(ids, "k", tree, "before"), "k", more, "after")
    assert grown.where("before <> after and after in (0, 1, 2)").count() == 0


def test_a_new_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "k")
    tree = sharding.uniform_tree(8)
    both = sharding.place(sharding.place(ids, "k", tree, "a"), "k", sharding.with_shard(tree, 8), "b")
    moved = both.where("a <> b")
    assert moved.where("b <> 8").count() == 0
    assert abs(moved.count() / 20_000 - 1 / 9) < 0.01


def brute_mix(rows, t, budget, repeats):
    tokens = defaultdict(int)
    for _, s, n in rows:
        tokens[s] += n
    total = sum(tokens.values())
    raw = {s: (n / total) ** t if n else 0.0 for s, n in tokens.items()}
    z = sum(raw.values())
    if budget == "cover":
        m = max(tokens[s] / raw[s] for s in raw if raw[s])
        spend = {s: raw[s] * m for s in raw}
    else:
        spend = {s: raw[s] / z * total for s in raw}
    return tokens, {s: x / z for s, x in raw.items()}, {s: math.floor(round(x, 6)) for s, x in spend.items()}


def check_mix(got, rows, budget, repeats=4.0):
    t = got[0]["exponent"]
    tokens, weight, spend = brute_mix(rows, t, budget, repeats)
    used = defaultdict(list)
    for r in got:
        used[r["source"], r["epoch"]].append(r)
        assert r["weight"] == pytest.approx(weight[r["source"]], abs=1e-8)
    many = defaultdict(Counter)
    for i, s, n in rows:
        many[s][i, n] += 1
    for s in tokens:
        stream = sorted((r for r in got if r["source"] == s and r["tokens"]), key=lambda r: r["start"])
        at = 0
        for r in stream:  # one stream without gaps that ends where the budget does
            assert r["start"] == at
            at += r["tokens"]
        if stream:
            assert stream[-1]["start"] < spend[s] <= at
            assert spend[s] <= repeats * tokens[s] + 1
            blocks = [r["block"] for r in stream]
            assert blocks == sorted(blocks)
        for e in range(max([r["epoch"] for r in stream], default=0)):
            assert Counter((r["doc_id"], r["tokens"]) for r in used[s, e]) == many[s]
        idle = [r for r in got if r["source"] == s and not r["tokens"]]
        assert all(r["epoch"] == 0 for r in idle)
        assert Counter((r["doc_id"], 0) for r in idle) == Counter({k: v for k, v in many[s].items() if not k[1]})


def test_op6_streams_and_target_entropy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", mixing.words(F.col("text"))).collect()]
    df = entry.queries()["op6_temperature_mix"](spark, SF)
    no_python(df)
    got = df.collect()
    check_mix(got, rows, "corpus")
    tokens, weight, _ = brute_mix(rows, got[0]["exponent"], "corpus", 4)
    total = sum(tokens.values())
    own = -sum(n / total * math.log(n / total) for n in tokens.values() if n)
    target = (own + math.log(len([n for n in tokens.values() if n]))) / 2
    assert -sum(w * math.log(w) for w in weight.values() if w) == pytest.approx(target, abs=1e-4)


@pytest.mark.parametrize("budget,repeats", [("corpus", 3.0), ("cover", 2.0)])
def test_repetition_limit_and_odd_rows(spark, monkeypatch, budget, repeats):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)
    rows = [(i, "big", 20 + i % 9) for i in range(400)] + [(1000 + i, "small", 10) for i in range(12)]
    rows += [(1000, "small", 10), (None, None, 30), (None, None, 30), (2000, "idle", 0), (2001, "big", 0),
             (2002, "one", 5000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, tokens long, epoch_name string, weight_old int")
    got = mixing.mix(df, target_part=None, max_repeats=repeats, budget=budget).collect()
    check_mix(got, rows, budget, repeats)
    if budget == "cover":
        assert {r["doc_id"] for r in got} == {r[0] for r in rows}
    assert 0 < got[0]["exponent"] < 1


def test_mixed_rows_keep_columns_and_empty_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = mixing.mixed_rows(df, target_part=None, max_repeats=2.0, budget="cover")
    assert got.columns == df.columns
    assert set(map(tuple, got.collect())) == set(ROWS)
    assert mixing.mixed_rows(df.limit(0)).count() == 0 and mixing.mix_documents(df.limit(0)).count() == 0
