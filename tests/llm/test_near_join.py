"""The near-duplicate join against comparing all pairs."""

import re
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from statflow.llm import components as cc
from statflow.llm import near_join as nj

SF = "/root/testdata/sf0.001"


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    texts = defaultdict(list)
    for i, t in rows:
        texts[t or ""].append(i)
    keys, sets = list(texts), [shingles(t) for t in texts]
    lead, links = list(range(len(keys))), [0] * len(keys)

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += len(texts[keys[b]])
                links[b] += len(texts[keys[a]])
                lead[find(a)] = find(b)
    ids = defaultdict(list)
    for k in range(len(keys)):
        ids[find(k)] += [i for i in texts[keys[k]] if i is not None]
    out = []
    for k, t in enumerate(keys):
        for i in texts[t]:
            out.append((i, min(ids[find(k)], default=None), links[k] + len(texts[t]) - 1))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_op8_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in entry.queries()["op8_lsh_forest_join"](spark, SF).collect()]
    assert order(got) == order(brute(docs))


def family(rng, n, words, edits, base=None):
    base = [f"w{x}" for x in rng.integers(0, 500, words)] if base is None else base
    for _ in range(n):
        w = list(base)
        for at in rng.integers(0, len(w), edits):
            w[at] = f"e{rng.integers(0, 10_000)}"
        yield " ".join(w)


ODD = [(None, None, "a", 1), (None, None, "a", 1), (9000, "", "a", 1), (9001, " \n", "b", 2),
       (9002, "one two", "b", 2), (9003, "One  two", "b", 2), (9004, "one two three", "c", 3),
       (9005, "x y z " * 5000, "c", 3), (9006, "x y z " * 5000 + "end", "c", 3), (None, "only null id", "d", 4)]


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(12)
    texts = list(family(rng, 120, 150, 4)) + list(family(rng, 30, 60, 1))
    passage = [f"p{x}" for x in range(60)]  # a passage that many documents share
    texts += [" ".join(passage + [f"q{x}" for x in rng.integers(0, 900, 60)]) for _ in range(60)]
    texts += [texts[3]] * 40 + [" ".join(f"r{x}" for x in rng.integers(0, 900, 80)) for _ in range(60)]
    return [(i, t, "s", 0) for i, t in enumerate(texts)] + ODD


SCHEMA = "doc_id long, text string, node string, links int"


def test_families_copies_passages_and_odd_rows(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    got = [tuple(r) for r in nj.jaccard_join(df).collect()]
    assert order(got) == order(brute([(r[0], r[1]) for r in docs]))


def test_the_same_in_many_chunks(spark, docs, monkeypatch):
    monkeypatch.setattr(nj, "CHUNK", 16)
    monkeypatch.setattr(nj, "CHUNK_BYTES", 20_000)
    df = spark.createDataFrame(docs, SCHEMA)
    got = [tuple(r) for r in nj.jaccard_join(df).collect()]
    assert order(got) == order(brute([(r[0], r[1]) for r in docs]))


def test_keep_one_keeps_the_first_of_each_class(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    kept = nj.keep_one(df)
    assert kept.columns == df.columns
    classes = {(i, c) for i, c, _ in brute([(r[0], r[1]) for r in docs])}
    want = sorted({c for _, c in classes if c is not None})
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == want
    assert [r["text"] for r in kept.where("doc_id is null").collect()] == ["only null id"]
    assert nj.keep_one(df.limit(0)).count() == 0 and nj.jaccard_join(df.limit(0)).count() == 0


def test_recall_model_and_depth():
    depth = nj.depth_for(0.8, nj.TARGET_RECALL)
    assert nj.recall(0.8, depth) >= nj.TARGET_RECALL > nj.recall(0.8, depth + 1)


def test_recall_measured_at_the_threshold():
    rng = np.random.default_rng(0)
    found = 0
    for _ in range(300):  # pairs with similarity 0.8: 160 common of 200
        h = rng.integers(0, 1 << 63, 200).astype(np.uint64)
        pool = nj.min_hashes(np.r_[h[:180], h[:160], h[180:]], np.array([0, 180, 360]))
        keys, _ = nj.trie_paths(pool, nj.depth_for(0.8, nj.TARGET_RECALL))
        found += bool((keys[0] == keys[1]).any())
    assert found >= 297


def test_depth_is_the_longest_prefix_with_the_target_recall_for_each_size():
    depths = nj.depths_by_size(*nj.THRESHOLD, nj.TARGET_RECALL)
    assert depths[-1] == depths.min() == nj.depth_for(0.8, nj.TARGET_RECALL)
    assert len(set(depths.tolist())) >= 3  # texts differ
    for m in range(1, nj.SMALL_SET):
        # By trying all sets: u in the union, i common.
        near = [i / u for u in range(m, 2 * m + 1) for i in range(1, m + 1) if 5 * i >= 4 * u]
        assert nj.least_similarity(m, *nj.THRESHOLD) == min(near)
        assert nj.recall(min(near), int(depths[m])) >= nj.TARGET_RECALL
        assert depths[m] == nj.MAX_DEPTH or nj.recall(min(near), int(depths[m]) + 1) < nj.TARGET_RECALL
    sets = [np.arange(3), np.arange(6), np.arange(6).repeat(20), np.arange(500)]
    bounds = np.r_[0, np.cumsum([len(x) for x in sets])]
    got = nj.text_depth(np.concatenate(sets).astype(np.uint64), bounds, depths)
    # Repeats in a short text count once; in a long one the depth is the safe, short one.
    assert got.tolist() == [depths[3], depths[6], depths[-1], depths[-1]]
    assert depths[3] > depths[6] > depths[-1]


def test_runs_of_a_trie_meet_at_the_shorter_prefix():
    rng = np.random.default_rng(4)
    shared, n = 6, 300
    group = np.sort(rng.integers(0, 3, n))
    labels = rng.integers(0, 2, (n, nj.MAX_DEPTH - shared))
    path = np.zeros(n, np.int64)
    for k in range(labels.shape[1]):
        path = path << 8 | labels[:, k]
    order = np.lexsort((path, group))
    group, labels, path = group[order], labels[order], path[order]
    depth = rng.choice(np.array([6, 7, 9, 12], np.int8), n)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    got = [tuple(sorted(p)) for a, b in nj.trie_pairs(first, path, depth, shared, 50)
           for p in zip(a.tolist(), b.tolist())]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if group[i] == group[j]
            and (labels[i] == labels[j])[:min(depth[i], depth[j]) - shared].all()}
    assert len(got) == len(set(got)) and set(got) == want


def test_short_texts_of_many_sizes(spark):
    """Texts of 1 to 30 n-grams, where depths differ, with one word more or less."""
    rng = np.random.default_rng(5)
    rows = []
    for m in range(1, 31):
        w = [f"s{m}x{x}" for x in range(m + 4)]
        rows += [" ".join(w), " ".join(w[:-1]), " ".join(w + ["more"]), " ".join(w).upper()]
        rows.append(" ".join(w[:-1] + [f"z{rng.integers(0, 99)}"]))
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert order([tuple(r) for r in nj.jaccard_join(df).collect()]) == order(brute(rows))


def test_components_on_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201)] * 2
    got = {r["node"]: r["lead"] for r in
           cc.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {x: 100 for x in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0
