"""BM25 search and nearest neighbours against scoring everything."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from statflow.llm import ann, bm25

SF = "/root/testdata/sf0.001"


def brute_bm25(rows, modulus, k):
    words = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower()) for _, t in rows]
    tf = [Counter(w) for w in words]
    df = Counter(w for c in tf for w in c)
    n, avg = len(rows), sum(map(len, words)) / max(len(rows), 1)
    idf = {w: math.log1p((n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    out = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is None or doc_id % modulus:
            continue
        found = []
        for j, (other, _) in enumerate(rows):
            if i == j:
                continue
            norm = 1.2 * (0.25 + 0.75 * len(words[j]) / avg)
            s = sum(q * idf[w] * tf[j][w] * 2.2 / (tf[j][w] + norm)
                    for w, q in tf[i].items() if w in tf[j])
            if s > 0:
                found.append((-s, other is None, other))
        out.setdefault(doc_id, []).extend((-s, d) for s, _, d in sorted(found)[:k])
    return out


def compare(rows, want):
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["score"], r["doc_id"]))
    assert set(got) == {q for q, w in want.items() if w}
    for q, found in got.items():
        assert [round(s, 6) for s, _ in found] == [round(s, 6) for s, _ in want[q]]
        # Ids agree except where two scores differ by rounding only.
        for (s, d), (_, e) in zip(found, want[q]):
            assert d == e or any(abs(s - t) < 1e-6 and d == f for t, f in want[q])


def test_op2_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = entry.queries()["op2_block_max_bm25"](spark, SF).collect()
    compare(rows, brute_bm25(docs, 20, 10))


def test_bm25_many_shards_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_BYTES", 6000)
    monkeypatch.setattr(bm25, "BLOCK_DOCS", 8)
    monkeypatch.setattr(bm25, "GROUP_BYTES", 9000)
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(1, 40), p=_zipf(60)))) for i in range(300)]
    docs += [(None, "w1 w2"), (300, None), (320, ""), (340, "***"), (5, docs[5][1]), (360, "w3 " * 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    compare(bm25.search_self(df, 20, 10).collect(), brute_bm25(docs, 20, 10))
    assert bm25.search_self(df.limit(0)).count() == 0


def _zipf(n):
    p = 1 / np.arange(1, n + 1)
    return p / p.sum()


def test_pruning_skips_blocks_and_loses_nothing():
    rng = np.random.default_rng(5)
    n, n_words, k = 2000, 400, 5
    half = rng.integers(0, 2, n)  # two languages
    docs = [np.unique(rng.choice(200, 30, p=_zipf(200)) + 200 * h) for h in half]
    bounds = np.r_[0, np.cumsum([len(d) for d in docs])]
    shard = bm25.Shard(np.arange(n_words, dtype=np.uint64), rng.random(n_words) + 0.1, np.arange(n),
                       bounds, np.concatenate(docs), np.ones(bounds[-1], np.int64), np.full(n, 1.2))
    shard.prepare()
    words = docs[0]
    q = bm25.Queries(words.astype(np.uint64), np.array([0]), np.array([0]), np.zeros(1),
                     np.zeros(len(words), np.int64), np.arange(len(words)), np.ones(len(words)))
    query, doc, _ = shard.search(q, k, q.floor, np.array([0]))
    exact = shard.exact(q, np.zeros(n, np.int64), np.arange(n))
    exact[0] = -1
    best = np.sort(exact)[-k:]
    found = np.sort(shard.exact(q, query, doc))[-k:]
    assert np.allclose(best, found)
    assert len(doc) < n / 4


def brute_nearest(vectors, modulus, k):
    good = {}
    for i, v in vectors:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            good[(i, tuple(v))] = True
    width = Counter(len(v) for _, v in good).most_common(1)[0][0]
    items = [(i, np.array(v)) for i, v in good if len(v) == width]
    ids, mat = np.array([i for i, _ in items]), np.stack([v for _, v in items])
    out = {}
    for i, v in items:
        if i % modulus == 0:
            d = np.sqrt(((mat - v) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(ids[j], d[j]) for j in order]
    return out


def recall(rows, want):
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    for q, found in got.items():
        exact = dict(want[q])
        assert [s for _, s in found] == sorted(s for _, s in found)
        assert all(abs(exact[i] - s) < 1e-12 for i, s in found if i in exact)
    return hit / sum(map(len, want.values()))


def test_op5_recall(spark):
    sf = "/root/testdata/sf0.01"
    table = [(r["vec_id"], r["embedding"]) for r in
             spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = entry.queries()["op5_posting_list_search"](spark, sf).collect()
    want = brute_nearest(table, 100, 10)
    assert len(rows) == sum(map(len, want.values()))
    assert recall(rows, want) >= 0.95


def test_neighbours_odd_rows_and_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 16)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(400, 600)]   # one very common vector
    rows += [(600, None), (700, [0.0] * 4), (800, [1.0, None, 0.0, 0.0]), (900, [float("nan")] * 4),
             (1000, [float("inf")] * 4), (1100, [1.0, 2.0]), (None, [1.0] * 4), (400, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
            for i, v in rows]
    want = brute_nearest(rows, 100, 10)
    got = ann.search_self(df).collect()
    assert recall(got, want) >= 0.9
    assert [r["vec_id"] for r in got if r["query_id"] == 400] == \
        [i for i, _ in want[400]] == list(range(401, 411))
    few = ann.search_self(df.where("vec_id in (0, 1, 2)")).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]
    assert ann.search_self(df.limit(0)).count() == 0


def test_repeated_rows_hide_no_neighbour(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 64)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    rows += [(i, [1.0]) for i in range(300, 320)]  # a rare length, common with its repeats
    want = brute_nearest(rows, 10, 10)
    many = [r for r in rows for _ in range(12 if len(r[1]) == 4 else 200)]
    df = spark.createDataFrame(many, "vec_id long, embedding array<double>").repartition(5)
    got = ann.search_self(df, 10).collect()
    assert len(got) == sum(map(len, want.values()))
    assert recall(got, want) >= 0.95
    few = [(1, [1.0, 0.0])] * 12 + [(2, [1.0, 0.1]), (3, [0.9, 0.0]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(few, "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in ann.search_self(df, 4).orderBy("rank").collect()] == [2, 3, 1]
    # Two vectors of an id at one distance are two rows.
    two = [(1, [0.0, 1.0]), (1, [0.0, -1.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])]
    df = spark.createDataFrame(two, "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in ann.search_self(df, 2).orderBy("rank").collect()] == [1, 1, 3]


def test_lists_follow_the_rows_at_every_size(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 6))
    x[:2000] = x[0] + 0.01 * x[:2000]  # a third of all rows in one place
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>").repartition(3)
    for lists in (1, 30, 1600):
        c = ann.fit_lists(df, 6000, lists, sample=500, cell_sample=300)
        assert 0.8 * lists <= len(c.points) <= 1.2 * lists + 1
        again = ann.fit_lists(df.repartition(5), 6000, lists, sample=500, cell_sample=300)
        assert np.allclose(c.points, again.points) and (c.graph == again.graph).all()
    found, _ = c.search(x[::60], 5, 32)
    d = ((x[::60, None] - c.points) ** 2).sum(2)
    exact = np.argsort(d, axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found, exact)]) > 0.9


def test_of_several_vectors_of_a_query_the_smallest_is_asked(spark):
    rows = [(2, [5.0, 0.0]), (2, [0.0, 5.0]), (1, [0.0, 4.0]), (3, [4.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search_self(df, 2).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got][0] == (1, 1.0)


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 8))
    c = ann.fit_centroids(x, 100)
    found, dist = c.search(x[:200], 5, 32)
    d = np.sqrt(((x[:200, None] - c.points) ** 2).sum(2))
    exact = np.argsort(d, axis=1)[:, :5]
    same = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found, exact)])
    assert same > 0.95
    size = np.bincount(np.argmin(((x[:, None] - c.points) ** 2).sum(2), 1), minlength=100)
    assert size.max() < 5 * size.mean()
