"""Files and final scores of the BM25 shards."""

import numpy as np

from statflow.llm import bm25


def test_shard_files_are_compressed_and_read_back(tmp_path):
    data = bm25._pack(np.arange(50000, dtype="<u4"), np.ones(50000, "<u4"))
    bm25._keep(f"file://{tmp_path}/kept", "raw-1", data)
    size = sum(p.stat().st_size for p in tmp_path.rglob("raw-1"))
    assert 0 < size < len(data) / 4
    got = bm25._unpack(bm25._kept(f"file://{tmp_path}/kept", "raw-1"))
    assert (got[0] == np.arange(50000)).all() and (got[1] == 1).all()
    bm25._keep(f"file://{tmp_path}/kept", "raw-2", bm25._pack())
    assert bm25._unpack(bm25._kept(f"file://{tmp_path}/kept", "raw-2")) == []


def test_final_scores_take_known_impacts(monkeypatch):
    rng = np.random.default_rng(2)
    docs = [np.unique(rng.integers(0, 40, 12)) for _ in range(50)]
    bounds = np.r_[0, np.cumsum([len(d) for d in docs])]
    shard = bm25.Shard(np.arange(40, dtype=np.uint64), rng.random(40) + 0.1, np.arange(50), bounds,
                       np.concatenate(docs), np.ones(bounds[-1], np.int64), np.full(50, 1.2))
    words = np.concatenate([docs[3], docs[7]])
    q = bm25.Queries(np.arange(40, dtype=np.uint64), np.array([3, 7]), np.array([3, 7]), np.zeros(2),
                     np.repeat([0, 1], [len(docs[3]), len(docs[7])]), words, np.ones(len(words)))
    query, doc = np.repeat([1, 0], 50), np.tile(np.arange(50), 2)
    want, impact = shard.exact(q, query, doc), shard.impacts()
    calls = []
    monkeypatch.setattr(bm25.Shard, "impacts", lambda self: calls.append(1))
    got = shard.exact(q, query, doc, impact)
    assert not calls and (got == want).all()
    for n, (i, d) in enumerate(zip(query, doc)):
        mine = np.isin(docs[d], docs[3 if i == 0 else 7])
        assert np.isclose(got[n], impact[bounds[d]:bounds[d + 1]][mine].sum())
