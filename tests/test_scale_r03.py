"""What keeps the larger tables within their limits: one pass, one shuffle, bounded tasks."""

import numpy as np

from pyspark.sql import functions as F

from statflow.operators import aggregates as A
from statflow.operators import embeddings as E
from statflow.operators import lda
from statflow.operators import models as M
from statflow.operators import ordering
from statflow.operators.partitioning import spread
from statflow.plans import flows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_means_are_one_aggregate(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, 4.0, 5.0)], "a double, b double, c double")
    out = A.impute_mean(df, ["a", "b", "c"])
    assert "ubquery" not in _plan(out) and out.columns == ["a", "b", "c"]
    assert sorted(tuple(r) for r in out.collect()) == [(1.0, 4.0, 3.0), (1.0, 4.0, 5.0)]


def test_car_numbers_share_their_expressions(spark):
    texts = spark.createDataFrame([["1"] * len(flows.CAR_COLUMNS)], flows.CAR_COLUMNS)
    plan = flows.car_values(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") <= 8  # before: one or three for each of 22 columns


def test_pairs_are_shuffled_under_one_order(spark):
    df = spark.createDataFrame([(["x", "y", "x", "x"],), (["y", "x", None],)], "t array<string>")
    counted = E.cooccurrences(df, "t", 2)
    assert "least(" in _plan(counted)
    got = {(r.term, r.context): r.n for r in counted.collect()}
    assert got == {("x", "y"): 4, ("y", "x"): 4, ("x", "x"): 4}


def test_rank_writes_no_checkpoint(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "g int, x int")
    ranked = ordering.global_rank(df, [F.asc("x")], "rank", ["g"])
    assert "table-" in ranked._jdf.queryExecution().toString() or len(ranked.inputFiles()) > 0
    assert all(r["rank"] == r.x // 7 + 1 for r in ranked.collect())


def test_counts_by_document_need_one_shuffle(spark):
    df = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["y"]), (None, ["z"])], "k string, t array<string>")
    counts = M.term_counts(spread(df, 3, "k"), "k", "t")
    assert _plan(counts).count("Exchange") == 1
    assert {(r.k, r.term): r.tf for r in counts.collect()} == {
        ("a", "x"): 2, ("a", "y"): 1, ("b", "y"): 1, (None, "z"): 1}


def test_updates_do_not_depend_on_blocks(spark, monkeypatch):
    """Repeated entries, entries of unknown terms and null documents included."""
    rng = np.random.default_rng(3)
    rows = [(f"d{rng.integers(9)}" if i % 11 else None, int(rng.integers(25)), float(rng.random() + 0.1)) for i in range(300)]
    e = spark.createDataFrame(rows, "d string, term_index int, w double")
    vocab = spark.createDataFrame([(t, f"t{t}") for t in range(20)], "term_index int, term string")
    found = []
    for blocks, chunk in ((1, 1 << 20), (5, 7)):
        monkeypatch.setattr(lda, "BLOCKS", blocks)
        monkeypatch.setattr(lda, "CHUNK", chunk)
        m = lda.fit_topics(e, vocab, 3, 3, 1)
        found.append([{r[0]: np.array(r[1:]) for r in t.select(key, "c0", "c1", "c2").collect()}
                      for t, key in ((m.terms, "term_index"), (m.docs, "d"))])
    for one, other in zip(*found):
        assert one.keys() == other.keys() and all(np.allclose(one[x], other[x]) for x in one)
    assert len(found[0][0]) == 20 and None not in found[0][1]


def test_text_tasks_grow_with_the_rows(spark, monkeypatch):
    from statflow.plans import queries as Q
    monkeypatch.setattr(Q, "TEXT_ROWS", 1)
    docs = Q._doc_terms(spark, "/root/testdata/sf0.001")
    assert docs.rdd.getNumPartitions() == docs.count() > Q.TEXT_TASKS
