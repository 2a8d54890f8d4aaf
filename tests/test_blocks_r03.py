"""Lookups, counts and topic updates by blocks: same rows, fewer of them shuffled."""

import dataclasses
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from statflow.operators import lda
from statflow.operators import models as M

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_tf_idf_counts_documents_where_they_are(spark):
    plan = _plan(entry.queries()["tf_idf"](spark, SF))
    assert "hashpartitioning(doc_id" in plan
    assert not re.search(r"hashpartitioning\(doc_id#\d+L, term", plan)


def test_tf_idf_of_terms_in_one_document(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["b", None]), (3, []), (None, ["c", "c"]), (None, ["c"]), (4, None)]
    got = {(r.d, r.term): r for r in M.tf_idf(spark.createDataFrame(rows, "d int, t array<string>"), "d", "t").collect()}
    assert {k: (r.tf, r.df) for k, r in got.items()} == {
        (1, "a"): (2, 1), (1, "b"): (1, 2), (2, "b"): (1, 2), (None, "c"): (3, 1)}
    assert got[1, "a"].tf_idf == pytest.approx(2 * np.log(7 / 2)) and got[1, "b"].idf == pytest.approx(np.log(7 / 3))


@pytest.mark.parametrize("blocks", [1, 5])
def test_lookup_by_blocks_is_the_join(spark, blocks):
    rows = [(1, "x", [0, 1, 0]), (1, "x", [2]), (2, None, [9, None, 3]), (None, "y", [1]), (3, "z", []), (4, "z", None)]
    df = spark.createDataFrame(rows, "k int, g string, i array<int>")
    vocab = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "e"), (None, "f"), (7, "h")],
                                  "term_index int, term string")
    joined, dealt = (M.lookup_long(df, ["k", "g"], "i", vocab, blocks=n) for n in (None, blocks))
    assert joined.columns == dealt.columns and dict(joined.dtypes) == dict(dealt.dtypes)
    assert _rows(joined) == _rows(dealt) and len(_rows(dealt)) == 9
    empty = M.lookup_long(df.where("k > 9"), ["k", "g"], "i", vocab, blocks=blocks)
    assert empty.count() == 0
    assert "ReusedExchange" in _plan(dealt)  # the rows are dealt once


@pytest.mark.parametrize("blocks", [1, 5])
def test_encode_by_blocks(spark, blocks):
    rows = [(1, ["x", "y", "x"]), (2, ["z", "w"]), (2, ["x", "z"]), (None, ["y"]), (None, ["x"]), (3, []), (4, None), (5, ["w"])]
    df = M.in_blocks(spark.createDataFrame(rows, "k int, t array<string>"), ["k"], blocks)
    held = M.block_terms(df, "t")
    assert held.agg(F.sum("n")).first()[0] == 10
    vocab = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z"), (8, "q")], "term_index int, term string")
    got = M.encode(df, "k", "t", held, vocab, "idx")
    # Rows of one key are one, place by place; "w" is not in the vocabulary.
    assert _rows(got) == sorted([(1, [0, 1, 0]), (2, [0, 2, 2]), (None, [0, 1])], key=str)


def test_lookup_query_shuffles_no_word_by_term(spark):
    plan = _plan(entry.queries()["lookup"](spark, SF))
    assert "FlatMapCoGroupsInArrow" in plan
    assert not re.search(r"hashpartitioning\(doc_id#\d+L, 8", plan)


def test_topic_counts_stay_in_their_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(f"d{rng.integers(9)}" if i % 11 else None, int(rng.integers(25)), float(rng.random() + 0.1)) for i in range(300)]
    e = spark.createDataFrame(rows, "d string, term_index int, w double")
    vocab = spark.createDataFrame([(t, f"t{t}") for t in range(20)], "term_index int, term string")
    m = lda.fit_topics(e, vocab, 3, 2, 1)
    folder = m.folder.removeprefix("file:")
    assert m.blocks == lda.BLOCKS and all(re.fullmatch(r"\d+\.parquet", f) for f in os.listdir(folder))
    kept, sent = lda.update(e, m), lda.update(e, dataclasses.replace(m, blocks=0))
    for a, b in ((kept.terms, sent.terms), (kept.docs, sent.docs)):
        for x, y in zip(_rows(a), _rows(b), strict=True):
            assert x[0] == y[0] and np.allclose(x[1:], y[1:])
    assert kept.terms.count() == 20 and np.allclose(kept.totals, sent.totals)
    lda._drop(kept)
    assert not os.path.exists(kept.folder.removeprefix("file:"))
