"""What stays on disk while a job runs: shuffles of written tables, tables nobody reads again."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from statflow.operators import lda
from statflow.operators import models as M
from statflow.operators.ordering import running_total
from statflow.session import SHUFFLE_CLEANUP, discard, ensure_checkpoint_dir, file_system, stored


def _shuffles(spark):
    """Names of the shuffle files that Spark holds (one process in tests)."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _folders(spark):
    return set(os.listdir(file_system(ensure_checkpoint_dir(spark))[1]))


def test_a_stored_table_leaves_no_shuffle(spark):
    before, setting = _shuffles(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    table = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")))
    assert not _shuffles(spark) - before and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert table.count() == 7
    folder = {f.rsplit("/", 2)[1] for f in table.inputFiles()}
    assert folder <= _folders(spark)
    discard(table)
    assert not folder & _folders(spark)


def test_a_running_total_keeps_one_table(spark):
    df, before = spark.createDataFrame([(3, 1), (1, 2), (2, 4)], "k int, v int"), _folders(spark)
    out = running_total(df, "v", ["k"], "t")
    assert len(_folders(spark) - before) == 1
    assert sorted((r.k, r.t) for r in out.collect()) == [(1, 2), (2, 6), (3, 7)]


def _entries(spark):
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(30)), int(rng.integers(50)), float(rng.random() + 0.1)) for _ in range(600)]
    vocab = spark.createDataFrame([(t, f"t{t}") for t in range(50)], "term_index int, term string")
    return spark.createDataFrame(rows, "d int, term_index int, w double"), vocab


def test_a_fit_keeps_its_last_update_only(spark):
    e, vocab = _entries(spark)
    before, held = _folders(spark), _shuffles(spark)
    m = lda.fit_topics(e, vocab, 3, 3, 1)
    left = _folders(spark) - before
    assert len(left) == 2 and m.folder.rsplit("/", 1)[1] in left  # its terms and its documents' counts
    assert not _shuffles(spark) - held
    assert m.terms.count() == 50 and m.docs.count() == 30


def test_an_update_by_dealt_entries_is_one_by_rows(spark):
    e, vocab = _entries(spark)
    m = lda.update(e, lda.start(vocab, 3, 1))
    dealt = lda.deal(e)
    for a, b in ((lda.update(e, m), lda.update(dealt, m)),):
        for x, y in ((a.terms, b.terms), (a.docs, b.docs)):
            x, y = (sorted(map(tuple, t.collect())) for t in (x, y))
            assert np.allclose(x, y)
        assert np.allclose(a.totals, [r for r in a.terms.agg(*[F.sum(f"c{j}") for j in range(3)]).first()])


def test_mixtures_by_blocks_are_those_by_a_join(spark):
    import dataclasses
    rows = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["y", "z"]), ("c", ["z"]), ("d", [])],
                                 "k string, w array<string>")
    vocab, packed = M.weighted_terms(rows, "k", "w")
    m = lda.fit_topics(lda.entries(packed, "k"), vocab, 2, 3, 1)
    by_blocks, by_join = ({r.k: r.weights for r in lda.mixtures(x, packed, "k").collect()}
                          for x in (m, dataclasses.replace(m, folder=None, blocks=0)))
    assert by_blocks.keys() == by_join.keys() == set("abcd")
    assert all(by_blocks[k] == pytest.approx(by_join[k]) for k in by_join)


def test_eigenvector_rounds_keep_their_result_only(spark):
    from statflow.operators import embeddings as E
    texts = [(i, [f"w{(i * j) % 23}" for j in range(2 + i % 9)]) for i in range(60)]
    df = spark.createDataFrame(texts, "d int, terms array<string>")
    before, held = _folders(spark), _shuffles(spark)
    model = E.embed_terms(df, "terms", 3)
    left = _folders(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("rdd-")  # the vectors
    assert not _shuffles(spark) - held
    assert model.size == 3 and model.vectors.count() > 20
    assert E.mean_vectors(df, ["d"], "terms", model).count() == 60
