"""Least squares, logistic regression, keyed jobs, text statistics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statflow.operators import aggregates as A
from statflow.operators import models as M
from statflow.operators.features import split
from statflow.operators.jobs import cluster_by, keyed_job

SF = "/root/testdata/sf0.001"


def test_gram_and_ols_match_numpy(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    xs, y = ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"
    pdf = li.select(*xs, y).toPandas()
    X = np.column_stack([np.ones(len(pdf))] + [pdf[c].to_numpy() for c in xs])
    g = {(r.i, r.j): r.value for r in A.gram(li, xs, y).collect()}
    xtx = X.T @ X
    for i in range(4):
        for j in range(i, 4):
            assert g[(i, j)] == pytest.approx(xtx[i, j], rel=1e-9)
    beta = {r.term: r.beta for r in M.ols(li, xs, y).collect()}
    want = np.linalg.lstsq(X, pdf[y].to_numpy(), rcond=None)[0]
    assert [beta[t] for t in ["const"] + xs] == pytest.approx(list(want), rel=1e-6, abs=1e-6)
    exact = {r.term: r.beta for r in M.ols(li, xs, y, exact_scale=2).collect()}
    assert [exact[t] for t in ["const"] + xs] == pytest.approx(list(want), rel=1e-6, abs=1e-6)
    # residuals orthogonal to X
    resid = pdf[y].to_numpy() - X @ np.array([beta[t] for t in ["const"] + xs])
    assert np.abs(X.T @ resid).max() < 1e-3 * np.abs(X.T @ pdf[y].to_numpy()).max()


@pytest.mark.parametrize("scale", [None, 2])
def test_ols_aliased_terms_are_null(spark, scale):
    """b, d and e follow from the terms before them; the others are those of the fit without."""
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3), 0.0, i + 5.0 - i % 3, 3.0 * i + 1 - 2 * (i % 3))
                                for i in range(20)], "a double, b double, c double, d double, e double, y double")
    rows = M.ols(df, ["a", "b", "c", "d", "e"], "y", exact_scale=scale).collect()
    assert [r.term for r in rows] == ["const", "a", "b", "c", "d", "e"]
    beta = {r.term: r.beta for r in rows}
    assert beta["b"] is None and beta["d"] is None and beta["e"] is None
    assert (beta["const"], beta["a"], beta["c"]) == pytest.approx((1.0, 3.0, -2.0))


def test_keyed_job_reducer_matches_aggs(spark):
    rows = [("hot", float(i)) for i in range(300)] + [(f"k{i % 5}", 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "key string, v double").repartition(4)

    def reducer(pdf):
        return pdf.groupby("key", as_index=False).agg(n=("n", "sum"), s=("s", "sum"))

    mapped = df.select("key", F.lit(1).cast("long").alias("n"), F.col("v").alias("s"))
    got = keyed_job(mapped, "key", reducer=reducer, reduce_schema="key string, n long, s double",
                    salts=8)
    want = df.groupBy("key").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture
def small_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_combiner_over_many_batches(spark, small_batches):
    """Keys run over batch edges; a null key is a key; two key columns."""
    rows = [(None if i % 7 == 0 else f"k{i % 3}", i % 2, i) for i in range(100)]
    df = spark.createDataFrame(rows, "a string, b int, v long").repartition(3)

    def reducer(pdf):
        return pdf.groupby(["a", "b"], as_index=False, dropna=False).agg({"v": "sum"})

    got = keyed_job(df, ["a", "b"], reducer=reducer, reduce_schema="a string, b int, v long", n_out=4)
    assert got.rdd.getNumPartitions() == 4
    want = df.groupBy("a", "b").agg(F.sum("v").alias("v"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


class _Trace:
    """Not associative: the values in order, and where each call began."""

    def __init__(self, key):
        self.key, self.seen, self.calls = key, [], 0

    def add(self, rows):
        self.calls += 1
        self.seen += rows["v"].tolist()

    def finish(self):
        import pandas as pd
        return pd.DataFrame({"k": [self.key[0]], "calls": [self.calls],
                             "trace": [",".join(map(str, self.seen))]})


def test_sorted_reducer_sees_rows_in_order(spark, small_batches):
    from statflow.operators.jobs import each_key
    rows = [("hot", i) for i in range(40)] + [("a", 5), ("a", 1), (None, 2), (None, 1), ("b", 3)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(4)
    got = {r.k: r for r in keyed_job(df, "k", stream=each_key(_Trace, ["k"]), order=[F.desc("v")],
                                     reduce_schema="k string, calls long, trace string").collect()}
    assert {k: r.trace for k, r in got.items()} == {
        "hot": ",".join(map(str, range(39, -1, -1))), "a": "5,1", None: "2,1", "b": "3"}
    assert got["hot"].calls >= 13  # the group came in batches


def test_sorted_reducer_partition_fields(spark):
    """Keys with one first column share a task: state may run over key edges."""
    class Rank:
        last, n = object(), 0

        def batch(self, rows, starts):
            out = []
            for k in rows["a"]:
                self.n = self.n + 1 if k == self.last else 1
                self.last = k
                out.append(self.n)
            return rows.assign(rank=out)

        def end(self):
            return None

    df = spark.createDataFrame([(i % 4, i) for i in range(80)], "a long, b long")
    got = keyed_job(df, ["a", "b"], stream=Rank, partition_by="a", reduce_schema="a long, b long, rank long")
    assert all(r["rank"] == r.b // 4 + 1 for r in got.collect())
    empty = keyed_job(df.where("a < 0"), "a", stream=Rank, reduce_schema="a long, b long, rank long")
    assert empty.count() == 0
    with pytest.raises(ValueError):
        keyed_job(df, ["a", "b"], stream=Rank, partition_by="b", reduce_schema="a long")
    with pytest.raises(ValueError):
        keyed_job(df, "a", stream=Rank, aggs=[F.count("*")], reduce_schema="a long")


def test_cluster_by_sorts_across_partitions(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 0), ("a", 1)] * 10, "k string, v int")
    out = cluster_by(df, "k", n=3)
    keys = [r.k for r in out.collect()]
    assert keys == sorted(keys)


def test_split_is_reproducible(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a1, b1 = split(df, [0.7, 0.3], 5, ["k"])
    a2, _ = split(df.repartition(7), [0.7, 0.3], 5, ["k"])
    s1 = {r.k for r in a1.collect()}
    assert s1 == {r.k for r in a2.collect()}
    assert len(s1) + b1.count() == 1000 and 600 < len(s1) < 800


def test_tf_idf_matches_spark_ml(spark):
    from pyspark.ml.feature import IDF, CountVectorizer
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])],
                               "d int, t array<string>")
    got = {(r.d, r.term): r.tf_idf for r in M.tf_idf(df, "d", "t").collect()}
    cv = CountVectorizer(inputCol="t", outputCol="tf").fit(df)
    ml = IDF(inputCol="tf", outputCol="w").fit(cv.transform(df)).transform(cv.transform(df))
    vocab = cv.vocabulary
    for r in ml.collect():
        for i, v in zip(r.w.indices, r.w.values):
            assert got[(r.d, vocab[i])] == pytest.approx(v)


def test_lookup_round_trip(spark):
    df = spark.createDataFrame([(1, ["x", "y", "x"]), (2, ["z"])], "d int, t array<string>")
    vocab = M.vocabulary(df, "d", "t")
    idx = {r.term: r.term_index for r in vocab.collect()}
    assert idx["x"] == 0
    coded = spark.createDataFrame([(1, [idx["x"], idx["y"], idx["x"]]), (2, [idx["z"]])],
                                  "d int, i array<int>")
    out = {r.d: r.words for r in M.lookup(coded, "i", vocab, "words").collect()}
    assert out == {1: ["x", "y", "x"], 2: ["z"]}


def test_lookup_keeps_rows_apart(spark):
    vocab = spark.createDataFrame([(0, "a"), (1, "b")], "term_index int, term string")
    df = spark.createDataFrame([(3, [1]), (3, [0]), (3, [0]), (4, []), (4, None), (None, [0, 7])],
                               "k int, i array<int>")
    got = sorted(((r.k, r.words) for r in M.lookup(df, "i", vocab, "words").collect()), key=str)
    assert got == sorted([(3, ["b"]), (3, ["a"]), (3, ["a"]), (4, []), (4, None), (None, ["a", None])],
                         key=str)


def test_logistic_probabilities(spark):
    from statflow.plans.flows import flagship
    out = flagship(spark, SF).toPandas()
    assert len(out) > 0
    sums = out["probability"].apply(sum)
    assert np.allclose(sums, 1.0)
    assert set(out["prediction"]).issubset({0.0, 1.0})


def test_spread_follows_its_argument_only(spark):
    from statflow.operators.partitioning import spread
    one = spark.range(100).coalesce(1)
    assert spread(one) is one
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(spark.range(100).repartition(6), 4).rdd.getNumPartitions() == 4


def test_term_vectors_match_spark_ml(spark):
    from pyspark.ml.feature import IDF, CountVectorizer
    rows = [(1, ["b", "a", "a", "c"]), (2, ["a", "c", "d"]), (3, ["d", "d", "e"]), (4, [])]
    df = spark.createDataFrame(rows, "k int, t array<string>")
    vocab, vecs = M.term_vectors(df, "k", "t")
    order = [r.term for r in vocab.orderBy("term_index").collect()]
    assert order == ["a", "d", "c", "b", "e"]  # 3, 3 (tie by term), 2, 1, 1
    cv = CountVectorizer(inputCol="t", outputCol="tf").fit(df)
    ml = IDF(inputCol="tf", outputCol="w").fit(cv.transform(df)).transform(cv.transform(df))
    want = {r.k: {cv.vocabulary[i]: v for i, v in zip(r.w.indices, r.w.values) if v} for r in ml.collect()}
    got = {r.k: {order[i]: v for i, v in zip(r.tfidf_vec.indices.tolist(), r.tfidf_vec.values) if v}
           for r in vecs.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])
    for min_df in (2.0, 0.5):
        assert {r.term for r in M.term_vectors(df, "k", "t", min_df=min_df)[0].collect()} == {"a", "c", "d"}
    assert M.term_vectors(df, "k", "t", vocab_size=2)[0].count() == 2


def test_gram_and_ols_use_complete_rows_only(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 100.0), (4.0, None)],
                               "x double, y double")
    for scale in (None, 2):
        beta = {r.term: r.beta for r in M.ols(df, ["x"], "y", exact_scale=scale).collect()}
        assert beta == pytest.approx({"const": 0.0, "x": 2.0}, abs=1e-9)
        entries = A.gram(df, ["x"], "y", exact_scale=scale).collect()
        assert {(r.term_i, r.term_j): r.value for r in entries} == {
            ("const", "const"): 3, ("const", "x"): 6, ("const", "y"): 12, ("x", "x"): 14,
            ("x", "y"): 28, ("y", "y"): 56}


def test_tf_idf_splits_a_very_common_term(spark):
    df = spark.range(6000).select("id", F.array(
        F.lit("everywhere"), F.concat(F.lit("t"), F.col("id") % 997)).alias("t"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = M.tf_idf(df, "id", "t")
        assert len(out.collect()) == 12000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_identical_rows_of_a_hot_key_are_spread(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit("same line").alias("line"))
    out = cluster_by(df, "k", n=6)
    assert out.columns == ["k", "line"]
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() == 6


def test_cluster_by_spreads_hot_key(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, v int")
    out = cluster_by(df, "k", n=6).withColumn("pid", F.spark_partition_id())
    parts = out.where(F.col("k") == "hot").select("pid").distinct().count()
    assert parts > 1  # the hot key is not funnelled into one task
    keys = [r.k for r in out.collect()]
    assert keys == sorted(keys)


def test_build_features_equals_the_stages_and_refuses_nulls(spark):
    from pyspark.errors import PySparkException
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from statflow.operators import features as X
    rows = [(i, "abcab"[i % 5], i % 3, float(i % 4), i / 7) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, g string, n int, x double, y double")
    model, got = X.build_features(df, ["g", "n"], ["x", "y"])
    assert model.levels == {"g": 3, "n": 3} and model.size == 6
    idx = X.string_indexer(["g", "n"])
    ohe = X.one_hot_encoder(idx.getOutputCols())
    pipe = Pipeline(stages=[idx, ohe, X.assembler(["x", "y", *ohe.getOutputCols()])]).fit(df)
    want = {r["id"]: r["f"] for r in pipe.transform(df).select("id", vector_to_array("features").alias("f")).collect()}
    assert {r["id"]: r["f"] for r in got.select("id", vector_to_array("features").alias("f")).collect()} == want
    assert got.columns == [*df.columns, "features"]
    assert "Python" not in got._jdf.queryExecution().toString()
    # A column of one level has no slot; without categorical columns only the numbers stand.
    one, _ = X.build_features(df.where("g = 'c'"), ["g"], ["x"])
    assert one.size == 1
    assert X.build_features(df, [], ["y"])[1].count() == 40
    for bad in ("(1, null, 1, 1D, 1D)", "(1, 'zz', 1, 1D, 1D)", "(1, 'a', 1, null, 1D)"):
        odd = spark.sql(f"select * from values {bad} as t(id, g, n, x, y)")
        with pytest.raises(PySparkException):
            model.transform(odd)
