"""Least squares and logistic regression from task matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statflow.operators import aggregates as A
from statflow.operators import linear
from statflow.operators import models as M


def _rows(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 50.0, 0.01] + [0.0, 200.0, 3.0]
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.3 + x[:, 0] - 0.02 * (x[:, 1] - 200))))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)],
                               "a double, b double, c double, label int").repartition(5)
    return x, y, df


def _newton(x, y, steps=40):
    m = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(m.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-m @ b))
        b += np.linalg.solve(m.T @ (m * (p * (1 - p))[:, None]), m.T @ (y - p))
    return m, b


def test_newton_matches_numpy_and_the_score_is_zero(spark):
    x, y, df = _rows(spark)
    fit = linear.fit_logistic_newton(df, ["a", "b", "c"])
    m, b = _newton(x, y)
    assert fit.converged and not fit.aliased
    assert np.allclose([fit.intercept, *fit.coefficients], b, rtol=1e-6)
    p = np.array([r.p for r in df.select("a", "b", "c", fit.probability().alias("p")).collect()])
    by = df.withColumn("r", F.col("label") - fit.probability()).agg(
        *[F.sum(F.col(c) * F.col("r")) for c in ("a", "b", "c")], F.sum("r")).first()
    assert np.abs(list(by)).max() < 1e-6 * np.abs(m).sum() and ((p > 0) & (p < 1)).all()


def test_newton_on_vectors_agrees_with_spark(spark):
    from statflow.operators.features import build_features
    x, y, df = _rows(spark, 600, 2)
    df = df.withColumn("g", F.when(F.col("a") > 0.5, "u").when(F.col("a") > -0.5, "v").otherwise("w"))
    _, data = build_features(df, ["g"], ["b", "c"])
    own = M.fit_logistic(data)
    other = M.fit_logistic(data, solver="lbfgs", tol=1e-12, maxIter=500)
    assert np.allclose(own.coefficients, other.coefficients.toArray(), rtol=1e-3, atol=1e-4)
    scored = M.predict(own, data, keep=["b"]).collect()
    assert all(abs(sum(r.probability) - 1) < 1e-12 and r.prediction == float(r.probability[1] > 0.5) for r in scored)
    # Every feature's score, not the intercept's alone.
    from pyspark.ml.functions import vector_to_array
    k = len(own.coefficients)
    rows = data.select((F.col("label") - own.probability()).alias("r"), vector_to_array("features").alias("x"))
    sums = rows.agg(*[F.sum(F.col("r") * F.col("x")[i]) for i in range(k)],
                    *[F.sum(F.abs(F.col("x")[i])) for i in range(k)]).first()
    assert all(abs(sums[i]) <= 1e-8 * sums[k + i] for i in range(k))


def test_newton_edge_cases(spark):
    """Nulls do not count, aliased features get no coefficient, separable data end, a single
    class too, no rows raise."""
    x, y, df = _rows(spark)
    more = df.unionByName(df.limit(3).withColumn("b", F.lit(None).cast("double")))
    plain = linear.fit_logistic_newton(df, ["a", "b"])
    assert linear.fit_logistic_newton(more, ["a", "b"]).coefficients == pytest.approx(plain.coefficients)
    twice = linear.fit_logistic_newton(df.withColumn("d", F.col("a") * 2 + 1), ["a", "d", "b"])
    assert twice.aliased == [1] and twice.coefficients[[0, 2]] == pytest.approx(plain.coefficients)
    apart = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "a double, label int")
    fit = linear.fit_logistic_newton(apart, ["a"])
    scored = fit.transform(apart).collect()
    assert all(r.prediction == r.label for r in scored)
    ones = linear.fit_logistic_newton(apart.withColumn("label", F.lit(1)), ["a"])
    assert all(r.prediction == 1.0 for r in ones.transform(apart).collect())
    with pytest.raises(ValueError):
        linear.fit_logistic_newton(apart.where("a < 0"), ["a"])


def test_factor_keeps_digits_that_cross_products_lose(spark):
    """Nearly collinear columns of very different size: QR solves what X'X cannot."""
    rng = np.random.default_rng(4)
    a = rng.normal(size=300)
    b = 1e4 * (a + 1e-5 * rng.normal(size=300))
    y = 2 * a - 3e-4 * b + 5
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, y)], "a double, b double, y double").repartition(7)
    beta = {r.term: r.beta for r in M.ols(df, ["a", "b"], "y").collect()}
    assert beta["const"] == pytest.approx(5, rel=1e-9) and beta["a"] == pytest.approx(2, rel=1e-5)
    r = linear.triangular_factor(df, ["a", "b", "y"])
    m = np.column_stack([np.ones(300), a, b, y])
    assert np.allclose(r.T @ r, m.T @ m) and np.allclose(r, np.triu(r))
    assert not linear.triangular_factor(df.where("a > 100"), ["a", "b"]).any()


def test_imputed_matrices_from_one_scan(spark):
    rng = np.random.default_rng(5)
    x = [[None if rng.random() < 0.2 else float(rng.normal(10, 3)) for _ in range(2)] + [float(rng.normal())]
         for _ in range(200)]
    df = spark.createDataFrame([(*r, float(i)) for i, r in enumerate(x)], "p double, q double, r double, y double").repartition(4)
    design = linear.Imputed(["p", "q", "r"], "y", ["p", "q"], {"q": (2020.0, -1.0)})
    filled = A.impute_mean(df, ["p", "q"]).withColumn("q", 2020 - F.col("q"))
    want = {(r.i, r.j): r.value for r in A.gram(filled, ["p", "q", "r"], "y").collect()}
    got = linear.imputed_gram(df, design).collect()
    assert {(r.i, r.j) for r in got} == set(want) and all(r.value == pytest.approx(want[r.i, r.j]) for r in got)
    beta = linear.solve_aliased(linear.imputed_factor(df, design), 4)
    assert beta == pytest.approx([r.beta for r in M.ols(filled, ["p", "q", "r"], "y").collect()])
    # One read of the input, where imputing first takes two.
    scanned, cols = design.scanned(df)
    assert cols == ["p", "q", "r", "p__missing", "q__missing", "y"]
    gone = linear.imputed_gram(df.withColumn("p", F.lit(None).cast("double")), design)
    assert all(r.value == 0.0 for r in gone.collect())
