"""Least squares and logistic regression from small matrices that tasks compute.

Every task turns its rows into one small matrix; these are merged in a tree of groups of
``FAN_IN``, so the driver gets at most a few hundred of them however many tasks there were.

- Least squares: the triangular factor R of the rows (tall-skinny QR: the R of stacked Rs is
  the R of all rows). Unlike X'X it keeps the digits of badly scaled columns.
- Missing numbers: R over values (missing as 0) and missing-masks side by side holds the
  means as well, so mean imputation follows from the one scan: each imputed column is
  value + mean * mask, a linear map of what was scanned.
- Logistic regression: Newton steps from the weighted cross-products of each step.

Terms are taken in their order; one that the terms before it determine (what they leave of
it is at most ``tol`` of its length) is aliased: it has no coefficient (null), and the
others are those of the regression without it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
DRIVER_MATRICES = 256
TOL = 1e-7
_PART = "part long, data binary"


def _task_matrices(df: DataFrame, step: Callable) -> DataFrame:
    """One row a task: ``step(state, batch)`` over the Arrow batches, the state as bytes."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        state = None
        for b in batches:
            if b.num_rows:
                state = step(state, b)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()],
                                              "data": [np.ascontiguousarray(state, np.float64).tobytes()]})
    return df.mapInArrow(run, _PART)


def _merge_tree(parts: DataFrame, merge: Callable[[list], np.ndarray], width: int, tasks: int | None = None):
    """Merge the tasks' matrices (rows of ``width`` numbers) in groups, until the driver gets
    ``DRIVER_MATRICES`` at most (``tasks``: how many there are, if that is known); None
    without rows."""
    levels = 2
    if tasks is not None:
        levels = 0
        while tasks > DRIVER_MATRICES:
            tasks, levels = -(-tasks // FAN_IN), levels + 1

    def matrix(raw):
        return np.frombuffer(raw, np.float64).reshape(-1, width)

    def run(key, table):
        import pyarrow as pa
        out = merge([matrix(x) for x in table.column("data").to_pylist()])
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()),
                         "data": [np.ascontiguousarray(out, np.float64).tobytes()]})

    for _ in range(levels):
        grouped = parts.select(F.floor(F.col("part") / FAN_IN).alias("group"), "data")
        parts = grouped.groupBy("group").applyInArrow(run, _PART)
    rows = parts.collect()
    # The same order whatever task came first, so that sums repeat to the last digit.
    return merge([matrix(r["data"]) for r in sorted(rows, key=lambda r: r["part"])]) if rows else None


def triangular_factor(df: DataFrame, cols: Sequence[str], intercept: bool = True) -> np.ndarray:
    """R of the matrix ``[1, cols...]`` over the rows complete in ``cols``: square, upper
    triangular; zero without rows."""
    q = len(cols) + bool(intercept)
    # Incomplete rows go inside the tasks: a filter on computed columns would be pushed
    # below them and compute every column twice.
    doubles = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(cols)])
    if not cols:
        doubles = df.select(F.lit(1.0).alias("x0"))

    def step(r, b):
        x = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(b.num_columns)], 1)
        x = x[~np.isnan(x).any(1)]
        if intercept:
            x = np.concatenate([np.ones((len(x), 1)), x[:, :len(cols)]], 1)
        return np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")

    r = _merge_tree(_task_matrices(doubles, step), lambda m: np.linalg.qr(np.vstack(m), mode="r"), q)
    out = np.zeros((q, q))
    if r is not None:
        out[:len(r)] = r
    return out


def solve_aliased(r: np.ndarray, p: int, tol: float = TOL) -> list[float | None]:
    """Coefficients of the first ``p`` columns of ``r`` for its last one, terms in order, None
    for an aliased term. ``r``: any matrix with the same cross-products as the data."""
    a, y = r[:, :p], r[:, -1]
    basis: list[np.ndarray] = []
    kept: list[int] = []
    for j in range(p):
        size = np.linalg.norm(a[:, j])
        w = a[:, j].copy()
        for _ in range(2):  # twice, against rounding
            for q in basis:
                w -= q * (q @ w)
        left = np.linalg.norm(w)
        if size > 0 and left > tol * size:
            basis.append(w / left)
            kept.append(j)
    out: list[float | None] = [None] * p
    if kept:
        q = np.stack(basis, 1)
        beta = np.linalg.solve(np.triu(q.T @ a[:, kept]), q.T @ y)
        for j, b in zip(kept, beta):
            out[j] = float(b)
    return out


def factor_of_gram(g: np.ndarray, tol: float = 1e-10) -> np.ndarray:
    """A triangular factor of a cross-product matrix; directions below ``tol`` of a column's
    own square are rounding and are left out."""
    n = len(g)
    left, r = g.astype(float).copy(), np.zeros((n, n))
    for j in range(n):
        if left[j, j] > tol * g[j, j] and left[j, j] > 0:
            r[j] = left[j] / np.sqrt(left[j, j])
            r[j, :j] = 0.0
            left -= np.outer(r[j], r[j])
    return r


# ---------------------------------------------------------------- missing numbers, one scan


@dataclass(frozen=True)
class Imputed:
    """A design whose columns ``imputed`` are filled by their means and then mapped by
    ``a + b * x`` where ``affine`` names them. Columns that are not imputed must be complete."""

    xs: Sequence[str]
    y: str
    imputed: Sequence[str]
    affine: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    def scanned(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """Values with 0 for missing ones, and a mask for each imputed column."""
        plain = [F.col(c).cast("double").alias(c) for c in [*self.xs, self.y] if c not in self.imputed]
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.imputed]
        masks = [F.col(c).isNull().cast("double").alias(f"{c}__missing") for c in self.imputed]
        cols = [*self.xs, *[f"{c}__missing" for c in self.imputed], self.y]
        return df.select(*plain, *filled, *masks), cols

    def mapping(self, sums: Mapping[str, float], n: float) -> np.ndarray | None:
        """The linear map from ``[1, scanned...]`` to ``[1, xs..., y]``; None if a column has
        no value at all (there is then no complete row)."""
        cols = ["const", *self.xs, *[f"{c}__missing" for c in self.imputed], self.y]
        at = {c: k for k, c in enumerate(cols)}
        out = np.zeros((len(cols), len(self.xs) + 2))
        out[0, 0] = out[at[self.y], -1] = 1.0
        for k, c in enumerate(self.xs, 1):
            a, b = self.affine.get(c, (0.0, 1.0))
            out[0, k], out[at[c], k] = a, b
            if c in self.imputed:
                known = n - sums[f"{c}__missing"]
                if known <= 0:
                    return None
                out[at[f"{c}__missing"], k] = b * sums[c] / known
        return out


def imputed_factor(df: DataFrame, design: Imputed) -> np.ndarray:
    """R of ``[1, xs..., y]`` with missing numbers filled by their means: one scan."""
    rows, cols = design.scanned(df)
    r = triangular_factor(rows, cols)
    g0 = r[0] * r[0, 0]  # the first row of R'R: row count and column sums
    sums = dict(zip(["const", *cols], g0))
    t = design.mapping(sums, sums["const"]) if sums["const"] > 0 else None
    p = len(design.xs) + 2
    return np.zeros((p, p)) if t is None else np.linalg.qr(r @ t, mode="r")


def imputed_gram(df: DataFrame, design: Imputed) -> DataFrame:
    """A9 + A13 from one scan: the rows of ``gram`` (``i, j, term_i, term_j, value``) over
    the imputed columns."""
    from statflow.operators.aggregates import gram
    rows, cols = design.scanned(df)
    z = np.zeros((len(cols) + 1, len(cols) + 1))
    for e in gram(rows, cols[:-1], cols[-1]).collect():
        z[e["i"], e["j"]] = z[e["j"], e["i"]] = e["value"]
    names = ["const", *design.xs, design.y]
    t = design.mapping(dict(zip(["const", *cols], z[0])), z[0, 0]) if z[0, 0] > 0 else None
    g = np.zeros((len(names), len(names))) if t is None else t.T @ z @ t
    out = [(i, j, names[i], names[j], float(g[i, j])) for i in range(len(names)) for j in range(i, len(names))]
    return df.sparkSession.createDataFrame(out, "i int, j int, term_i string, term_j string, value double")


# ---------------------------------------------------------------- logistic regression


@dataclass
class LogisticFit:
    """``coefficients`` (0 where ``aliased``) of the feature slots, and ``intercept``.
    ``score``: the largest |sum of x (y - p)| relative to the sum of |x|, at the end;
    ``converged``: whether it is below the tolerance (separable data never converge)."""

    intercept: float
    coefficients: np.ndarray
    aliased: list[int]
    iterations: int
    converged: bool
    score: float
    log_likelihood: float
    features: str | Sequence[str]
    threshold: float = 0.5

    def probability(self):
        """P(label = 1) of a row, as a Column."""
        beta = [float(b) for b in self.coefficients]
        if isinstance(self.features, str):
            x = vector_to_array(self.features)
            eta = F.aggregate(F.zip_with(x, F.array(*[F.lit(b) for b in beta]), lambda a, b: a * b),
                              F.lit(self.intercept), lambda acc, v: acc + v)
        else:
            eta = F.lit(self.intercept)
            for c, b in zip(self.features, beta):
                eta = eta + F.col(c).cast("double") * F.lit(b)
        return 1.0 / (1.0 + F.exp(-eta))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (of 0 and of 1, as an array) and ``prediction``."""
        p = df.withColumn("__p", self.probability())
        return p.withColumns({"probability": F.array(1.0 - F.col("__p"), F.col("__p")),
                              "prediction": (F.col("__p") > self.threshold).cast("double")}).drop("__p")


def fit_logistic_newton(df: DataFrame, features: str | Sequence[str], label: str = "label", max_iter: int = 50,
                        tol: float = 1e-10, threshold: float = 0.5) -> LogisticFit:
    """M8 by Newton's method: no penalty, with an intercept.

    ``features``: a vector column or numeric columns; rows with a null among them or in
    the label do not count. Each step adds up X'WX, X'(y - p) and the log likelihood in the
    tasks; a step that lowers the likelihood is halved. The fit ends when the score of
    every feature (its sum of x (y - p), over the sum of |x|) is below ``tol``, or when the
    likelihood no longer rises. The rows are persisted for the steps.
    """
    vector = isinstance(features, str)
    x = [vector_to_array(features).alias("x")] if vector else [
        F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)]
    rows = df.select(F.col(label).cast("double").alias("y"), *x).dropna(how="any").persist(StorageLevel.MEMORY_AND_DISK)

    def matrix(b):
        y = b.column(0).to_numpy()
        if vector:
            flat = b.column(1).flatten().to_numpy()
            m = flat.reshape(len(y), -1)
        else:
            m = np.stack([b.column(k).to_numpy() for k in range(1, b.num_columns)], 1)
        return y, np.concatenate([np.ones((len(y), 1)), m], 1)

    def sums(beta):
        """``[[X'WX, X'(y-p)], [sum |x|, log likelihood]]``."""
        def step(state, b):
            y, m = matrix(b)
            eta = m @ beta if len(beta) else np.zeros(len(y))
            p = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            top = np.concatenate([m.T @ (m * (p * (1 - p))[:, None]), (m.T @ (y - p))[:, None]], 1)
            ll = -(np.logaddexp(0, -eta) * y + np.logaddexp(0, eta) * (1 - y)).sum()
            out = np.vstack([top, np.append(np.abs(m).sum(0), ll)])
            return out if state is None else state + out
        return _merge_tree(_task_matrices(rows, step), lambda ms: np.sum(ms, 0), width, tasks)

    try:
        first = rows.limit(1).collect()
        if not first:
            raise ValueError("no complete rows to fit")
        n_features = len(first[0]["x"]) if vector else len(features)
        width, tasks = n_features + 2, rows.rdd.getNumPartitions()
        beta = np.zeros(n_features + 1)
        now, steps, aliased = sums(beta), 0, []
        while True:
            h, g, size, ll = now[:-1, :-1], now[:-1, -1], now[-1, :-1], now[-1, -1]
            score = float(np.max(np.abs(g) / np.where(size > 0, size, 1.0)))
            if score <= tol or steps == max_iter:
                break
            move = solve_aliased(_newton_factor(h, g), len(beta), 1e-5)
            aliased = [k for k, v in enumerate(move) if v is None]
            move = np.array([0.0 if v is None else v for v in move])
            better = None
            for _ in range(30):
                trial = sums(beta + move)
                if trial[-1, -1] >= ll - 1e-12 * abs(ll):
                    better = trial
                    break
                move /= 2
            if better is None:
                break
            done = better[-1, -1] - ll <= 1e-14 * abs(ll) and steps > 3
            beta, now, steps = beta + move, better, steps + 1
            if done:
                g, size, ll = now[:-1, -1], now[-1, :-1], now[-1, -1]
                score = float(np.max(np.abs(g) / np.where(size > 0, size, 1.0)))
                break
    finally:
        rows.unpersist(blocking=False)
    return LogisticFit(float(beta[0]), beta[1:], [k - 1 for k in aliased], steps, score <= max(tol, 1e-9), score,
                       float(ll), features, threshold)


def _newton_factor(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """A matrix whose cross-products are those of the step's weighted least squares: the
    solution of ``h b = g``, terms in order."""
    r = factor_of_gram(h)
    # R'z = g, skipping the directions that the factor leaves out.
    z = np.zeros(len(g))
    left = g.astype(float).copy()
    for j in range(len(g)):
        if r[j, j] > 0:
            z[j] = left[j] / r[j, j]
            left -= r[j] * z[j]
    return np.column_stack([r, z])
