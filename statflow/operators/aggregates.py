"""Aggregations.

All are single ``groupBy``/``agg`` plans, so Spark runs a partial aggregate in
every map task before the shuffle: a hot key costs one partial row per task,
not one row per record.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions.scalars import _literal_regex


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    """A1: one row with the row count."""
    return df.agg(F.count(F.lit(1)).alias(out))


def count_by(df: DataFrame, key: str, out: str = "cnt") -> DataFrame:
    """A2: rows per key, ordered by key (O2)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(key)


def mean_by(df: DataFrame, key: str, value: str, out: str = "mean",
            count_out: str | None = "n") -> DataFrame:
    """A3: mean of ``value`` per key (sum and count per key, divided at the end)."""
    aggs = [F.avg(value).alias(out)]
    if count_out:
        aggs.insert(0, F.count(value).alias(count_out))
    return df.groupBy(key).agg(*aggs)


def record_profile(df: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """A4: line count and min/max fields per line; empty input gives 0, 0, 0."""
    n_fields = F.size(F.split(F.col(col), _literal_regex(sep), -1))
    return df.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.min(n_fields), F.lit(0)).alias("min_fields"),
        F.coalesce(F.max(n_fields), F.lit(0)).alias("max_fields"),
    )


def median_size(df: DataFrame, col: str, out: str = "median_size") -> DataFrame:
    """Exact median of array lengths, linear interpolation.

    ``percentile`` keeps a value->count map per partial aggregate, so memory is
    bounded by the number of distinct lengths, not rows.
    """
    return df.agg(F.percentile(F.size(F.col(col)), F.lit(0.5)).alias(out))


def _term(col: str, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return F.col(col).cast("double")
    return F.col(col).cast(f"decimal(18,{exact_scale})")


def gram(df: DataFrame, xs: Sequence[str], y: str | None = None, intercept: bool = True,
         exact_scale: int | None = None) -> DataFrame:
    """Cross-product matrix of ``[1, xs..., y]`` as long rows.

    Returns ``(i, j, term_i, term_j, value)`` for i <= j; rows with ``term_j = y``
    are X'y and the last one is y'y. Only rows complete in ``xs`` and ``y`` count,
    so all sums are over the same rows.

    By default each Arrow batch gives its own X'X (a matrix product), one row an
    entry, and these partial sums are added up: the cost grows with rows, not with
    the number of separate sums. ``exact_scale`` instead accumulates in
    DECIMAL(18, scale) in one aggregate of p(p+1)/2 sums (inputs with that many
    decimals are summed exactly, so the result does not depend on row order).
    """
    used = [*xs] + ([y] if y is not None else [])
    if exact_scale is None:
        return _gram_batches(df, used, intercept)
    terms: list[tuple[str, Column]] = []
    if intercept:
        terms.append(("const", F.lit(1).cast(f"decimal(18,{exact_scale})")))
    terms += [(c, _term(c, exact_scale)) for c in used]
    df = df.dropna(how="any", subset=used) if used else df
    aggs, index = [], []
    for i, (ni, ci) in enumerate(terms):
        for j in range(i, len(terms)):
            nj, cj = terms[j]
            aggs.append(F.sum(ci * cj).cast("double").alias(f"g_{i}_{j}"))
            index.append((i, j, ni, nj))
    wide = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(ni).alias("term_i"),
                 F.lit(nj).alias("term_j"), F.col(f"g_{i}_{j}").alias("value"))
        for (i, j, ni, nj) in index])
    return wide.select(F.inline(entries))


def _gram_batches(df: DataFrame, cols: Sequence[str], intercept: bool) -> DataFrame:
    names = (["const"] if intercept else []) + list(cols)
    # Incomplete rows go inside the tasks: a filter on computed columns would be pushed
    # below them and compute every column twice.
    doubles = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(cols)])
    if not cols:
        doubles = df.select(F.lit(1.0).alias("x0"))
    width, p = len(cols), len(names)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((p, p))
        for batch in batches:
            x = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(max(width, 1))], 1)
            x = x[~np.isnan(x).any(1)]
            if not cols:
                x = x[:, :0]
            if intercept:
                x = np.concatenate([np.ones((len(x), 1)), x], 1)
            total += x.T @ x
        i, j = np.triu_indices(p)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()),
                                          "j": pa.array(j, pa.int32()), "value": total[i, j]})

    sums = (doubles.mapInArrow(run, "i int, j int, value double")
            .groupBy("i", "j").agg(F.sum("value").alias("value")))
    name = F.array(*[F.lit(n) for n in names])
    return sums.select("i", "j", F.get(name, F.col("i")).alias("term_i"),
                       F.get(name, F.col("j")).alias("term_j"), "value")


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by the column's global mean (one aggregate pass, its one row
    broadcast: no job runs while the frame is built). A column without any value stays null.

    The means are joined, not a scalar subquery: a subquery whose fields are used one by
    one runs once a field."""
    cols = list(cols)
    if not cols:
        return df
    means = df.agg(F.struct(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(cols)]).alias("__means"))
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col("__means")[f"m{k}"]) for k, c in enumerate(cols)}
    return df.crossJoin(F.broadcast(means)).withColumns(filled).drop("__means")


def impute_const(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in mapping.items()})
