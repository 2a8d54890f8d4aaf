"""Running totals and ranks over a global order, without a one-task window.

``sum(x) OVER (ORDER BY ...)`` with no PARTITION BY moves every row into a
single task. Here the rows are range-partitioned on the order keys instead,
each partition computes its own running sum, and a table with one row per
partition and group supplies the offset of everything before it. Without groups
that table is bounded by the partition count and is broadcast; with groups it
may be as large as the data, and the planner picks the join. The partitioned
intermediate is a table in the checkpoint folder, so partition ids stay fixed if a task
is retried.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.session import discard, stored

_PID = "__sf_pid"
_VAL = "__sf_val"
_LOCAL = "__sf_local"
_OFF = "__sf_off"
_TOT = "__sf_tot"


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def running_totals(df: DataFrame, values: Mapping[str, str | Column], order: Sequence[str | Column],
                   partition_by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Add a running sum (ROWS UNBOUNDED PRECEDING .. CURRENT ROW) for each entry of
    ``values`` (new column -> what is summed).

    ``order`` must be a total order within each ``partition_by`` group (add a
    tie-break column), otherwise the result is not deterministic - the same
    rule holds for the SQL window it replaces.
    """
    order_cols = _as_cols(order)
    part_cols = [F.col(c) for c in partition_by]
    outs, vals = list(values), _as_cols(list(values.values()))
    n = range(len(outs))

    # Read twice: the range bounds come from a sample, then the rows are dealt out.
    staged = stored(df.withColumns({f"{_VAL}{k}": vals[k] for k in n}))
    args = ([num_partitions] if num_partitions else []) + part_cols + order_cols
    ranged = staged.repartitionByRange(*args).withColumn(_PID, F.spark_partition_id())
    w_local = (Window.partitionBy(F.col(_PID), *part_cols).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({f"{_LOCAL}{k}": F.sum(f"{_VAL}{k}").over(w_local) for k in n})
    # Pin partition ids: the range bounds come from a sample, so a recomputed
    # lineage could place rows differently between the two uses below.
    local = stored(local)
    discard(staged)

    # One row per (partition, group): bounded by partitions x groups.
    totals = local.groupBy(_PID, *partition_by).agg(*[F.sum(f"{_VAL}{k}").alias(f"{_TOT}{k}") for k in n])
    w_off = (Window.partitionBy(*part_cols).orderBy(_PID)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(_PID, *partition_by, *[
        F.coalesce(F.sum(f"{_TOT}{k}").over(w_off), F.lit(0)).alias(f"{_OFF}{k}") for k in n])
    # Null group values are groups too: the join must match them.
    names = {c: f"__sf_g{i}" for i, c in enumerate([_PID, *partition_by])}
    offsets = offsets.withColumnsRenamed(names)
    same = F.lit(True)
    for c, g in names.items():
        same = same & (local[c] == offsets[g] if c == _PID else
                       local[c].eqNullSafe(offsets[g]))
    joined = local.join(offsets if partition_by else F.broadcast(offsets), same)
    spare = [f"{x}{k}" for x in (_LOCAL, _OFF, _VAL) for k in n]
    return joined.withColumns({out: F.col(f"{_LOCAL}{k}") + F.col(f"{_OFF}{k}") for k, out in enumerate(outs)}
                              ).drop(_PID, *spare, *names.values())


def running_total(df: DataFrame, value: str | Column, order: Sequence[str | Column],
                  out: str, partition_by: Sequence[str] = (),
                  num_partitions: int | None = None) -> DataFrame:
    """``running_totals`` of one value."""
    return running_totals(df, {out: value}, order, partition_by, num_partitions)


def global_rank(df: DataFrame, order: Sequence[str | Column], out: str,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """1-based position in a total order (``row_number()``), computed distributed."""
    return running_total(df, F.lit(1).cast("long"), order, out, partition_by)
