"""User code over keyed data (U1) and key-ordered output (O3).

The keyed job is the Spark form of a streaming map/reduce: the mapper is a pandas function
run on Arrow batches (``mapInPandas``); the rows are dealt by key; the reduce is one of

- aggregate Columns: Spark's partial and final aggregation;
- a combiner, a pandas function that merges rows of many keys into one row a key: it runs
  in the map tasks first, so at most a few partial rows a key and task are shuffled;
- a sorted reducer, free user code: it sees every row of its keys in the order asked for,
  batch by batch, and carries its own state over batches and key edges. No group is ever
  held in memory. All rows of one key pass through one task, as in any ordered reduce:
  use one of the others where the result does not depend on the order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Mapper = Callable[[pd.DataFrame], pd.DataFrame]
Reducer = Callable[[pd.DataFrame], pd.DataFrame]

#: A map task's partial rows are passed on and begun anew beyond so many of them.
PARTIAL_ROWS = 200_000


class SortedReducer(Protocol):
    """User code over rows that arrive grouped by key and sorted within it; one object a task."""

    def batch(self, rows: pd.DataFrame, starts) -> pd.DataFrame | None:
        """Rows in order. ``starts``: the positions where another key begins; rows before
        the first of them belong to the last key of the batch before."""

    def end(self) -> pd.DataFrame | None:
        """Called after a task's last batch, if it had any."""


def each_key(make: Callable[[tuple], object], keys: Sequence[str]) -> Callable[[], SortedReducer]:
    """A sorted reducer from one object a key: ``make(key)`` gives an object whose
    ``add(rows)`` is called once or more with the key's rows in order and whose
    ``finish()`` comes last; both return rows or None. Keys are handled one by one: with
    many small keys, a reducer of whole batches is faster."""
    keys = list(keys)

    class EachKey:
        current = None

        def batch(self, rows, starts):
            out, begin = [], 0
            for end in [*starts, len(rows)]:
                if end > begin:
                    out.append(self.current.add(rows.iloc[begin:end]))
                if end < len(rows):
                    out.append(self.end())
                    self.current = make(tuple(rows[k].iloc[end] for k in keys))
                begin = end
            out = [o for o in out if o is not None and len(o)]
            return pd.concat(out, ignore_index=True) if out else None

        def end(self):
            return self.current.finish() if self.current is not None else None

    return EachKey


def map_batches(df: DataFrame, mapper: Mapper, schema: T.StructType | str) -> DataFrame:
    """Apply a vectorised pandas ``mapper`` to every Arrow batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield mapper(pdf)
    return df.mapInPandas(run, schema)


def _combined(df: DataFrame, reducer: Reducer, schema, limit: int) -> DataFrame:
    """One partial row a key and task (more only beyond ``limit`` keys)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, rows, merged = [], 0, 0
        for pdf in batches:
            if not len(pdf):
                continue
            parts.append(reducer(pdf))
            rows += len(parts[-1])
            # Merged whenever the pending rows have doubled: the work stays linear.
            if rows > max(2 * merged, 20_000):
                parts = [reducer(pd.concat(parts, ignore_index=True))]
                rows = merged = len(parts[0])
                if merged > limit:
                    yield parts[0]
                    parts, rows, merged = [], 0, 0
        if parts:
            yield reducer(pd.concat(parts, ignore_index=True)) if len(parts) > 1 else parts[0]
    return df.mapInPandas(run, schema)


def _merged_runs(df: DataFrame, keys: Sequence[str], reducer: Reducer, schema) -> DataFrame:
    """Partials sorted by key, merged a batch at a time; the last key of a batch waits for
    the next one."""
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = pd.Series(True, index=rows.index)
            for k in keys:
                v = rows[k].iloc[-1]
                last &= rows[k].isna() if pd.isna(v) else rows[k] == v
            held = reducer(rows[last])
            if not last.all():
                yield reducer(rows[~last])
        if held is not None:
            yield held
    return df.mapInPandas(run, schema)


def _streamed(df: DataFrame, keys: Sequence[str], make: Callable[[], SortedReducer], schema) -> DataFrame:
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        reducer, before = None, None
        for pdf in batches:
            if not len(pdf):
                continue
            reducer = make() if reducer is None else reducer
            new = np.zeros(len(pdf), bool)
            for k in keys:
                v = pdf[k].reset_index(drop=True)
                prev = v.shift(1)
                same = (v == prev) | (v.isna() & prev.isna())
                new |= ~same.to_numpy(bool, na_value=False)
            first = tuple(pdf[k].iloc[0] for k in keys)
            new[0] = before is None or any(
                pd.isna(a) != pd.isna(b) or not (pd.isna(a) or a == b) for a, b in zip(first, before))
            out = reducer.batch(pdf, np.flatnonzero(new))
            if out is not None and len(out):
                yield out
            before = tuple(pdf[k].iloc[-1] for k in keys)
        out = reducer.end() if reducer is not None else None
        if out is not None and len(out):
            yield out
    return df.mapInPandas(run, schema)


def keyed_job(df: DataFrame, key: str | Sequence[str], mapper: Mapper | None = None,
              map_schema: T.StructType | str | None = None,
              aggs: Sequence[Column] | None = None,
              reducer: Reducer | None = None, reduce_schema: T.StructType | str | None = None,
              salts: int | None = None, n_out: int | None = None,
              stream: Callable[[], SortedReducer] | None = None,
              order: Sequence[str | Column] = (),
              partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """Mapper -> shuffle on ``key`` -> reduce, by exactly one of:

    ``aggs``: aggregate Columns (``[F.sum('v'), F.count('*')]``).

    ``reducer``: a combiner. It takes rows of one or more keys and returns one partial row
    a key, with the key columns; a partial of partials is a valid partial (associative and
    commutative). Map tasks combine what they read; the partials are dealt by key, sorted,
    and merged batch by batch. A hot key costs about one partial row a map task; ``salts``
    adds a level that merges these by (key, salt) first.

    ``stream``: makes a ``SortedReducer`` for each task (see ``each_key`` for one object a
    key). Rows are dealt by ``partition_by`` (default: all of ``key``; its first columns put
    related keys into one task), sorted by ``key`` and then by ``order``, and handed over in
    that order; nothing is held back. Null keys form a group.

    ``n_out`` fixes the number of output partitions (the reduce-task count).
    """
    keys = [key] if isinstance(key, str) else list(key)
    data = df if mapper is None else map_batches(df, mapper, map_schema)
    if [aggs, reducer, stream].count(None) != 2:
        raise ValueError("give exactly one of aggs, reducer and stream")
    if aggs is not None:
        out = data.groupBy(*keys).agg(*aggs)
        return out.repartition(n_out, *keys) if n_out else out
    size = [n_out] if n_out else []
    if stream is not None:
        dealt_by = keys if partition_by is None else \
            [partition_by] if isinstance(partition_by, str) else list(partition_by)
        if dealt_by != keys[:len(dealt_by)]:
            raise ValueError("partition_by must be the first columns of key")
        dealt = data.repartition(*size, *dealt_by).sortWithinPartitions(*keys, *order)
        return _streamed(dealt, keys, stream, reduce_schema)
    partial = _combined(data, reducer, reduce_schema, PARTIAL_ROWS)
    if salts:
        # Position-based salt: the same on retry, spreads a hot key's partials.
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("__salt")
        dealt = partial.select("*", salt).repartition(*keys, "__salt")
        partial = _combined(dealt.drop("__salt"), reducer, reduce_schema, PARTIAL_ROWS)
    dealt = partial.repartition(*size, *keys).sortWithinPartitions(*keys)
    return _merged_runs(dealt, keys, reducer, reduce_schema)


def cluster_by(df: DataFrame, key: str | Sequence[str], n: int | None = None,
               tiebreak: Sequence[str] | None = None) -> DataFrame:
    """O3: rows come out sorted by ``key`` across partitions in order.

    Range partitioning on ``key`` plus a tie-break (default: every other
    column) and at last the row's own position lets a hot key span several
    partitions instead of one task, even if its rows are identical.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ties = list(tiebreak) if tiebreak is not None else [c for c in df.columns if c not in keys]
    order = [*keys, *ties, "__row"]
    args = ([n] if n else []) + order
    return (df.withColumn("__row", F.monotonically_increasing_id())
            .repartitionByRange(*args).sortWithinPartitions(*order).drop("__row"))
