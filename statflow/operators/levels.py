"""Category levels: frequency tables, frequent-level cutoffs, folding (A5-A7, T1-T3,
F8, F9, M3).

Level tables stay DataFrames. The only lists that reach the driver are kept
levels, and a level with share > p is among the first ceil(1/p) by count, so
those lists are bounded by 1/p whatever the data size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.functions.constants import OTHER_LEVEL
from statflow.operators.ordering import running_total

def _level_order():
    return (F.desc("cnt"), F.asc("level"))


def _counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("cnt"))


def freq_table(df: DataFrame, col: str) -> DataFrame:
    """``level, cnt, cum, share, cum_share``, count descending, ties by level.

    The running sum is computed per range partition plus offsets, so a column
    with millions of levels is not funnelled through one task.
    """
    ranked = running_total(_counts(df, col), "cnt", _level_order(), "cum")
    n = ranked.agg(F.sum("cnt")).scalar()
    return ranked.select(
        "level", "cnt", "cum",
        (F.col("cnt") / n).alias("share"),
        (F.col("cum") / n).alias("cum_share"),
    )


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts of every level of every column in one scan and one shuffle:
    ``(column, level STRING, cnt)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(c).cast("string").alias("level")) for c in cols])
    return (df.select(F.inline(pairs))
            .groupBy("column", "level").agg(F.count(F.lit(1)).alias("cnt")))


def level_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5 for many columns at once: ``column, level, cnt, cum, n, share, cum_share``."""
    counts = level_counts(df, cols)
    ranked = running_total(counts, "cnt", _level_order(), "cum", partition_by=["column"])
    # One row per column: bounded by the number of columns.
    totals = ranked.groupBy("column").agg(F.sum("cnt").alias("n"))
    return (ranked.join(F.broadcast(totals), "column")
            .withColumn("share", F.col("cnt") / F.col("n"))
            .withColumn("cum_share", F.col("cum") / F.col("n")))


def _kept_condition(p: float, cum_p: float, mode: str) -> Column:
    share_ok = F.col("cnt") / F.col("n") > F.lit(p)
    if mode == "strict":
        return (F.col("cum") / F.col("n") <= F.lit(cum_p)) & share_ok
    if mode == "inclusive":
        return ((F.col("cum") - F.col("cnt")) / F.col("n") < F.lit(cum_p)) & share_ok
    raise ValueError(f"mode must be 'strict' or 'inclusive', got {mode!r}")


#: Most counters that Spark's frequent-items summary takes.
_MOST_COUNTERS = 1_000_000


def heavy_counts(df: DataFrame, cols: Sequence[str], p: float) -> DataFrame:
    """``(column, level STRING, cnt, n)`` of all levels with share > p, and a few others, from
    two scans that shuffle no more than a bounded number of levels a task.

    First scan: a mergeable frequent-items summary a column (``approx_top_k``) with 32/p
    counters. It miscounts a level by at most 3.5 rows in as many as it has counters, an
    eighth of p, so each level with share > p is among the 2/p largest. Second scan: the
    exact counts of these candidates; all other levels are counted as one.
    """
    counters = math.ceil(32 / p)
    if counters > _MOST_COUNTERS:
        raise ValueError(f"p = {p} needs more than {_MOST_COUNTERS} counters; count all levels instead")
    top = df.agg(*[F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {math.ceil(2 / p)}, {counters})").alias(f"c{k}")
                   for k, c in enumerate(cols)]).first()
    pairs = []
    for k, c in enumerate(cols):
        found = [r["item"] for r in top[f"c{k}"] or []]
        text = F.col(c).cast("string")
        heavy = text.isin([v for v in found if v is not None])
        heavy = F.when(text.isNull(), F.lit(None in found)).otherwise(heavy)
        pairs.append(F.struct(F.lit(c).alias("column"), F.when(heavy, text).alias("level"), heavy.alias("heavy")))
    counts = (df.select(F.inline(F.array(*pairs))).groupBy("column", "level", "heavy")
              .agg(F.count(F.lit(1)).alias("cnt")))
    # At most 2/p + 1 rows a column.
    n = F.sum("cnt").over(Window.partitionBy("column"))
    return counts.withColumn("n", n).where("heavy").drop("heavy")


def frequent_levels(df: DataFrame, col: str, p: float = 0.03, cum_p: float = 0.8,
                    mode: str = "strict", sketch: bool = False) -> DataFrame:
    """Levels worth a dummy.

    ``strict``: cumulative share <= cum_p and share > p.
    ``inclusive``: every level up to and including the first whose cumulative
    share reaches cum_p, and share > p.

    Levels with share > p are a prefix of the count-descending order, so the
    share filter comes before the running sum without changing it.

    ``sketch`` is for columns with very many levels: the same rows by ``heavy_counts``, so
    that not every level is shuffled to keep 1/p of them.
    """
    if sketch:
        shared = heavy_counts(df, [col], p).drop("column").withColumn("level", F.col("level").cast(df.schema[col].dataType))
    else:
        counts = _counts(df, col)
        shared = counts.withColumn("n", counts.agg(F.sum("cnt")).scalar())
    shared = shared.where(F.col("cnt") / F.col("n") > F.lit(p))
    ranked = running_total(shared, "cnt", _level_order(), "cum")
    return (ranked.where(_kept_condition(p, cum_p, mode))
            .select("level", "cnt", "cum",
                    (F.col("cnt") / F.col("n")).alias("share"),
                    (F.col("cum") / F.col("n")).alias("cum_share")))


def frequent_level_table(df: DataFrame, cols: Sequence[str], p: float = 0.03,
                         cum_p: float = 0.8, mode: str = "strict", sketch: bool = False) -> DataFrame:
    """A6 for many columns in one scan: ``column, level`` of the kept levels (``sketch``: in
    two scans, see ``frequent_levels``)."""
    if sketch:
        shared = heavy_counts(df, cols, p)
    else:
        counts = level_counts(df, cols)
        totals = counts.groupBy("column").agg(F.sum("cnt").alias("n"))
        # One row per column: bounded by the number of columns.
        shared = counts.join(F.broadcast(totals), "column")
    shared = shared.where(F.col("cnt") / F.col("n") > F.lit(p))
    ranked = running_total(shared, "cnt", _level_order(), "cum", partition_by=["column"])
    return ranked.where(_kept_condition(p, cum_p, mode)).select("column", "level")


def kept_list(kept: DataFrame, col: str = "level") -> list:
    """Bring a bounded kept-level table to the driver (for ``fold_levels``)."""
    return [r[0] for r in kept.select(col).orderBy(col).collect()]


def levels(df: DataFrame, col: str) -> DataFrame:
    """Distinct levels."""
    return df.select(F.col(col).alias("level")).distinct()


def dropped_levels(all_levels: DataFrame, kept: DataFrame, col: str = "level") -> DataFrame:
    """All levels minus kept ones (left anti join; Spark picks broadcast by size)."""
    return all_levels.join(kept.select(col).distinct(), col, "left_anti")


def levels_in(freq: DataFrame, allowed: Sequence, col: str = "level") -> DataFrame:
    """The levels of a frequency table that fall in a fixed set, in frequency order."""
    return freq.where(F.col(col).isin(list(allowed))).orderBy(*_level_order())


def level_report(df: DataFrame, specs: Mapping[str, dict]) -> DataFrame:
    """Every level of every column with a ``kept`` flag.

    ``specs[col]`` is ``{"p":..., "cum_p":..., "mode":...}`` for a frequency
    cutoff or ``{"allowed": [...]}`` for a fixed set.
    """
    table = level_table(df, list(specs))
    flag = F.lit(False)
    for c, spec in specs.items():
        if "allowed" in spec:
            cond = F.col("level").isin([str(v) for v in spec["allowed"]])
        else:
            cond = _kept_condition(spec.get("p", 0.03), spec.get("cum_p", 0.8),
                                   spec.get("mode", "strict"))
        flag = F.when(F.col("column") == c, cond).otherwise(flag)
    return table.withColumn("kept", F.coalesce(flag, F.lit(False)))


def fold_levels_expr(col: str | Column, kept: Sequence, other: str = OTHER_LEVEL,
                     match: str = "exact") -> Column:
    """F8/F9 as a Column, result STRING.

    ``exact``: kept values stay, everything else becomes ``other`` (an empty
    keep list folds everything). ``prefix``: a value stays if it starts with a
    kept level (the old negative-lookahead rule): "30" survives when "3" is
    kept, an empty value stays empty, and an empty keep list changes nothing.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    kept = [str(k) for k in kept]
    if match == "exact":
        return F.when(c.isin(kept), c).otherwise(F.lit(other)) if kept else F.lit(other)
    if match == "prefix":
        if not kept:
            return c
        starts = None
        for k in kept:
            s = c.startswith(k)
            starts = s if starts is None else (starts | s)
        return F.when(c.isNull(), c).when((c == "") | starts, c).otherwise(F.lit(other))
    raise ValueError(f"match must be 'exact' or 'prefix', got {match!r}")


def fold_levels(df: DataFrame, col: str, kept: Sequence, other: str = OTHER_LEVEL,
                match: str = "exact") -> DataFrame:
    """Replace ``col`` in place by its folded text."""
    return df.withColumn(col, fold_levels_expr(col, kept, other, match))


def dummies(df: DataFrame, col: str, levels_: Sequence[str], prefix: str | None = None,
            baseline: str | None = None, drop_source: bool = True) -> DataFrame:
    """M3: one 0/1 INT column per named level, ``{prefix}_{level}``; the baseline
    level gets no column. A null or unlisted value is all zeros."""
    prefix = prefix or col
    new = {f"{prefix}_{lv}": F.coalesce((F.col(col) == F.lit(lv)).cast("int"), F.lit(0))
           for lv in levels_ if lv != baseline}
    out = df.withColumns(new)
    return out.drop(col) if drop_source else out
