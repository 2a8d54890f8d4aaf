"""Row operators (R1-R7): projections, null drops, casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.scalars import _literal_regex


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Named columns; an unknown name raises (no case folding guesses)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.select(*cols)


def project_positions(df: DataFrame, positions: Sequence[int], col: str = "value",
                      sep_in: str = ",", sep_out: str = "\t", out: str = "line") -> DataFrame:
    """R2: keep fields by 0-based position and re-delimit (``awk -F, '{print $1"\\t"$2}'``).

    A missing field prints empty, as awk does.
    """
    parts = F.split(F.col(col), _literal_regex(sep_in), -1)
    picked = [F.coalesce(F.get(parts, p), F.lit("")) for p in positions]
    return df.select(F.concat_ws(sep_out, *picked).alias(out))


def drop_null_any(df: DataFrame) -> DataFrame:
    """Drop a row if any column is null."""
    return df.na.drop(how="any")


def drop_null_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop a row if any of ``cols`` is null."""
    return df.na.drop(how="any", subset=list(cols))


def to_number(df: DataFrame, col: str, dtype: str, strict: bool = False) -> DataFrame:
    """Replace ``col`` with its cast; text that does not parse -> null
    unless ``strict`` (then the job fails, as a plain ANSI cast does)."""
    c = F.col(col).cast(dtype) if strict else F.col(col).try_cast(dtype)
    return df.withColumn(col, c)
