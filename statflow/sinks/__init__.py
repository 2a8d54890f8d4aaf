"""Writers and output formatting (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CASTS = {"%f": "double", "%d": "long", "%s": "string"}


def format_line(df: DataFrame, spec: Sequence[tuple[str, str]], sep: str = "\t",
                out: str = "line") -> DataFrame:
    """K2: one text line per row from ``(column, '%f'|'%d'|'%s')`` pairs.

    A null field prints as an empty string so positions stay aligned.
    """
    parts: list[Column] = []
    for name, fmt in spec:
        if fmt not in _CASTS:
            raise ValueError(f"unsupported format {fmt!r}")
        c = F.col(name).cast(_CASTS[fmt])
        text = c if fmt == "%s" else F.format_string(fmt, c)
        parts.append(F.coalesce(text, F.lit("")))
    return df.select(F.concat_ws(sep, *parts).alias(out))


def write_lines(df: DataFrame, path: str, col: str | None = None) -> None:
    """K1: replace ``path`` with the text lines of ``col``; Spark leaves ``_SUCCESS``."""
    col = col or df.columns[0]
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """K1: replace ``path`` with tab-separated rows (all columns, no header)."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    write_lines(df.select(F.concat_ws("\t", *cols).alias("line")), path, "line")


def head(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in an explicit order (a distributed top-k)."""
    if not order_by:
        raise ValueError("head needs an order; row order is otherwise undefined")
    return df.orderBy(*order_by).limit(n)
