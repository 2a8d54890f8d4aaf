"""Array column functions (Y1-Y4, Y6): tokens, stop words, n-grams.

All are SQL expressions, so they run inside the JVM next to the scan; no
Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.functions.constants import ENGLISH_STOP_WORDS, TOKEN_PATTERN


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col: str | Column, pattern: str = TOKEN_PATTERN, lower: bool = True) -> Column:
    """Every match of ``pattern`` after lower-casing (RegexTokenizer, gaps=False)."""
    text = F.lower(_c(col)) if lower else _c(col)
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def remove_stopwords(col: str | Column, words: Iterable[str] = ENGLISH_STOP_WORDS,
                     case_sensitive: bool = False) -> Column:
    """Y2: drop stop words, keeping order and duplicates.

    The word list becomes an ``InSet`` (hash lookup) rather than a linear scan.
    """
    words = list(words)
    if case_sensitive:
        return F.filter(_c(col), lambda x: ~x.isin(words))
    lowered = sorted({w.lower() for w in words})
    return F.filter(_c(col), lambda x: ~F.lower(x).isin(lowered))


def ngrams(col: str | Column, n: int = 2) -> Column:
    """Space-joined n-grams; an array shorter than ``n`` gives an empty array.

    Built from ``n`` shifted slices zipped together, so the input array is
    referenced a fixed number of times per row - never once per element, which
    would re-run the whole upstream expression (tokenizer included) for every
    n-gram if the optimizer inlines it.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    arr = _c(col)
    count = F.greatest(F.size(arr) - (n - 1), F.lit(0))
    shifted = [F.slice(arr, k + 1, count).alias(f"g{k}") for k in range(n)]
    zipped = F.arrays_zip(*shifted)
    grams = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"g{k}"] for k in range(n)]))
    return F.when(F.size(arr) >= n, grams).otherwise(F.array().cast("array<string>"))


def size(col: str | Column) -> Column:
    """Number of elements."""
    return F.size(_c(col))


def explode_values(df, keys, col: str | Column, out: str, pos: str | None = None):
    """One row per array element (``keys..., [pos,] out``).

    Uses the outer generator plus a null filter on the generated column:
    with a plain ``explode`` Spark infers ``size(arr) > 0`` and pushes it
    below the projection, evaluating the whole array expression twice.
    Empty and null arrays produce no rows, as with ``explode``.
    """
    src = _c(col)
    if pos is None:
        return (df.select(*keys, F.explode_outer(src).alias(out))
                .where(F.col(out).isNotNull()))
    return (df.select(*keys, F.posexplode_outer(src).alias(pos, out))
            .where(F.col(pos).isNotNull()))
