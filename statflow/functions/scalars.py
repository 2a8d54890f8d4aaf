"""Scalar column functions (F1-F11). Each returns a Column; nothing runs in Python.

Text that does not parse becomes null through ``try_cast``/``try_divide`` so the
functions keep working with ANSI mode on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number patterns the cleaning rules must reproduce.
UNSIGNED_NUMBER = r"\s*(\d+\.*\d*)"
SIGNED_NUMBER = r"\s*(-*\d+\.*\d*)"
# "x ... a,bcd": the greedy form lets ".+" eat all but one digit before the comma.
RATIO_GREEDY = r"\s*(\d+\.*\d*).+(\d+),(\d+)"
RATIO_FIXED = r"(\d+\.*\d*)\D.*?(\d+),(\d+)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hhmm_to_hour(col: str | Column) -> Column:
    """clock time written as hhmm -> nearest hour, half up (729->7, 730->8, 2359->24)."""
    t = _c(col)
    hours = F.floor(t / 100)
    minutes = t - hours * 100
    return (hours + F.round(minutes / 60)).cast("int")


def fold_by_pattern(col: str | Column, rules: Sequence[tuple[str, str | None]],
                    default: str = "OthersM") -> Column:
    """first matching regex wins; its label replaces the value (None keeps the text).

    Matching is a case-sensitive substring search; null or unmatched -> ``default``.
    """
    c = _c(col)
    expr = None
    for pattern, label in rules:
        hit = F.coalesce(c.rlike(pattern), F.lit(False))
        value = c if label is None else F.lit(label)
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def extract_number(col: str | Column, signed: bool = False, dtype: str = "double") -> Column:
    """first number in the text; no match or an unparsable match -> null."""
    pattern = SIGNED_NUMBER if signed else UNSIGNED_NUMBER
    return F.regexp_extract(_c(col), pattern, 1).try_cast(dtype)


def extract_ratio(col: str | Column, mode: str = "fixed") -> Column:
    """"x ... a,bcd" -> x / (a*1000 + bcd), e.g. "177 hp @ 5,750 RPM" -> 177/5750.

    ``mode='greedy'`` reproduces the original pattern, which reads "12,500" as
    2,500; ``mode='fixed'`` reads the whole thousands group. No comma or a zero
    denominator -> null.
    """
    if mode not in ("greedy", "fixed"):
        raise ValueError(f"mode must be 'greedy' or 'fixed', got {mode!r}")
    pattern = RATIO_GREEDY if mode == "greedy" else RATIO_FIXED
    c = _c(col)
    x = F.regexp_extract(c, pattern, 1).try_cast("double")
    thousands = F.regexp_extract(c, pattern, 2).try_cast("double")
    rest = F.regexp_extract(c, pattern, 3).try_cast("double")
    return F.try_divide(x, F.nullif(thousands * 1000 + rest, F.lit(0.0)))


def flag(col: str | Column, true_text: str = "True") -> Column:
    """text equal to ``true_text`` -> 1, anything else (null included) -> 0."""
    return F.coalesce((_c(col) == F.lit(true_text)).cast("int"), F.lit(0))


def years_before(col: str | Column, ref_year: int = 2020) -> Column:
    """age in years relative to ``ref_year``."""
    return F.lit(ref_year) - _c(col)


def binarise(col: str | Column, gt: float = 0.0) -> Column:
    """Value > threshold -> 1, else 0 (null stays null)."""
    return (_c(col) > F.lit(gt)).cast("int")


def field(col: str | Column, index: int, sep: str = ",") -> Column:
    """0-based field of a delimited line; a missing field is null."""
    return F.get(F.split(_c(col), _literal_regex(sep), -1), index)


def _literal_regex(sep: str) -> str:
    # split() takes a Java regex; quote the separator so '|' or '.' stay literal.
    return sep if sep.isalnum() or sep in {",", " ", "\t", ";", ":"} else f"\\Q{sep}\\E"
