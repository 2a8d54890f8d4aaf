"""Partition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Deal ``df`` round-robin, or by ``key``, over ``partitions`` tasks; None leaves it as it is.
    What is counted by document and term needs no other shuffle if the key is the document.

    For CPU-heavy per-row work (tokenising long texts) on inputs stored as a few
    large, unsplittable row groups. The count is the caller's: seeded fits depend on
    the partitioning, so it must not follow the machine.
    """
    return df if partitions is None else df.repartition(partitions, *([key] if key else []))
