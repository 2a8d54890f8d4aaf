"""Readers (S1-S5). Each returns a lazy DataFrame; Catalyst prunes columns and
pushes filters into the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions.scalars import _literal_regex
from statflow.session import table_path
from statflow.sources.records import read_records  # noqa: F401


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of the test layout ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             null_value: str | None = None) -> DataFrame:
    """Delimited file with a declared schema, permissive.

    A token that does not fit a numeric column (``NA``) reads as null, the same
    token in a STRING column stays text; extra fields are cut, missing ones null.
    """
    reader = spark.read.options(header=str(header).lower(), mode="PERMISSIVE").schema(schema)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_paragraphs(spark: SparkSession, path: str, col: str = "paragraph") -> DataFrame:
    """One paragraph per non-blank line (CRLF handled, whitespace-only lines dropped)."""
    return (spark.read.text(path)
            .where(F.col("value").rlike(r"\S"))
            .select(F.col("value").alias(col)))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3: raw lines, column ``value``."""
    return spark.read.text(path)


def split_fields(df: DataFrame, names: Sequence[str], sep: str = ",", col: str = "value",
                 types: Mapping[str, str] | None = None, keep: bool = False) -> DataFrame:
    """Split an unquoted delimited line into named columns.

    A missing field is null; ``types`` casts with ``try_cast`` so a bad token is
    null rather than a failed job. ``keep`` retains the source column.
    """
    parts = F.split(F.col(col), _literal_regex(sep), -1)
    types = types or {}
    cols = []
    for i, name in enumerate(names):
        c = F.get(parts, i)
        if name in types:
            c = c.try_cast(types[name])
        cols.append(c.alias(name))
    base = [F.col(c) for c in df.columns] if keep else []
    return df.select(*base, *cols)


def filter_arity(df: DataFrame, col: str, n: int, sep: str = ",") -> DataFrame:
    """R5 on unquoted text: keep rows whose ``col`` has exactly ``n`` fields."""
    return df.where(F.size(F.split(F.col(col), _literal_regex(sep), -1)) == n)
