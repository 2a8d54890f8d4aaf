"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.session import ensure_checkpoint_dir, table_path


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package (once a context), as ``--py-files`` would, from a
    zip in the shared folder: tasks import it, and need not hold it themselves."""
    sc = spark.sparkContext
    if getattr(sc, "_statflow_shipped", False):
        return
    import io
    import zipfile
    from pathlib import Path

    from statflow.llm.files import NewFile
    package, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    code = NewFile(shared_folder(spark, "code"), "statflow.zip")
    code.write(data.getvalue())
    code.commit()
    sc.addPyFile(code.uri)
    sc._statflow_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage at a table that survives lost executors; everything
    downstream sees one fixed copy of the rows.
    """
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def hash52(*parts: Column | str | int) -> Column:
    """52 uniform bits from the md5 of the parts joined with ``:`` (SQL engines
    agree on md5, so results can be checked elsewhere). Null counts as ``~``."""
    texts = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    joined = F.concat_ws(":", *[F.coalesce(t.cast("string"), F.lit("~")) for t in texts])
    digits = F.substring(F.md5(joined.cast("binary")), 1, 13)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0))


def learn_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus))


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a whole text column (one cheap aggregate); sizes partitions."""
    return int(df.agg(F.sum(F.octet_length(F.col(col))).alias("b")).first()["b"] or 0)


# ------------------------------------------------------------------ numpy on text buffers

_M = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x += _M
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def text_buffer(array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string column without nulls: the UTF-8
    bytes of all rows in a row, and n + 1 row bounds."""
    import pyarrow as pa
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
        if isinstance(array, pa.ChunkedArray):
            array = pa.concat_arrays(array.chunks) if array.num_chunks else \
                pa.array([], pa.string())
    large = pa.types.is_large_string(array.type)
    width = np.int64 if large else np.int32
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], width)[
        array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NO_ALNUM = np.zeros(256, bool)
_NO_ALNUM[:128] = [not chr(c).isalnum() for c in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    if n:
        out[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
    return out


class SpanHasher:
    """64-bit hashes of byte spans: a span's bytes as a polynomial modulo 2**64 (by
    one running sum over the buffer), mixed together with its length."""

    def __init__(self):
        self._up = self._down = np.zeros(0, np.uint64)

    def spans(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(raw)
        if len(self._up) < n:
            self._up, self._down = _powers(_BASE, n), _powers(_BASE_INV, n)
        run = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=run[1:])
            h = (run[end] - run[start]) * self._down[start]
            h ^= (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return mix64(h)


class WordHasher(SpanHasher):
    """64-bit hashes of the words of many rows at once, with A-Z lower-cased. Words
    are maximal runs without ASCII white space or, with ``alnum``, maximal runs of
    ASCII letters, ASCII digits and non-ASCII characters.

    Work is done in pieces of about ``piece`` bytes, so memory stays bounded.
    """

    def __init__(self, piece: int = 1 << 20, alnum: bool = False):
        super().__init__()
        self.piece = piece
        self._apart = _NO_ALNUM if alnum else _SPACE

    def __call__(self, raw: np.ndarray, offsets: np.ndarray):
        """``(hashes, word_offsets)``: all words in order; row i owns
        ``hashes[word_offsets[i]:word_offsets[i + 1]]``."""
        hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
        i, n = 0, len(offsets) - 1
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + self.piece, "right")) - 1
            j = min(max(j, i + 1), n)
            h, c = self._rows(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            hashes.append(h)
            counts[i:j] = c
            i = j
        bounds = np.zeros(n + 1, np.int64)
        np.cumsum(counts, out=bounds[1:])
        return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), bounds

    def _rows(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
        inside = ~self._apart[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        row_start = offsets[:-1][offsets[:-1] < n]
        first[row_start] = inside[row_start]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        row_end = offsets[1:][offsets[1:] > 0] - 1
        last[row_end] = inside[row_end]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = self.spans(_LOWER[raw], start, end)
        bounds = np.searchsorted(start, offsets)
        return h, np.diff(bounds)


def planes(x: np.ndarray) -> bytes:
    """The bytes of a fixed-width integer array, plane by plane: equal high bytes
    lie together, so the shuffle's compression removes them."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""


def from_planes(raw: bytes | memoryview, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    a = np.frombuffer(raw, np.uint8)
    return np.ascontiguousarray(a.reshape(width, -1).T).reshape(-1).view(dtype)


def unique_counts(x: np.ndarray, weight: np.ndarray | None = None):
    """Sorted distinct values and, for each, the row count or summed weights."""
    if weight is None:
        return np.unique(x, return_counts=True)
    order = np.argsort(x, kind="stable")
    s = x[order]
    head = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    return s[head], (np.add.reduceat(weight[order], head) if len(head)
                     else np.zeros(0, weight.dtype))


def release_memory() -> None:
    """Give freed memory back to the system: a worker that waits for its next task must
    not keep its last task's peak."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def names(df: DataFrame, cols: Sequence[str]) -> Sequence[str]:
    """Check that the columns exist; extra columns are allowed everywhere."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return cols
