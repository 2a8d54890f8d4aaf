"""Operator 10: token-id files of independent zstandard frames with a seek table.

File layout (all integers little-endian):

    frame 0 .. frame F-1   zstandard frames; each holds the ids of some whole
                           documents, 2 or 4 bytes an id
    tables                 one zstandard frame: F records (offset u64, stored u64,
                           raw u64, documents u64, xxh64 of the stored bytes u64),
                           then D document ids (i64), D valid flags (u8),
                           D id counts (u64)
    footer, 40 bytes       magic "SFTOKEN1", bytes an id u32, F u32, D u64,
                           stored bytes of the tables u64, their xxh64 u64

A reader takes the footer, then the tables, then only the frames that hold the
documents it wants, and checks each frame against its checksum. Frames share no
dictionary or history, so a damaged frame costs its own documents only.

The corpus is range-partitioned and sorted by doc_id (ties by the text's hash), so
file k's documents come before file k+1's. Each task writes one file under a
temporary name and renames it; the table of files (the manifest) names exactly the
files of successful tasks.

Defined cases: null text is empty text (its end id alone); a null doc_id sorts
first and is kept as null; repeated rows are kept; an empty table makes no files
and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import (names, null_safe_text, shared_folder, stage, text_buffer,
                                 text_bytes)
from statflow.llm.files import NewFile, open_file

MAGIC = b"SFTOKEN1"
_FOOTER = struct.Struct("<8sIIQQQ")
FRAME_BYTES = 1 << 20      # ids of about this many bytes make a frame
FILE_TEXT_BYTES = 64 << 20  # text that one task encodes into one file


def _xxh(data) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(data)


class TokenFileWriter:
    """Writes documents in order to one file; ``close`` adds the tables and commits."""

    def __init__(self, folder: str, name: str, vocab_size: int, level: int = 3,
                 frame_bytes: int = FRAME_BYTES):
        import zstandard
        self._file = NewFile(folder, name)
        self._zip = zstandard.ZstdCompressor(level=level)
        self._type = np.dtype("<u2" if vocab_size <= 1 << 16 else "<u4")
        self._frame_bytes = frame_bytes
        self._frames: list[tuple[int, int, int, int, int]] = []
        self._pending: list[bytes] = []
        self._pending_bytes = self._pending_docs = 0
        self._doc_ids: list[int | None] = []
        self._counts: list[int] = []
        self.uri, self.tokens = self._file.uri, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        data = ids.astype(self._type).tobytes()
        self._pending.append(data)
        self._pending_bytes += len(data)
        self._pending_docs += 1
        self._doc_ids.append(doc_id)
        self._counts.append(len(ids))
        self.tokens += len(ids)
        if self._pending_bytes >= self._frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if not self._pending_docs:
            return
        stored = self._zip.compress(b"".join(self._pending))
        self._frames.append((self._file.size, len(stored), self._pending_bytes,
                             self._pending_docs, _xxh(stored)))
        self._file.write(stored)
        self._pending, self._pending_bytes, self._pending_docs = [], 0, 0

    def close(self) -> int:
        """Returns the number of documents."""
        self._flush()
        ids = np.array([x or 0 for x in self._doc_ids], "<i8")
        valid = np.array([x is not None for x in self._doc_ids], np.uint8)
        tables = self._zip.compress(
            np.array(self._frames, "<u8").tobytes() + ids.tobytes() + valid.tobytes()
            + np.array(self._counts, "<u8").tobytes())
        self._file.write(tables)
        self._file.write(_FOOTER.pack(MAGIC, self._type.itemsize, len(self._frames), len(ids),
                                      len(tables), _xxh(tables)))
        self._file.commit()
        return len(ids)


class TokenFile:
    """Random access to one file: ``doc_ids`` (None where null), ``counts``, ``read``."""

    def __init__(self, uri: str):
        import zstandard
        self._in = open_file(uri)
        size = self._in.size()
        tail = self._in.read_at(_FOOTER.size, size - _FOOTER.size)
        magic, width, n_frames, n_docs, stored, check = _FOOTER.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        packed = self._in.read_at(stored, size - _FOOTER.size - stored)
        if _xxh(packed) != check:
            raise ValueError(f"{uri}: the tables do not match their checksum")
        self._zip = zstandard.ZstdDecompressor()
        raw = self._zip.decompress(packed)
        self._type = np.dtype(f"<u{width}")
        self.frames = np.frombuffer(raw, "<u8", 5 * n_frames).reshape(-1, 5)
        at = 40 * n_frames
        ids = np.frombuffer(raw, "<i8", n_docs, at)
        valid = np.frombuffer(raw, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [int(x) if ok else None for x, ok in zip(ids, valid)]
        self.counts = np.frombuffer(raw, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        self._first_doc = np.r_[0, np.cumsum(self.frames[:, 3].astype(np.int64))]
        self.uri, self.frames_read = uri, 0

    def frame(self, k: int) -> np.ndarray:
        offset, stored, raw, _, check = (int(x) for x in self.frames[k])
        data = self._in.read_at(stored, offset)
        if _xxh(data) != check:
            raise ValueError(f"{self.uri}: frame {k} does not match its checksum")
        self.frames_read += 1
        return np.frombuffer(self._zip.decompress(data, max_output_size=raw), self._type)

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """``(position, ids)`` of all documents in order, one frame in memory at a time."""
        for k in range(len(self.frames)):
            first, end = self._first_doc[k], self._first_doc[k + 1]
            ids = self.frame(k)
            bounds = np.r_[0, np.cumsum(self.counts[first:end])]
            for i in range(end - first):
                yield int(first + i), ids[bounds[i]:bounds[i + 1]]

    def read(self, positions: Sequence[int]) -> list[np.ndarray]:
        """The ids of the documents at these positions; only their frames are read."""
        out: dict[int, np.ndarray] = {}
        at = np.asarray(sorted(set(positions)), np.int64)
        frames = np.searchsorted(self._first_doc, at, "right") - 1
        for k in np.unique(frames):
            first = self._first_doc[k]
            bounds = np.r_[0, np.cumsum(self.counts[first:self._first_doc[k + 1]])]
            ids = self.frame(int(k))
            for p in at[frames == k]:
                out[int(p)] = ids[bounds[p - first]:bounds[p - first + 1]]
        return [out[int(p)] for p in positions]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int,
                      file_text_bytes: int = FILE_TEXT_BYTES) -> DataFrame:
    """Write the files; returns the manifest ``path, part, docs, tokens`` (a table)."""
    names(docs, ["doc_id", "text"])
    text = docs.select(F.col("doc_id").cast("long"), null_safe_text(F.col("text")).alias("text"))
    parts = max(1, -(-text_bytes(text) // file_text_bytes))
    folder = shared_folder(docs.sparkSession, "tokens")
    tie = F.xxhash64("text")
    ordered = (text.repartitionByRange(parts, F.asc_nulls_first("doc_id"), tie)
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), tie))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from statflow.llm.tokens import TextEncoder
        part = TaskContext.get().partitionId()
        encoder = writer = None
        for batch in batches:
            if encoder is None:
                encoder = TextEncoder(tokenizer)
                writer = TokenFileWriter(folder, f"part-{part:07d}-{uuid.uuid4().hex}.tok",
                                         max(encoder.vocab_size, end_id + 1))
            raw, offsets = text_buffer(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            i, n, end = 0, batch.num_rows, np.array([end_id], np.uint32)
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + (1 << 20), "right")) - 1
                j = min(max(j, i + 1), n)
                ids, bounds = encoder.encode_buffer(raw[offsets[i]:offsets[j]],
                                                    offsets[i:j + 1] - offsets[i])
                for k in range(j - i):
                    writer.add(doc_ids[i + k],
                               np.concatenate([ids[bounds[k]:bounds[k + 1]], end]))
                i = j
        if writer is not None:
            n_docs = writer.close()
            yield pa.RecordBatch.from_pydict({"path": [writer.uri], "part": [part],
                                              "docs": [n_docs], "tokens": [writer.tokens]})

    return stage(ordered.mapInArrow(run, "path string, part long, docs long, tokens long"),
                 "token-manifest")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32[, ids]`` of every document, from the files.

    ``start``: ids of all documents before it. The running sum is over the manifest,
    one row a file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    # One file to a task, dealt by number.
    n = max(1, manifest.count())
    files = files.repartition(n, "path")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(),
                                  batch.column("base").to_pylist()):
                source = TokenFile(path)
                start = base + np.cumsum(source.counts) - source.counts
                rows: list[tuple] = []
                fields = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids

                def flush():
                    cols = list(zip(*rows)) if rows else [[] for _ in fields]
                    return pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, kinds)], names=fields)

                for p, ids in source.documents():
                    row = (source.doc_ids[p], int(start[p]), len(ids),
                           zlib.crc32(ids.astype("<u4")))
                    rows.append(row + ((ids.astype(np.int32),) if with_ids else ()))
                    if len(rows) >= 5000:
                        yield flush()
                        rows.clear()
                if rows:
                    yield flush()

    return files.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
