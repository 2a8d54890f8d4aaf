"""Operator 4: a deterministic sharded WARC writer and its reader.

Pages are cut into ranges and sorted by (page_id, payload digest). The cuts come from
exact running payload bytes in that order (``range_cuts``), not from a sample, so they
depend on the pages only. Each task walks
its range in order and writes gzip members, one a record, to a file; when the file's
compressed size reaches ``file_bytes`` it rolls to the next. Headers are generated
again from the row (ids by UUID 5 from page id and digest, a fixed date, digests of
payload and block), so the same pages give the same bytes. A file is written under a
temporary name, renamed when whole, and named by the manifest, which holds the
files of successful tasks only.

Records with equal payloads of at least ``revisit_bytes`` bytes: the one with the
smallest page_id is the ``response``, the others are ``revisit`` records without the
payload. Which rows are revisits is found on digests alone (counts first, then a
join salted ``SALTS`` ways, as one payload may hold a third of all pages); the few
columns of a mark go through the same range sort as the pages and arrive just before
their page, so payloads are shuffled once.

Defined cases: null html is an empty payload; a null page_id sorts last and is
written as ``null``, and refers_to is null where the response's page_id is null; of
rows equal in page_id and payload the first is the response; a null or odd URL is
written percent-encoded; whole payloads are written, in memory one at a time; an
empty table writes no file; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from statflow.llm.common import names, shared_folder, stage
from statflow.llm.files import NewFile, open_file
from statflow.operators.ordering import running_total

FILE_BYTES = 64 << 20
TASK_BYTES = 64 << 20  # payload bytes that one task writes
SALTS = 16
_SPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the OID namespace
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}/{copy}')}>"


def _member(head: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    zipper = zlib.compressobj(level, zlib.DEFLATED, 31)
    return zipper.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") \
        + zipper.flush()


class ArchiveWriter:
    """One task's files: ``add`` records in order, ``close`` returns manifest rows."""

    def __init__(self, folder: str, part: int, date: str, file_bytes: int, level: int):
        self._folder, self.part, self._date = folder, part, date
        self._limit, self._level = file_bytes, level
        self._file: NewFile | None = None
        self._records = 0
        self.files: list[tuple[str, int, int, int, int]] = []

    def _open(self) -> NewFile:
        if self._file is None:
            name = f"pages-{self.part:07d}-{len(self.files):05d}.warc.gz"
            self._file, self._records = NewFile(self._folder, name), 0
            info = b"software: statflow\r\nformat: WARC File Format 1.1\r\n"
            self._file.write(_member([
                ("WARC-Type", "warcinfo"), ("WARC-Date", self._date),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"),
                ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                info, self._level))
        return self._file

    def add(self, page_id: int | None, url: str | None, payload: bytes, digest: str, copy: int,
            refers_to: tuple[int | None] | None) -> None:
        """``refers_to``: None for a response, else the response's page id in a tuple."""
        out = self._open()
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(payload)}\r\n\r\n").encode()
        block = http + payload if refers_to is None else http
        target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
        head = [("WARC-Type", "response" if refers_to is None else "revisit"),
                ("WARC-Record-ID", record_id(page_id, digest, copy)),
                ("WARC-Date", self._date), ("WARC-Target-URI", target),
                ("WARC-Page-ID", "null" if page_id is None else str(page_id)),
                ("WARC-Payload-Digest", f"sha1:{digest}"),
                ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
                ("Content-Type", "application/http; msgtype=response")]
        if refers_to is not None:
            first = refers_to[0]
            head += [("WARC-Profile", _PROFILE),
                     ("WARC-Refers-To", record_id(first, digest, 0)),
                     ("WARC-Refers-To-Page-ID", "null" if first is None else str(first))]
        out.write(_member(head, block, self._level))
        self._records += 1
        if out.size >= self._limit:
            self._roll()

    def _roll(self) -> None:
        if self._file is not None:
            self._file.commit()
            self.files.append((self._file.uri, self.part, len(self.files), self._records,
                               self._file.size))
            self._file = None

    def close(self) -> list[tuple[str, int, int, int, int]]:
        self._roll()
        return self.files


def read_records(uri: str, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of each record; digests are checked. One record in memory."""
    source = open_file(uri)
    pending, ended = b"", False
    while True:
        unzip, parts = zlib.decompressobj(31), []
        while not unzip.eof:
            if not pending:
                pending = source.read(chunk)
                if not pending:
                    ended = True
                    break
            parts.append(unzip.decompress(pending))
            pending = unzip.unused_data if unzip.eof else b""
        data = b"".join(parts)
        if ended and not data:
            return
        if not unzip.eof:
            raise ValueError(f"{uri} ends inside a record")
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        block = rest[:int(fields["Content-Length"])]
        if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
            raise ValueError(f"{uri}: not a WARC record")
        want = fields.get("WARC-Block-Digest")
        if want and want != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"{uri}: {fields['WARC-Record-ID']} does not match its digest")
        yield fields, block


def _key() -> Column:
    """(page_id, sha) as one value that orders null page_ids last."""
    return F.struct(F.col("page_id").isNull().cast("int").alias("none"),
                    F.coalesce("page_id", F.lit(0).cast("long")).alias("page_id"),
                    F.col("sha").alias("sha"))


def range_cuts(light: DataFrame, task_bytes: int) -> list[Row]:
    """The first key of every range but the first: where the running bytes of ``page_id,
    sha, size`` pass a multiple of ``task_bytes``. A row a range comes to the driver."""
    keys = light.groupBy("page_id", "sha").agg(F.sum("size").alias("size"))
    upto = running_total(keys, "size", [F.asc_nulls_last("page_id"), F.asc("sha")], "upto")
    part = F.floor((F.col("upto") - F.col("size")) / F.lit(task_bytes))
    cuts = upto.where(part > 0).groupBy(part.alias("part")).agg(F.min(_key()).alias("cut"))
    return [r["cut"] for r in cuts.orderBy("part").collect()]


def range_of(cuts: list[Row]) -> Column:
    """The number of cuts at or below a row's key, by bisection."""
    if not cuts:
        return F.lit(0)
    keys = F.array(*[F.struct(F.lit(c["none"]).alias("none"), F.lit(c["page_id"]).cast("long").alias("page_id"),
                              F.lit(c["sha"]).alias("sha")) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.get(keys, at + step - 1) <= _key()), at + step).otherwise(at))


def write_archives(pages: DataFrame, revisit_bytes: int = 0, file_bytes: int = FILE_BYTES,
                   task_bytes: int = TASK_BYTES, date: str = "2020-01-01T00:00:00Z",
                   level: int = 6) -> DataFrame:
    """Write all pages; returns the manifest ``path, part, seq, records, bytes``."""
    names(pages, ["page_id", "url", "html"])
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    light = stage(rows.select("page_id", "sha", F.octet_length("html").alias("size")), "digests")
    total = light.agg(F.sum("size").alias("s")).first()["s"] or 0
    first = (light.where(F.col("size") >= revisit_bytes).groupBy("sha")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("sha", "first",
                                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    marks = (light.select("page_id", "sha").distinct().withColumn("salt", salt)
             .join(first, ["sha", "salt"]))
    # A mark sorts before the page rows with its page_id and digest.
    both = rows.withColumn("first", F.lit(None).cast("long")).withColumn("kind", F.lit(1)).unionByName(
        marks.select("page_id", F.lit(None).cast("string").alias("url"),
                     F.lit(None).cast("string").alias("html"), "sha", "first",
                     F.lit(0).alias("kind")))
    cuts = range_cuts(light, task_bytes) if total > task_bytes else []
    key = [F.asc_nulls_last("page_id"), F.asc("sha")]
    ordered = (both.withColumn("part", range_of(cuts)).repartitionById(len(cuts) + 1, "part")
               .sortWithinPartitions("part", *key, "kind", "url"))
    folder = shared_folder(spark, "warc")

    def run(batches):
        import pyarrow as pa
        writer, files = None, []
        at, mark, copy = None, None, 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "sha", "first", "kind", "part")]
            for i in range(batch.num_rows):
                page_id, url, text, sha, first_id, kind, part = (c[i].as_py() for c in cols)
                if writer is None or part != writer.part:
                    files += writer.close() if writer else []
                    writer = ArchiveWriter(folder, part, date, file_bytes, level)
                if (page_id, sha) != at:
                    at, mark, copy = (page_id, sha), None, 0
                if kind == 0:
                    mark = (first_id,)
                    continue
                payload = text.encode()
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                revisit = mark is not None and (mark[0] != page_id or copy > 0)
                writer.add(page_id, url, payload, digest, copy, mark if revisit else None)
                copy += 1
        files += writer.close() if writer else []
        if files:
            yield pa.RecordBatch.from_pydict(dict(zip(
                ("path", "part", "seq", "records", "bytes"), map(list, zip(*files)))))

    return stage(ordered.mapInArrow(
        run, "path string, part long, seq long, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to[, url, payload]``
    of every response and revisit record in the files of the manifest."""
    files = manifest.select("path").repartition(max(1, manifest.count()), "path")
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long" + (", url string, payload binary" if with_payload else ""))
    cols = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pyarrow as pa
        kinds = dict(page_id=pa.int64(), payload_bytes=pa.int64(), payload_digest=pa.string(),
                     record_type=pa.string(), refers_to=pa.int64(), url=pa.string(),
                     payload=pa.binary())

        def whole(value):
            return None if value in (None, "null") else int(value)

        def pack(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[k]) for c, k in zip(zip(*rows), cols)], names=cols)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: list[tuple] = []
                for fields, block in read_records(path):
                    kind = fields["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response":
                        if base32_sha1(payload) != digest or len(payload) != size:
                            raise ValueError(f"{path}: {fields['WARC-Record-ID']} has another payload")
                    row = (whole(fields["WARC-Page-ID"]), size, digest, kind,
                           whole(fields.get("WARC-Refers-To-Page-ID")))
                    rows.append(row + ((fields["WARC-Target-URI"],
                                        payload if kind == "response" else None)
                                       if with_payload else ()))
                    if len(rows) >= (200 if with_payload else 5000):
                        yield pack(rows)
                        rows = []
                if rows:
                    yield pack(rows)

    return files.mapInArrow(run, schema)
