"""Quoted records (S4, R5): one file read by many tasks, quoted newlines included.

Spark splits the files by lines; a line alone does not tell whether it begins inside a
quoted field. So every split (a file's byte range) is first read as a function of that one
bit: in which state does it end if it starts outside, or inside, a quoted field? A
running composition of these functions along each file (a window over one row a split)
gives every split its true first state, and a second pass reads the records from there.
A record that crosses split edges is put together from its pieces, one row a piece.

The field count is checked where a record is parsed, so no column pruning, ``count()`` or
narrow ``select`` above it can switch it off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.session import ensure_checkpoint_dir

MAX_RECORD_CHARS = 64 << 20
#: Split states go to every task up to so many splits (about 100 bytes each); beyond, they
#: are joined by a shuffle and the lines sorted back into file order.
BROADCAST_SPLITS = 500_000
_BATCH_ROWS = 4096


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, split, pos, value)``: physical lines; ``split`` is the first byte of the
    range that holds the line, ``pos`` rises with the lines of a split."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("pos"), "value"))


def _tools(max_chars: int):
    """The parsing helpers as closures made on the driver: they travel to the tasks with the
    function that uses them, so executors need not hold this package."""
    import csv
    from itertools import chain, groupby

    def ends_inside(line: str, inside: bool) -> bool:
        """Does a quoted field stay open at the end of the line?"""
        if '"' not in line:
            return inside
        asked = False

        def source():
            nonlocal asked
            yield '"' + line if inside else line
            asked = True

        try:
            next(csv.reader(source()))
        except csv.Error:  # a lone carriage return outside quotes: the record ends here
            return False
        return asked

    def splits(batches, names):
        """``((file, split, ...), lines)`` of each run of rows with equal ``names``."""
        csv.field_size_limit(2**31 - 1)

        def rows():
            for b in batches:
                cols = [b.column(b.schema.get_field_index(n)).to_pylist() for n in [*names, "value"]]
                yield zip(*cols)
        for key, run in groupby(chain.from_iterable(rows()), key=lambda r: r[:-1]):
            yield key, (r[-1] for r in run)

    def records(lines):
        """Parsed records of whole lines, ``None`` for one that cannot be read, and
        whether the last one is still open: ``(fields, open)`` each."""
        ended, size = False, 0

        def source():
            nonlocal ended, size
            for line in lines:
                size += len(line)
                if size > max_chars:
                    raise RuntimeError(f"a record has more than {max_chars} characters: is a quote "
                                       "not closed?")
                yield line + "\n"
            ended = True

        reader = csv.reader(source())
        while True:
            size = 0
            try:
                fields = next(reader)
            except StopIteration:
                return
            except csv.Error:
                yield None, False
                continue
            yield fields, ended

    return ends_inside, splits, records


def _emitter(width: int, keep: Sequence[int]):
    """Rows of text fields to Arrow batches; empty fields are null."""
    def emit(rows):
        import pyarrow as pa
        names = [f"c{k}" for k in keep]

        def batch(buf):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] or None for r in buf], pa.string()) for k in keep], names)

        buf = []
        for r in rows:
            if r is not None and len(r) == width:
                buf.append(r)
                if len(buf) == _BATCH_ROWS:
                    yield batch(buf)
                    buf = []
        if buf:
            yield batch(buf)
    return emit


def split_states(lines: DataFrame, max_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """One row a split: ``(file, split, inside, open, owner)``: does it begin inside a
    quoted field, does it end inside one, and at which split does the record begin that
    reaches into it."""
    ends_inside, splits, _ = _tools(max_chars)

    def run(batches):
        import pyarrow as pa
        out = []
        for (file, split), values in splits(batches, ["file", "split"]):
            a, b, closes = False, True, False
            for v in values:
                if v is not None:
                    same, a = a == b, ends_inside(v, a)
                    b = a if same else ends_inside(v, b)
                closes = closes or not b
            out.append((file, split, a, b, closes))
        cols = list(zip(*out)) if out else [[], [], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
             *(pa.array(c, pa.bool_()) for c in cols[2:])], ["file", "split", "a", "b", "closes"])

    # Lines without a quote do not change the state: only their place is sent.
    quoted = lines.select("file", "split", F.when(F.contains("value", F.lit('"')), F.col("value"))
                          .alias("value"))
    maps = quoted.mapInArrow(run, "file string, split long, a boolean, b boolean, closes boolean")
    w = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("a") & ~F.col("b")).cast("int")
    states = maps.withColumn("flips", F.coalesce(F.sum(flip).over(w), F.lit(0)))
    # After a split that ends alike from both states, only the flips since then count.
    base = F.when(F.col("a") == F.col("b"), F.pmod(F.col("a").cast("int") + F.col("flips"), F.lit(2)))
    states = states.withColumn("base", base)
    inside = F.pmod(F.coalesce(F.last("base", True).over(w), F.lit(0)) + F.col("flips"), F.lit(2)) == 1
    states = states.withColumn("inside", inside)
    whole = F.col("inside") & ~F.col("closes")
    states = states.withColumn("begins", F.when(~whole, F.col("split")))
    return states.select("file", "split", "inside",
                         F.when(F.col("inside"), F.col("b")).otherwise(F.col("a")).alias("open"),
                         F.last("begins", True).over(w).alias("owner"))


def _with_state(lines: DataFrame, states: DataFrame, small: bool, how: str) -> DataFrame:
    if small:
        return lines.join(F.broadcast(states), ["file", "split"], how)
    return lines.join(states, ["file", "split"], how).sortWithinPartitions("file", "split", "pos")


def _edge_pieces(lines: DataFrame, states: DataFrame, small: bool, max_chars: int) -> DataFrame:
    """``(file, owner, split, part, first, text)``: the pieces of records that cross
    split edges; part 1 begins a record, part 0 continues one."""
    ends_inside, splits, _ = _tools(max_chars)

    def run(batches):
        import pyarrow as pa
        for (file, split, inside, owner), values in splits(batches, ["file", "split", "inside", "owner"]):
            out, buf, size, first, state, part = [], [], 0, split == 0, inside, 0 if inside else 1
            for v in values:
                buf.append(v)
                size += len(v)
                if size > max_chars:
                    raise RuntimeError(f"{file}, from byte {split}: a record has more than {max_chars} "
                                       "characters: is a quote not closed?")
                state = ends_inside(v, state)
                if not state:
                    if part == 0:
                        out.append((file, owner, split, 0, False, "\n".join(buf)))
                    buf, size, first, part = [], 0, False, 1
            if state and buf:
                out.append((file, split if part else owner, split, part, first and part == 1, "\n".join(buf)))
            if out:
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.string()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                     pa.array(c[3], pa.int32()), pa.array(c[4], pa.bool_()), pa.array(c[5], pa.string())],
                    ["file", "owner", "split", "part", "first", "text"])

    edges = states.where(F.col("inside") | F.col("open"))
    return (_with_state(lines, edges, small, "inner").select("file", "split", "inside", "owner", "value")
            .mapInArrow(run, "file string, owner long, split long, part int, first boolean, text string"))


def read_records(spark: SparkSession, path: str, names: Sequence[str], header: bool = False,
                 multiline: bool = True, columns: Sequence[str] | None = None,
                 max_record_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """S4 + R5: quoted CSV (embedded commas, quotes and newlines) with ``len(names)``
    fields; records with any other field count are dropped, however few columns are used.

    All columns are read as text (typing is the caller's job: ``try_cast``), an empty field
    as null; ``columns`` returns some of them, so that only these leave the parser. A
    doubled quote inside a quoted field is a quote; a quote inside an unquoted field is
    itself. With ``header`` the first record of every file goes.

    Large files are split; a record may cross any number of split edges. The states of the
    splits (one row a split) are computed when this is called and kept in the checkpoint
    folder; reading then takes one pass, and a second one over the splits that a record
    crosses. A record of more than ``max_record_chars`` characters (an unclosed quote)
    fails the job; at the end of a file an unclosed field ends with the file. A line break
    is ``\\n`` or ``\\r\\n``; a record with a lone ``\\r`` outside quotes is dropped.
    ``multiline=False`` is for files without quoted newlines: one pass, every line is a
    record, and a line with an unclosed quote is dropped.
    """
    names = list(names)
    chosen = list(columns) if columns is not None else names
    unknown = [c for c in chosen if c not in names]
    if unknown or not chosen:
        raise ValueError(f"columns {unknown or chosen} are not among the fields")
    keep = [names.index(c) for c in chosen]
    emit = _emitter(len(names), keep)
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in keep])
    lines = _lines(spark, path)
    _, splits, records = _tools(max_record_chars)

    def one_line(batches):
        def rows():
            for (_, split), values in splits(batches, ["file", "split"]):
                for k, v in enumerate(values):
                    if not (header and split == 0 and k == 0):
                        for fields, is_open in records([v]):
                            yield None if is_open else fields
        yield from emit(rows())

    if not multiline:
        out = lines.select("file", "split", "value").mapInArrow(one_line, schema)
        return out.toDF(*chosen)

    def whole(batches):
        def rows():
            for (file, split, inside), values in splits(batches, ["file", "split", "inside"]):
                if inside is None:
                    raise RuntimeError(f"{file}: the split at byte {split} was not there when the states "
                                       "were computed; keep the files and the split settings as they were")
                if inside:  # the rest of an earlier record: an opening quote makes it one
                    values = prefixed(values)
                for k, (fields, is_open) in enumerate(records(values)):
                    if not (is_open or (k == 0 and (inside or (header and split == 0)))):
                        yield fields
        yield from emit(rows())

    def prefixed(values):
        for k, v in enumerate(values):
            yield v if k else '"' + v

    def joined(batches):
        def rows():
            for b in batches:
                for text in b.column(0).to_pylist():
                    for fields, _ in records(iter(text.split("\n"))):
                        yield fields
        yield from emit(rows())

    ensure_checkpoint_dir(spark)
    states = split_states(lines, max_record_chars).checkpoint(eager=True)
    small = states.count() <= BROADCAST_SPLITS
    inner = _with_state(lines, states.select("file", "split", "inside"), small, "left")
    within = inner.select("file", "split", "inside", "value").mapInArrow(whole, schema)
    pieces = _edge_pieces(lines, states, small, max_record_chars)
    # One record a group: its pieces, in order. Its length is checked where it is parsed.
    texts = pieces.groupBy("file", "owner").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("split", "part", "text"))).alias("p"))
    if header:
        texts = texts.where(~F.col("first"))
    across = texts.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return within.unionByName(across.mapInArrow(joined, schema)).toDF(*chosen)
