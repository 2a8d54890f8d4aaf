"""Operator 7: best-two-fit packing of token pieces into sequences.

The method: fill a bin greedily (each time the longest unpacked piece that fits),
then replace the bin's smallest piece by two unpacked pieces that fit the
expanded gap more tightly.

Pieces of one length are interchangeable, so the choice of pieces depends on
nothing but how many pieces of each length are left: ``capacity`` counters, at any
corpus size. ``plan_bins`` runs the method on that histogram and repeats each
filled bin as often as the counters allow (the same choices would be made again
until a length runs out), which gives at most about ``capacity * log2(capacity)``
bin patterns. Spark counts the lengths, ranks the pieces within each length by a
hash, and a join on (length, rank range) with the plan gives each piece its
sequence and offset. So all pieces are packed together, not shard by shard.

Defined cases: null text is empty text; an empty document is its end id alone;
documents longer than the capacity are cut from their end into whole pieces, the
first piece holding the rest; repeated rows are packed once each; pieces with null
or non-positive length raise an error; an empty table gives an empty result; extra
columns are ignored by ``pack_documents`` and kept by ``best_two_fit``.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import hash52, names, null_safe_text, stage, text_buffer

RANK_ROWS = 50_000  # rows of one length that one window partition ranks


def plan_bins(counts: Sequence[int], capacity: int) -> list[tuple[list[int], int]]:
    """``(lengths in the bin, times)`` for pieces given as counts by length (index =
    length). Every piece is in one bin; deterministic."""
    left = np.zeros(capacity + 1, np.int64)
    left[:len(counts)] = counts
    if left[0]:
        raise ValueError("pieces need a positive length")
    bins = []
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return bins
        avail = left.copy()
        bin_, gap = [], capacity
        while gap > 0:
            fits = have[:np.searchsorted(have, gap, "right")]
            fits = fits[avail[fits] > 0]
            if not len(fits):
                break
            longest = int(fits[-1])
            bin_.append(longest)
            avail[longest] -= 1
            gap -= longest
        while gap > 0:  # two unpacked pieces instead of the smallest one
            smallest = bin_[-1]
            pair = _best_pair(avail, smallest, smallest + gap)
            if pair is None:
                break
            bin_.pop()
            avail[smallest] += 1
            for x in pair:
                avail[x] -= 1
            bin_.extend(pair)
            bin_.sort(reverse=True)
            gap += smallest - sum(pair)
        lengths, used = np.unique(bin_, return_counts=True)
        times = int((left[lengths] // used).min())
        left[lengths] -= used * times
        bins.append((bin_, times))


def _best_pair(avail: np.ndarray, above: int, limit: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is the largest in ``(above, limit]``."""
    have = np.flatnonzero(avail[:limit])
    if not len(have):
        return None
    slot = np.searchsorted(have, limit - have, "right") - 1
    other = have[np.maximum(slot, 0)]
    alone = (other == have) & (avail[have] < 2)
    lower = np.maximum(slot - 1, 0)
    ok = (slot >= 0) & ~(alone & (slot < 1))
    other = np.where(alone, have[lower], other)
    total = np.where(ok, have + other, -1)
    best = int(total.argmax())
    if total[best] <= above or total[best] > limit:
        return None
    a, b = int(have[best]), int(other[best])
    return (a, b) if a >= b else (b, a)


def plan_table(bins: list[tuple[list[int], int]]) -> list[tuple]:
    """Rows ``(length, first rank, end rank, per bin, first sequence, offset)``."""
    rows, next_rank, sequence = [], {}, 0
    for lengths, times in bins:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            per = lengths.count(length)
            first = next_rank.get(length, 0)
            next_rank[length] = first + per * times
            rows.append((length, first, first + per * times, per, sequence, offset))
            offset += per * length
        sequence += times
    return rows


def best_two_fit(pieces: DataFrame, length: str, capacity: int) -> DataFrame:
    """All columns of ``pieces`` (``length``: long, 1..capacity) plus ``sequence_id``
    and ``offset``. ``pieces`` is read several times: pass a table or a staged result."""
    spark, cols = pieces.sparkSession, pieces.columns
    found = pieces.groupBy(F.col(length).cast("long").alias("__l")).count().collect()
    if any(r["__l"] is None or not 1 <= r["__l"] <= capacity for r in found):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    counts = [0] * (capacity + 1)
    for r in found:  # at most ``capacity`` rows
        counts[r["__l"]] = r["count"]
    plan = plan_table(plan_bins(counts, capacity))
    ranges = [(x, 1 + n // RANK_ROWS) for x, n in enumerate(counts) if n]
    ranges_df = spark.createDataFrame(ranges, "__l long, __nb long")
    plan_df = spark.createDataFrame(
        plan, "__pl long, __from long, __to long, __per long, __seq long, __off long")

    # Equal rows are counted, then given a run of ranks: any of them may have any.
    h = hash52(*[F.col(c).cast("string") for c in cols if not _nested(pieces, c)])
    rows = (pieces.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__l", F.col(length).cast("long")).withColumn("__h", h)
            .join(F.broadcast(ranges_df), "__l")
            .withColumn("__b", F.floor(F.col("__h") / F.lit(float(1 << 52)) * F.col("__nb"))))
    sizes = rows.groupBy("__l", "__b").agg(F.sum("__n").alias("__t"))
    before = Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__l", "__b",
                           F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o"))
    order = [c for c in cols if not _nested(pieces, c)]
    inside = (Window.partitionBy("__l", "__b").orderBy("__h", *order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.col("__o") + F.col("__e")
    ranked = (rows.withColumn("__e", F.sum("__n").over(inside)).join(offsets, ["__l", "__b"])
              .select(*cols, "__l",
                      F.explode(F.sequence(end - F.col("__n"), end - 1)).alias("__rank")))
    hit = ((F.col("__l") == F.col("__pl")) & (F.col("__rank") >= F.col("__from"))
           & (F.col("__rank") < F.col("__to")))
    at = F.col("__rank") - F.col("__from")
    return ranked.join(F.broadcast(plan_df), hit).select(
        *cols, (F.col("__seq") + F.floor(at / F.col("__per"))).cast("long").alias("sequence_id"),
        (F.col("__off") + at % F.col("__per") * F.col("__l")).alias("offset"))


def _nested(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() in ("array", "struct", "map", "binary")


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0,
                    with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``: each document's ids and the
    end id, in pieces of at most ``capacity``."""
    names(docs, ["doc_id", "text"])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches):
        import pyarrow as pa
        from statflow.llm.tokens import TextEncoder
        encoder = TextEncoder(tokenizer)
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            i, n = 0, batch.num_rows
            doc_ids = batch.column("doc_id")
            while i < n:  # about 1 MB of text at a time
                j = int(np.searchsorted(offsets, offsets[i] + (1 << 20), "right")) - 1
                j = min(max(j, i + 1), n)
                ids, bounds = encoder.encode_buffer(raw[offsets[i]:offsets[j]],
                                                    offsets[i:j + 1] - offsets[i])
                ids = np.insert(ids, bounds[1:], np.uint32(end_id))
                bounds = bounds + np.arange(len(bounds))
                total = np.diff(bounds)
                rest = total % capacity
                pieces = total // capacity + (rest > 0)
                row = np.repeat(np.arange(len(total)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = np.where(rest > 0, rest, capacity)[row]
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                begin = bounds[:-1][row] + start
                data = ids.astype("<u4", copy=False)
                crc = [zlib.crc32(data[a:a + k]) for a, k in zip(begin.tolist(), length.tolist())]
                out = [doc_ids.slice(i, j - i).take(pa.array(row)), pa.array(piece, pa.int32()),
                       pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                fields = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:  # pieces of a document follow one another, so do their ids
                    cut = np.r_[begin, len(ids)].astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(cut),
                                                        pa.array(ids.astype(np.int32))))
                    fields.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=fields)
                i = j

    text = docs.select(F.col("doc_id").cast("long"), null_safe_text(F.col("text")).alias("text"))
    return text.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   with_ids: bool = False) -> DataFrame:
    """Pack whole documents: one row per piece, with its sequence and offset there."""
    pieces = stage(document_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return best_two_fit(pieces, "length", capacity)
