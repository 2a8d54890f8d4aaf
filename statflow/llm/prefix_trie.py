"""Operator 12: conversation prefix trie by whole-sequence collapse.

Conversations that start alike share the nodes of a trie. Identical whole conversations are
first collapsed into one weighted sequence with the list of those that end there; a sequence
that is a proper prefix of another (its key is among the others' prefix keys: an anti-join)
is no leaf; then each sequence stands for all of its conversations in one weighted
aggregate over prefixes.

A prefix is known by its length and four running sums over 32-bit hashes of (place, turn),
together 128 bits. So one row a turn is enough: no conversation, however long, is ever
collected, and running sums are computed over ranges of rows. A node is represented by its
smallest member; every node then lies on exactly one sequence, and totals over subtrees are
sums from the end of each sequence back to its start, added up by prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import names, null_safe_text, stage
from statflow.operators.ordering import global_rank, running_totals

SHARED = 5       # conversations c to c + 4 share the first turns of c, where 5 divides c
HEAD = 9         # of these, crc32(c) mod 9 turns
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
_CHUNK = 1 << 16
_SUMS = ["s0", "s1", "s2", "s3"]


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn: its role's length, role and text."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """``(c, i, dig, bytes)``: the turns of each conversation from 0 on, in order of
    ``turn`` (null first; ties by role, then by digest, repeated rows side by side).
    Null roles and texts are empty; rows without a conversation are in none."""
    names(df, [conv, turn, role, text])
    r, t = null_safe_text(F.col(role)), null_safe_text(F.col(text))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), r.alias("role"),
        turn_digest(r, t).alias("dig"), F.octet_length(t).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"))
    ranked = global_rank(rows, ["turn", "role", "dig", "row"], "i", ["c"])
    return ranked.select("c", (F.col("i") - 1).alias("i"), "dig", "bytes")


def _head_turns(c: Column) -> Column:
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(HEAD)).cast("int")


def shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: ``(c)`` of all of them, and their turns ``(c, d, dig, bytes)``,
    d from 1: the first h turns of conversation c - c % 5 (if there is one), then their own
    turns after the first h."""
    first = (turns.where((F.col("c") % SHARED == 0) & (F.col("i") < HEAD - 1)).groupBy("c")
             .agg(F.array_sort(F.collect_list(F.struct("i", "dig", "bytes"))).alias("start"))  # 8 at most
             .withColumnRenamed("c", "b"))
    convs = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    heads = convs.withColumn("b", F.col("c") - F.col("c") % SHARED).join(first, "b", "left").select(
        "c", F.slice(F.coalesce("start", F.array().cast(first.schema["start"].dataType)),
                     F.lit(1), _head_turns(F.col("c"))).alias("start"))
    heads = stage(heads, "trie-heads")
    begun = heads.select("c", F.inline("start")).select("c", (F.col("i") + 1).alias("d"), "dig", "bytes")
    h = _head_turns(F.col("c"))
    own = turns.where(F.col("i") >= h).join(heads.select("c", F.size("start").alias("k")), "c").select(
        "c", (F.col("k") + F.col("i") - h + 1).cast("long").alias("d"), "dig", "bytes")
    return heads.select("c"), begun.unionByName(own)


def _words() -> list[Column]:
    """Four 32-bit numbers from a turn and its place."""
    a, b = F.xxhash64(F.lit(1), "d", "dig"), F.xxhash64(F.lit(2), "dig", "d")
    return [F.shiftrightunsigned(a, 32), a.bitwiseAND(0xFFFFFFFF),
            F.shiftrightunsigned(b, 32), b.bitwiseAND(0xFFFFFFFF)]


def _prefix_key(length: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", length.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


@dataclass
class Sequences:
    """``members``: ``(key, c)``, every conversation with its whole-sequence key;
    ``ends``: ``(key, seq, weight, len, ends_sha256)``, one row a distinct sequence, ``seq``
    its smallest conversation; ``turns``: rebuilt turns ``(c, d, dig, bytes)``."""

    members: DataFrame
    ends: DataFrame
    turns: DataFrame


def collapse(convs: DataFrame, turns: DataFrame) -> Sequences:
    """Group identical conversations. The list of ids that end at a sequence is hashed in
    order without being gathered: ranges of sorted ids become pieces of text, and the
    pieces of one sequence pass through one running hash."""
    words = _words()
    whole = turns.groupBy("c").agg(*[F.sum(w).alias(s) for w, s in zip(words, _SUMS)],
                                   F.count(F.lit(1)).alias("len"))
    zero = [F.coalesce(s, F.lit(0).cast("long")).alias(s) for s in [*_SUMS, "len"]]
    keyed = convs.join(whole, "c", "left").select("c", *zero)
    members = stage(keyed.select(_prefix_key(F.col("len"), [F.col(s) for s in _SUMS]).alias("key"), "c", "len"),
                    "trie-members")

    def pieces(batches) -> Iterator:
        import pyarrow as pa
        kinds = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("len", pa.int64()),
                           ("ids", pa.string())])
        key, ids, size, length, out = None, [], 0, 0, []

        def flush():
            if ids:
                out.append({"key": key, "first": ids[0], "n": len(ids), "len": length,
                            "ids": ",".join(map(str, ids))})

        for b in batches:
            for k, c, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if k != key or size >= _CHUNK:
                    flush()
                    key, ids, size, length = k, [], 0, n
                ids.append(c)
                size += 8
            if out:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out.clear()
        flush()
        yield pa.RecordBatch.from_pylist(out, kinds)

    def hashed(batches) -> Iterator:
        import hashlib

        import pyarrow as pa
        kinds = pa.schema([("key", pa.binary()), ("seq", pa.int64()), ("weight", pa.int64()), ("len", pa.int64()),
                           ("ends_sha256", pa.string())])
        now, sha, out = None, None, []

        def close():
            if now is not None:
                out.append({**now, "ends_sha256": sha.hexdigest()})

        for b in batches:
            for r in b.to_pylist():
                if now is None or r["key"] != now["key"]:
                    close()
                    now = {"key": r["key"], "seq": r["first"], "weight": r["n"], "len": r["len"]}
                    sha = hashlib.sha256(r["ids"].encode())
                else:
                    now["weight"] += r["n"]
                    sha.update(b"," + r["ids"].encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out.clear()
        close()
        yield pa.RecordBatch.from_pylist(out, kinds)

    sorted_ids = members.repartitionByRange("key", "c").sortWithinPartitions("key", "c")
    texts = sorted_ids.mapInArrow(pieces, "key binary, first long, n long, len long, ids string")
    ends = (texts.repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(hashed, "key binary, seq long, weight long, len long, ends_sha256 string"))
    return Sequences(members.select("key", "c"), stage(ends, "trie-ends"), turns)


def prefix_rows(s: Sequences) -> DataFrame:
    """One row a turn of every distinct sequence: ``(seq, weight, len, d, bytes, key, up)``
    with the keys of the prefix up to this turn and of the one before it."""
    rows = s.turns.join(s.ends.select(F.col("seq").alias("c"), "weight", "len"), "c")
    words = _words()
    rows = rows.select(F.col("c").alias("seq"), "weight", "len", "d", "bytes",
                       *[w.alias(f"w{k}") for k, w in enumerate(words)])
    sums = running_totals(rows, {s: f"w{k}" for k, s in enumerate(_SUMS)}, ["d"], ["seq"])
    return sums.select("seq", "weight", "len", "d", "bytes",
                       _prefix_key(F.col("d"), [F.col(x) for x in _SUMS]).alias("key"),
                       _prefix_key(F.col("d") - 1, [F.col(x) - F.col(f"w{k}") for k, x in enumerate(_SUMS)]).alias("up"))


def build_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie over conversations ``(c)`` with turns ``(c, d, dig, bytes)``,
    d from 1 without gaps: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``. Without a conversation there is no node."""
    s = collapse(convs, turns)
    rows = stage(prefix_rows(s), "trie-prefixes")
    root_key = _prefix_key(F.lit(0), [F.lit(0)] * 4)
    # The root is a proper prefix of every sequence that has a turn.
    inner = rows.where("d < len").select("key").unionByName(rows.where("d = 1").select(F.col("up").alias("key")))
    leaves = stage(s.ends.join(inner.distinct(), "key", "left_anti").select("seq", F.lit(1).cast("long").alias("leaf")),
                   "trie-leaves")
    marked = rows.join(leaves, "seq", "left")
    nodes = marked.groupBy("key").agg(
        F.min("seq").alias("conv_id"), F.min("d").alias("depth"), F.min("up").alias("up"),
        F.sum("weight").alias("n_convs"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.min("bytes").alias("bytes"))
    root = s.ends.join(leaves, "seq", "left").agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves")).where("n_convs > 0").select(
        root_key.alias("key"), "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("up"), "n_convs", "n_leaves", F.lit(0).cast("long").alias("bytes"))
    nodes = stage(nodes.unionByName(root), "trie-nodes")

    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    placed = rows.select("seq", "d", "key").join(
        nodes.where("depth > 0").select(F.col("conv_id").alias("seq"), F.col("depth").alias("d"), own),
        ["seq", "d"], "left")
    below = running_totals(placed.withColumn("own", F.coalesce("own", F.lit(0))), {"sum": "own"}, [F.desc("d")], ["seq"])
    saved = below.groupBy("key").agg(F.sum("sum").alias("saved_tokens")).unionByName(
        nodes.agg(F.sum(own).alias("saved_tokens")).select(root_key.alias("key"), "saved_tokens"))

    children = nodes.where("depth > 0").groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    # A node with very many children: a hash beside the key gives both sides of the join an
    # exchange of their own, so that adaptive execution can split it.
    parents = nodes.select(F.col("key").alias("up"), F.xxhash64("key").alias("x"), F.col("conv_id").alias("parent_conv_id"))
    out = (nodes.withColumn("x", F.xxhash64("up")).join(parents, ["up", "x"], "left")
           .join(saved, "key", "left").join(children, "key", "left")
           .join(s.ends.select("key", "ends_sha256"), "key", "left"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs",
                      F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
                      F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def conversation_trie(df: DataFrame) -> DataFrame:
    """The contract's rows: conversations rebuilt with shared starts, then their trie.

    Null roles and texts are empty; turns stand in order of ``turn``, null first, ties by
    role and then by digest; repeated rows are turns of their own; rows whose ``conv_id`` is
    null belong to no conversation. An empty table has no nodes; other columns are not read.
    """
    turns = stage(numbered_turns(df), "trie-turns")
    convs, rebuilt = shared_starts(turns)
    return build_trie(convs, rebuilt)
