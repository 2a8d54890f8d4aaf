"""Operator 1: shards from a hierarchical weighted hash tree.

The tree has three levels: regions hold racks, racks hold weighted shards, and a
node weighs what its shards weigh together. A row descends from the root: at
each level every child draws ``-ln(u) / weight`` with ``u`` hashed from the row's
key and the child's name, and the smallest draw wins, so a child is chosen with
probability proportional to its weight.

A draw depends on nothing but the key, the child's name and the child's weight.
So when a weight changes, draws change only on the path from that shard to the
root: rows move into or out of the subtrees on that path, and all choices
elsewhere stay as they were. A shard that is added as a region of its own
(``with_shard``) changes no other subtree at all: rows move only into it.

Everything is DataFrame expressions; no row leaves its partition to be placed.
Slots (gapless positions in each shard) need counts only: rows fall into
``buckets`` ranges of a hash, a table of shards x buckets counts (bounded, so it
is broadcast) gives each range its offset, and only digests are shuffled.

Defined cases: a null key is a key of its own; rows with equal keys go to the
same shard; repeated rows keep their number and get different slots; an empty
table gives an empty result; extra columns are ignored by the query's digest and
kept by ``place``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import hash52, names, null_safe_text

Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

SLOT_BUCKETS = 4096


def uniform_tree(n_shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """Shards 0..n-1 of weight 1, ``per_rack`` to a rack and ``racks`` to a region."""
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for s in range(n_shards):
        rack = s // per_rack
        tree.setdefault(f"g{rack // racks}", {}).setdefault(f"r{rack}", {})[s] = 1.0
    return tree


def with_shard(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, alone in a new rack of a new region."""
    return {**tree, f"g+{shard}": {f"r+{shard}": {shard: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, Mapping) else float(node)


def _draw(key: Column, level: str, name, weight: float) -> Column:
    u = (hash52(key, level, name) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(weight)


def _choose(key: Column, level: str, nodes: Mapping) -> Column:
    """The index of the winning child; equal draws go to the first."""
    live = [(i, k, _weight(v)) for i, (k, v) in enumerate(nodes.items()) if _weight(v) > 0]
    if not live:
        raise ValueError("a subtree needs a positive weight")
    if len(live) == 1:
        return F.lit(live[0][0])
    best = F.array_min(F.array(*[
        F.struct(_draw(key, level, k, w).alias("d"), F.lit(i).alias("i")) for i, k, w in live
    ]))["i"]
    # Never null, and known to be: no null filters that repeat the draws are inferred.
    return F.coalesce(best, F.lit(live[0][0]))


def _descend(df: DataFrame, key: Column, tree: Tree, out: str) -> DataFrame:
    """Each level is a column of its own, so a level's draws are made once."""
    region, rack = f"__{out}_region", f"__{out}_rack"
    regions = list(tree.items())
    df = df.withColumn(region, _choose(key, "region", tree))

    def per(pairs, col, value):
        chain = value(pairs[-1][1])
        for i, node in reversed(pairs[:-1]):
            chain = F.when(F.col(col) == F.lit(i), value(node)).otherwise(chain)
        return chain

    racks = [(i, r) for i, (_, r) in enumerate(regions) if _weight(r) > 0]
    df = df.withColumn(rack, per(racks, region, lambda r: _choose(key, "rack", r)))
    pairs = [(i * 65536 + j, s) for i, r in racks for j, (_, s) in enumerate(r.items())
             if _weight(s) > 0]
    at = f"__{out}_at"

    def leaf(shards):
        ids = list(shards)
        return F.coalesce(F.get(F.array(*[F.lit(int(x)) for x in ids]),
                                _choose(key, "shard", shards)), F.lit(int(ids[0])))

    return (df.withColumn(at, F.col(region) * 65536 + F.col(rack))
            .withColumn(out, per(pairs, at, leaf)).drop(region, rack, at))


def place(df: DataFrame, key: str, tree: Tree, out: str = "shard") -> DataFrame:
    """``df`` plus the shard of each row; no shuffle, other columns untouched."""
    names(df, [key])
    return _descend(df, F.col(key), tree, out)


def number_slots(df: DataFrame, shard: str, key: str, identity: list[str],
                 out: str = "slot", buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Gapless positions from 0 in each shard, in order of the key's hash.

    ``df`` is reduced to ``shard``, ``key`` and ``identity`` columns; rows equal
    in all of them are counted first and get a run of slots.
    """
    cols = list(dict.fromkeys([shard, key, *identity]))
    counted = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__h", hash52(F.col(key), "slot"))
               .withColumn("__b", F.floor(F.col("__h") / F.lit((1 << 52) // buckets))))
    sizes = counted.groupBy(shard, "__b").agg(F.sum("__n").alias("__t"))
    before = Window.partitionBy(shard).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "__b",
                           F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o"))
    inside = (Window.partitionBy(shard, "__b").orderBy("__h", key, *identity)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (counted.withColumn("__e", F.sum("__n").over(inside))
              .join(F.broadcast(offsets), [shard, "__b"]))
    start = F.col("__o") + F.col("__e") - F.col("__n")
    return placed.select(*cols, F.explode(F.sequence(start, start + F.col("__n") - 1)).alias(out))


def shard_digest(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """The sharding of a documents table and of the same table with one more shard."""
    names(docs, ["doc_id", "text"])
    text = null_safe_text(F.col("text"))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    tree = uniform_tree(n_shards)
    slotted = number_slots(place(rows, "doc_id", tree), "shard", "doc_id",
                           ["size", "text_crc32"])
    return place(slotted, "doc_id", with_shard(tree, n_shards), "grown_shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        "grown_shard")
