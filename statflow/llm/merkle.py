"""Operator 11: Merkle manifest of a dataset, leaf places by bitmap rank.

Every row is a leaf (SHA-256 over its fields); within a group the leaves stand in order of
their ids, and every 8 consecutive nodes become one until a group's subroot is left; the
subroots, in order of their groups, become the root in the same way.

No leaf is sorted into place. Map tasks turn the ids they see into compressed bitmaps, one
for each (group, range of 4,096 ids); the bitmaps of a range are merged and get a popcount
directory; running totals over the ranges (one row a range) give each range the number of
leaves before it. A row's slot is then that number plus a rank query on its range's bitmap.
Slots are dealt to keyed arrays of 512 (three levels of 8), each reduced at once to the node
that takes part in the next round; the same arrays, read top down, give every leaf its
siblings on the way to the root.

Repeated rows are counted, not listed, until their slots are known. Several different rows
with one id (null counts as an id, before all others) stand in order of their leaves; these
rows alone are placed by a running total. So no group, id or row is ever gathered in a task:
a task holds 4,096 ids or 512 nodes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import names, stage
from statflow.operators.ordering import global_rank, running_total

FAN = 8
ROUND_LEVELS = 3
RANGE_BITS = 12
_NULL_RANGE = -(1 << (63 - RANGE_BITS)) - 1  # before the range of the smallest id
_SPARSE = 200  # ids a range, up to which a list is shorter than the bitmap


# ---------------------------------------------------------------- leaves


def field_text(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Binary SHA-256 over the fields' texts."""
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]).cast("binary"), 256))


def node_hash(children: Sequence[bytes]) -> bytes:
    """SHA-256 over the children's hex digests."""
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


# ---------------------------------------------------------------- bitmaps with rank


class RankBitmap:
    """A set of small integers (below 2**RANGE_BITS) with rank queries: a bitmap of 64-bit
    words and the running popcount before each word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.size = int(counts.sum())

    @classmethod
    def of(cls, values: np.ndarray) -> RankBitmap:
        words = np.zeros((1 << RANGE_BITS) // 64, np.uint64)
        v = values.astype(np.int64)
        np.bitwise_or.at(words, v >> 6, np.uint64(1) << (v & 63).astype(np.uint64))
        return cls(words)

    def rank(self, values: np.ndarray) -> np.ndarray:
        """How many members are smaller than each value."""
        v = values.astype(np.int64)
        below = (np.uint64(1) << (v & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[v >> 6] + np.bitwise_count(self.words[v >> 6] & below).astype(np.int64)

    def members(self) -> np.ndarray:
        bits = np.unpackbits(self.words.view(np.uint8), bitorder="little")
        return np.flatnonzero(bits).astype(np.uint16)

    def pack(self) -> bytes:
        """Members as 16-bit numbers if there are few, else the words."""
        return self.members().tobytes() if self.size <= _SPARSE else self.words.tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> RankBitmap:
        if len(raw) == (1 << RANGE_BITS) // 8:
            return cls(np.frombuffer(raw, np.uint64))
        return cls.of(np.frombuffer(raw, np.uint16))


_CONTAINER = "gid long, range long, bits binary, many binary, counts array<long>, crowded binary, n long"


def _container(gid: int, rng: int, los: np.ndarray, m: np.ndarray, crowded: np.ndarray) -> dict:
    """One range: its ids, the ids with more than one leaf and their counts, and the ids
    whose leaves differ."""
    many = m > 1
    return {"gid": gid, "range": rng, "bits": RankBitmap.of(los).pack(),
            "many": los[many].astype(np.uint16).tobytes(), "counts": m[many].tolist(),
            "crowded": crowded.astype(np.uint16).tobytes(), "n": int(m.sum())}


def _merged(los: np.ndarray, m: np.ndarray, crowded: np.ndarray):
    ids, at, times = np.unique(los, return_inverse=True, return_counts=True)
    total = np.bincount(at, weights=m, minlength=len(ids)).astype(np.int64)
    return ids, total, np.union1d(ids[times > 1], crowded)


def _unpacked(row: dict):
    los = RankBitmap.unpack(row["bits"]).members()
    m = np.ones(len(los), np.int64)
    m[np.searchsorted(los, np.frombuffer(row["many"], np.uint16))] = row["counts"]
    return los, m, np.frombuffer(row["crowded"], np.uint16)


def id_ranges(rows: DataFrame) -> DataFrame:
    """``(gid, range, ..., n, base)`` from distinct rows ``(gid, range, lo, m)``: bitmaps
    made in the map tasks, merged by range, and the leaves of the group before each range."""
    def arrow(rows):
        import pyarrow as pa
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("gid", pa.int64()), ("range", pa.int64()), ("bits", pa.binary()), ("many", pa.binary()),
            ("counts", pa.list_(pa.int64())), ("crowded", pa.binary()), ("n", pa.int64())]))

    def build(batches) -> Iterator:
        for b in batches:
            gid, rng, lo, m = (b.column(k).to_numpy() for k in range(4))
            order = np.lexsort((rng, gid))
            g, r = gid[order], rng[order]
            cut = np.flatnonzero((g[1:] != g[:-1]) | (r[1:] != r[:-1])) + 1
            out = []
            for part in np.split(order, cut):
                if len(part):
                    ids, total, crowded = _merged(lo[part], m[part], np.zeros(0, np.uint16))
                    out.append(_container(int(gid[part[0]]), int(rng[part[0]]), ids, total, crowded))
            if out:
                yield arrow(out)

    def merge(key, parts):
        import pyarrow as pa
        los, m, crowded = zip(*[_unpacked(p) for p in parts.to_pylist()])
        one = _merged(np.concatenate(los), np.concatenate(m), np.concatenate(crowded))
        return pa.Table.from_batches([arrow([_container(key[0].as_py(), key[1].as_py(), *one)])])

    partial = rows.select("gid", "range", "lo", "m").mapInArrow(build, _CONTAINER)
    ranges = partial.groupBy("gid", "range").applyInArrow(merge, _CONTAINER)
    return running_total(ranges, "n", ["range"], "upto", ["gid"]).withColumn(
        "base", F.col("upto") - F.col("n")).drop("upto")


def _place(rows, ranges, pa, leaf_cols):
    """Slots of the rows of one range."""
    r = ranges.to_pylist()[0]
    los, m, _ = _unpacked(r)
    lo = rows.column("lo").to_numpy()
    before = np.cumsum(m) - m  # leaves of smaller ids, where some ids have several
    rank = RankBitmap.unpack(r["bits"]).rank(lo)
    slot = r["base"] + before[rank]
    return pa.Table.from_arrays([*(rows.column(c) for c in leaf_cols), pa.array(slot, pa.int64())],
                                [*leaf_cols, "slot"])


# ---------------------------------------------------------------- levels


def _levels(nodes: list[bytes], n: int) -> tuple[list[list[bytes]], int]:
    """The levels above an aligned array of nodes, up to ROUND_LEVELS, of a tree that has
    ``n`` nodes on this level; and how many nodes the tree has above them."""
    levels = [nodes]
    while len(levels) <= ROUND_LEVELS and n > 1:
        below = levels[-1]
        levels.append([node_hash(below[i:i + FAN]) for i in range(0, len(below), FAN)])
        n = -(-n // FAN)
    return levels, n


def _slot_array(table, width: int) -> tuple[list[int], list[bytes], int]:
    """Row order, digests by slot and tree size of one keyed slot array, which must be whole."""
    slots = table.column("slot").to_numpy()
    order, n = np.argsort(slots), int(table.column("n")[0].as_py())
    begin = int(slots[order[0]])
    if begin % width or not np.array_equal(slots[order], np.arange(begin, min(begin + width, n))):
        raise RuntimeError(f"slots {slots.min()} to {slots.max()} are not a whole array of {n}")
    h = table.column("h").to_pylist()
    return order.tolist(), [h[i] for i in order], n


_NODE = "key long, n long, slot long, h binary"
_WIDTH = FAN ** ROUND_LEVELS


def _next_round(nodes: DataFrame) -> DataFrame:
    """Each slot array to its one node of the next round."""
    def reduce(key, table):
        import pyarrow as pa
        _, h, n = _slot_array(table, _WIDTH)
        levels, n = _levels(h, n)
        assert len(levels[-1]) == 1
        return pa.table({"key": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([n], pa.int64()),
                         "slot": pa.array([key[1].as_py()], pa.int64()), "h": pa.array([levels[-1][0]], pa.binary())})

    dealt = nodes.select("key", F.floor(F.col("slot") / _WIDTH).alias("at"), "n", "slot", "h")
    return dealt.groupBy("key", "at").applyInArrow(reduce, _NODE)


def _rounds(nodes: DataFrame, largest: int, what: str) -> list[DataFrame]:
    """Node tables of every round, the last one with a single node a key."""
    tables = [nodes]
    while largest > 1 or len(tables) == 1:
        tables.append(stage(_next_round(tables[-1]), f"{what}-{len(tables)}"))
        largest = -(-largest // _WIDTH)
    return tables


def _siblings(levels: list[list[bytes]], k: int) -> list[tuple[list[bytes], list[bytes]]]:
    """Left and right siblings of node ``k`` of the lowest level, level by level."""
    out = []
    for level in levels[:-1]:
        first = k - k % FAN
        out.append((level[first:k], level[k + 1:first + FAN]))
        k //= FAN
    return out


def pack_path(path: Sequence[tuple[Sequence[bytes], Sequence[bytes]]]) -> bytes:
    return b"".join(bytes([len(a), len(b)]) + b"".join(a) + b"".join(b) for a, b in path)


def unpack_path(raw: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(raw):
        a, b = raw[at], raw[at + 1]
        d = [raw[at + 2 + 32 * i:at + 34 + 32 * i] for i in range(a + b)]
        out.append((d[:a], d[a:]))
        at += 2 + 32 * (a + b)
    return out


def fold(digest: bytes, path: Sequence[tuple[Sequence[bytes], Sequence[bytes]]]) -> bytes:
    """The root that a leaf and its siblings come to."""
    for left, right in path:
        digest = node_hash([*left, digest, *right])
    return digest


def _paths_down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``(key, slot, h, path, subroot)`` of a round's nodes from those one round above."""
    def down(key, table, parents):
        import pyarrow as pa
        order, h, n = _slot_array(table, _WIDTH)
        levels, _ = _levels(h, n)
        up = parents.to_pylist()[0]
        rows = range(len(h))
        return pa.table({
            "key": pa.array([key[0].as_py()] * len(h), pa.int64()),
            "slot": pa.array([table.column("slot")[order[k]].as_py() for k in rows], pa.int64()),
            "h": pa.array(h, pa.binary()),
            "path": pa.array([pack_path(_siblings(levels, k)) + up["path"] for k in rows], pa.binary()),
            "subroot": pa.array([up["subroot"] or x for x in h], pa.binary())})

    dealt = nodes.select("key", F.floor(F.col("slot") / _WIDTH).alias("at"), "n", "slot", "h")
    up = above.select("key", F.col("slot").alias("at"), "path", "subroot")
    return dealt.groupBy("key", "at").cogroup(up.groupBy("key", "at")).applyInArrow(
        down, "key long, slot long, h binary, path binary, subroot binary")


# ---------------------------------------------------------------- the manifest


@dataclass
class Manifest:
    """``leaves``: ``key, n, slot, id, h, claim`` (``key`` numbers the groups in their order,
    ``claim``: another digest shown for this leaf, or null); ``groups``: ``grp, key, n``;
    ``rounds``: node tables ``key, n, slot, h``, every third level of the groups' trees;
    ``paths``: ``key, slot, path, subroot`` of the nodes right above the leaves' arrays;
    ``root``: None if there are no rows."""

    leaves: DataFrame
    groups: DataFrame
    rounds: list[DataFrame]
    paths: DataFrame | None
    root: bytes | None


def _expanded(rows: DataFrame) -> DataFrame:
    """Counted rows one by one: of ``m`` equal rows each takes one of the slots from
    ``slot`` on. Large counts are first cut into runs, dealt over the tasks."""
    single = rows.where("m = 1").drop("m")
    runs = rows.where("m > 1").withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1,
                                                                      F.lit(_WIDTH).cast("long"))))
    many = (runs.repartition("key", F.col("slot") + F.col("run"))
            .withColumn("k", F.explode(F.sequence(F.col("run"), F.least("m", F.col("run") + _WIDTH) - 1)))
            .withColumn("slot", F.col("slot") + F.col("k")))
    return single.unionByName(many.select(*single.columns))


def build_manifest(df: DataFrame, fields: Sequence[str], id: str = "doc_id", group: str = "lang",
                   claim: Column | None = None) -> Manifest:
    """The manifest of all rows of ``df``: leaves over ``fields``, ordered by ``id`` (an
    integer column; null first) within ``group`` (null first, then by UTF-8 bytes).

    Repeated rows are leaves of their own; different rows with one id stand in order of
    their digests. An empty table has no root. Other columns are not read.
    """
    names(df, [*fields, id, group])
    columns = [F.col(group).cast("string").alias("grp"), F.col(id).cast("long").alias("id"),
               leaf_hash([F.col(c) for c in fields]).alias("h"),
               (F.lit(None).cast("binary") if claim is None else claim).alias("claim")]
    counted = stage(df.select(*columns).groupBy("grp", "id", "h", "claim")
                    .agg(F.count(F.lit(1)).alias("m")), "merkle-rows")
    sizes = counted.groupBy("grp").agg(F.sum("m").alias("n"))
    groups = stage(global_rank(sizes, ["grp"], "key").select(
        "grp", (F.col("key") - 1).cast("long").alias("key"), "n"), "merkle-groups")
    total = groups.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("g")).first()
    placed_by = F.coalesce(F.shiftright("id", RANGE_BITS), F.lit(_NULL_RANGE))
    lo = F.coalesce(F.col("id").bitwiseAND((1 << RANGE_BITS) - 1), F.lit(0)).cast("int")
    of_group = groups.withColumnRenamed("grp", "g")
    rows = counted.join(of_group, counted["grp"].eqNullSafe(of_group["g"])).select(
        "key", "n", "id", "h", "claim", "m", placed_by.alias("range"), lo.alias("lo"))
    cols = ["key", "n", "id", "h", "claim", "m"]
    if not total["g"]:
        empty = rows.withColumn("slot", F.lit(0).cast("long")).drop("m", "range", "lo")
        return Manifest(empty, groups, [], None, None)

    ranges = stage(id_ranges(rows.withColumnRenamed("key", "gid")), "merkle-ranges")
    crowded = ranges.where(F.length("crowded") > 0)
    apart = None
    if not crowded.isEmpty():
        rows, apart = _crowded(rows, crowded, cols)

    def place(key, left, right):
        import pyarrow as pa
        if not left.num_rows:
            return pa.table({c: left.column(c) for c in cols} | {"slot": pa.array([], pa.int64())})
        return _place(left, right, pa, cols)

    kinds = "key long, n long, id long, h binary, claim binary, m long, slot long"
    placed = rows.groupBy("key", "range").cogroup(
        ranges.withColumnRenamed("gid", "key").groupBy("key", "range")).applyInArrow(place, kinds)
    if apart is not None:
        placed = placed.unionByName(apart)
    leaves = stage(_expanded(placed), "merkle-leaves")

    rounds = _rounds(leaves.select("key", "n", "slot", "h"), total["n"], "merkle-round")
    tops = rounds[-1].select(F.lit(0).cast("long").alias("key"), F.lit(total["g"]).cast("long").alias("n"),
                             F.col("key").alias("slot"), "h")
    top_rounds = _rounds(tops, total["g"], "merkle-top")
    root = bytes(top_rounds[-1].first()["h"])
    none = F.lit(None).cast("binary")
    down = top_rounds[-1].select("key", "slot", F.lit(b"").alias("path"), none.alias("subroot"))
    for nodes in reversed(top_rounds[:-1]):
        down = _paths_down(nodes, down.withColumn("subroot", none))
    down = down.select(F.col("slot").alias("key"), F.lit(0).cast("long").alias("slot"), "path",
                       F.col("h").alias("subroot"))
    for nodes in reversed(rounds[1:-1]):
        down = _paths_down(nodes, down)
    return Manifest(leaves, groups, rounds, stage(down.select("key", "slot", "path", "subroot"), "merkle-paths"), root)


def _crowded(rows: DataFrame, ranges: DataFrame, cols: Sequence[str]):
    """Rows whose ids have one leaf only, and the others with their slots: the first slot
    of the id and a running total over its leaves."""
    def ids(batches) -> Iterator:
        import pyarrow as pa
        for b in batches:
            out = []
            for r in b.to_pylist():
                los, m, crowded = _unpacked(r)
                first = r["base"] + (np.cumsum(m) - m)[np.searchsorted(los, crowded)]
                null = r["range"] == _NULL_RANGE
                out += [{"k": r["gid"], "i": None if null else (r["range"] << RANGE_BITS) + int(lo), "first": int(f)}
                        for lo, f in zip(crowded, first)]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("k", pa.int64()), ("i", pa.int64()), ("first", pa.int64())]))

    found = stage(ranges.mapInArrow(ids, "k long, i long, first long"), "merkle-crowded")
    same = (rows["key"] == found["k"]) & rows["id"].eqNullSafe(found["i"])
    apart = running_total(rows.join(found, same).drop("k", "i"), "m", ["h", "claim"], "upto", ["key", "id"])
    apart = apart.select(*cols, (F.col("first") + F.col("upto") - F.col("m")).alias("slot"))
    return rows.join(found, same, "left_anti"), apart


def _leaf_results(m: Manifest, result, schema: str) -> DataFrame:
    """``result(id, leaf, claim, path, subroot, upper)`` of every leaf, an array at a time."""
    def run(key, table, parents):
        import pyarrow as pa
        order, h, n = _slot_array(table, _WIDTH)
        levels, _ = _levels(h, n)
        up = parents.to_pylist()[0]
        upper = unpack_path(up["path"])
        id_, claim = table.column("id").to_pylist(), table.column("claim").to_pylist()
        rows = [result(id_[i], h[k], claim[i], _siblings(levels, k) + upper, up["subroot"] or h[k])
                for k, i in enumerate(order)]
        return pa.Table.from_pylist(rows, kinds)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    leaves = m.leaves.withColumn("at", F.floor(F.col("slot") / _WIDTH))
    up = m.paths.withColumnRenamed("slot", "at")
    return leaves.groupBy("key", "at").cogroup(up.groupBy("key", "at")).applyInArrow(run, schema)


def proofs(m: Manifest) -> DataFrame:
    """``(id, leaf, subroot, path)``: each leaf's siblings to its left and right, level by
    level up to the root, as hex digests."""
    schema = "id long, leaf string, subroot string, path array<struct<left: array<string>, right: array<string>>>"
    if m.root is None:
        return m.leaves.sparkSession.createDataFrame([], schema)

    def result(id, leaf, claim, path, subroot):
        return {"id": id, "leaf": leaf.hex(), "subroot": subroot.hex(), "path": [
            {"left": [x.hex() for x in a], "right": [x.hex() for x in b]} for a, b in path]}

    return _leaf_results(m, result, schema)


def verify(m: Manifest) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)``: the digest that is
    claimed for each leaf (its own without a claim), folded with the leaf's siblings."""
    schema = ("id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    if m.root is None:
        return m.leaves.sparkSession.createDataFrame([], schema)
    root = m.root

    def result(id, leaf, claim, path, subroot):
        folded = fold(leaf if claim is None else claim, path)
        return {"id": id, "leaf": leaf.hex(), "subroot": subroot.hex(), "root": root.hex(),
                "proof_sha256": node_hash([x for a, b in path for x in (*a, *b)]).hex(),
                "folded_root": folded.hex(), "verified": folded == root}

    return _leaf_results(m, result, schema)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_digest(df: DataFrame) -> DataFrame:
    """The contract's rows: documents whose id's crc32 three divides are shown with A-Z of
    their text lower-cased (documents without an id as they are)."""
    lowered = [F.translate(F.col(c).cast("string"), _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS]
    shown = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    m = build_manifest(df, FIELDS, claim=F.when(shown, leaf_hash(lowered)))
    return verify(m).withColumnRenamed("id", "doc_id")
