"""Operator 8: n-gram Jaccard self-join by a MinHash LSH forest.

Documents are sets of word 5-grams (words: lower-cased A-Z, split at ASCII white
space; a text of 1 to 4 words is one shorter n-gram). Two different texts are linked
when the Jaccard similarity of their sets is at least 0.8; equal texts are copies.

Forest: a pool of ``POOL`` min-hashes for each text is its signature; each of
``TREES`` prefix tries orders its own selection of the pool into a path of labels.
Texts with equal signatures lie in one leaf of every trie, so they meet the same texts
everywhere: a leaf's smallest node stands for it, the others connect to that one.

Depth: the matched prefix of a text starts at the whole path and is shortened label
by label until the expected recall of its least similar possible partner reaches the
target (``text_depth``). That partner's similarity depends on the text's number of
n-grams: a set of 6 has none between 0.8 and 5/6, one of 3 none but equal sets. The
recall is averaged over the number of equal min-hashes, as the selections overlap.
Two texts meet in a trie when they share the shorter of their two prefixes.

A trie is sorted by path (hash of the prefix that all texts must share, then the labels
below it); a node is a run of rows whose neighbours share its prefix, and runs are
matched by falling depth. Only prefixes with two leaves or more are sorted.

1. Copies become one node: counts and smallest doc_id by the text's hash.
2. In each run of a trie, pairs whose pools agree in 60 % (a pair at 0.8 falls below that
   once in 10^7) connect; a task gives back one row a member, its smallest connected
   partner, not the pairs. Components of these rows are groups of possible partners;
   chance meetings, such as texts that share a passage only, end here.
3. In each group every pair is verified exactly on whole n-gram sets, by counting
   common n-grams (a matrix product over the group). A task returns each text's links
   and smallest linked text. Components of these are the classes.

Large nodes and groups are cut into chunks, and a cell for each pair of chunks is a
unit of work of its own: nothing is collected whole, no pair list is emitted, and no
partner is dropped.

Defined cases: null text is empty text; texts without a word have no n-grams and are
linked to their copies only; null doc_ids sort last and give a null class id only in
classes without any id; repeated rows count as copies; an empty table gives an empty
result; whole texts are read; extra columns are ignored. Node ids are 64-bit hashes
of the text.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import WordHasher, mix64, names, null_safe_text, stage, text_buffer
from statflow.llm.components import components, least_linked

NGRAM = 5
THRESHOLD = (4, 5)  # Jaccard similarity as a fraction
POOL, TREES, MAX_DEPTH, TARGET_RECALL = 128, 32, 12, 0.999
SKETCH_SHARE = 0.6
SMALL_SET = 64            # from so many n-grams on a text's depth is that of the threshold
CHUNK = 256               # texts of a node or group in one chunk
CHUNK_BYTES = 2 << 20     # text bytes of a group in one chunk
_LAST = (1 << 63) - 1     # stands for a null doc_id while smallest ids are sought


def recall(similarity: float, depth: int, trees: int = TREES, pool: int = POOL) -> float:
    """Chance that two texts share the first ``depth`` labels of one of the tries."""
    out = 0.0
    for a in range(pool + 1):
        p = comb(pool, a) * similarity ** a * (1 - similarity) ** (pool - a)
        out += p * (1 - (1 - comb(a, depth) / comb(pool, depth)) ** trees)
    return out


def least_similarity(size: int, num: int, den: int) -> float:
    """The least similarity, ``num / den`` or more, that a set of ``size`` can have."""
    unions = range(size, size * den // num + 1)
    common = [-(-num * u // den) for u in unions]
    return min(i / u for i, u in zip(common, unions) if i <= size)


@lru_cache
def depth_for(similarity: float, target: float, trees: int = TREES, pool: int = POOL) -> int:
    depth = MAX_DEPTH
    while depth > 1 and recall(similarity, depth, trees, pool) < target:
        depth -= 1
    return depth


@lru_cache
def depths_by_size(num: int, den: int, target: float) -> np.ndarray:
    """Prefix length of texts of 1, 2, ... n-grams; the last entry (the shortest) is for
    all larger ones, whose least similarity is as good as the threshold."""
    some = [depth_for(least_similarity(m, num, den), target) for m in range(1, SMALL_SET)]
    return np.array([MAX_DEPTH, *some, depth_for(num / den, target)], np.int8)


def text_depth(hashes: np.ndarray, bounds: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The prefix length of each row: by its number of distinct n-grams."""
    size = np.minimum(np.diff(bounds), len(depths) - 1)
    for k in np.flatnonzero(size < len(depths) - 1):
        size[k] = len(np.unique(hashes[bounds[k]:bounds[k + 1]]))
    return depths[size]


def ngram_hashes(words: np.ndarray, bounds: np.ndarray, n: int = NGRAM):
    """``(hashes, bounds)`` of the n-grams of each row, in order, with repeats."""
    size = np.diff(bounds)
    made = np.where(size >= n, size - n + 1, (size > 0).astype(size.dtype))
    out_bounds = np.r_[0, np.cumsum(made)]
    start = np.repeat(bounds[:-1] - out_bounds[:-1], made) + np.arange(out_bounds[-1])
    last = np.repeat(bounds[1:], made) - 1
    h = np.zeros(len(start), np.uint64)
    padded = np.r_[words, np.zeros(n, np.uint64)]
    with np.errstate(over="ignore"):
        for k in range(n):
            w = np.where(start + k <= last, padded[start + k], np.uint64(k + 1))
            h = h * np.uint64(0x9DDFEA08EB382D69) + w
    return mix64(h), out_bounds


@lru_cache
def _family():
    rng = np.random.default_rng(20_240_501)
    a = rng.integers(0, 1 << 31, POOL, np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, POOL, np.uint32)
    picks = np.stack([rng.permutation(POOL)[:MAX_DEPTH] for _ in range(TREES)])
    return a, b, picks


def min_hashes(hashes: np.ndarray, bounds: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """Pool of min-hashes (rows x POOL) of rows that all have an n-gram at least."""
    a, b, _ = _family()
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    n = len(bounds) - 1
    out = np.empty((n, POOL), np.uint32)
    i = 0
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + piece, "right")) - 1
        j = min(max(j, i + 1), n)
        some, first = x[bounds[i]:bounds[j]], bounds[i:j] - bounds[i]
        work = np.empty_like(some)
        for k in range(POOL):
            np.bitwise_xor(some, b[k], out=work)
            np.multiply(work, a[k], out=work)
            out[i:j, k] = np.minimum.reduceat(work, first)
        i = j
    return out


def trie_paths(pool: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's path in each trie (rows x TREES): a 64-bit hash of the first ``depth``
    labels and, one byte a label in order, the labels below them."""
    picks = _family()[2]
    key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), (len(pool), TREES))
    path = np.zeros((len(pool), TREES), np.int64)
    labels = short_labels(pool)
    with np.errstate(over="ignore"):
        for d in range(depth):
            key = mix64(key * np.uint64(0x9DDFEA08EB382D69) + pool[:, picks[:, d]])
    for d in range(depth, MAX_DEPTH):
        path = path << 8 | labels[:, picks[:, d]]
    return key, path


def short_labels(pool: np.ndarray) -> np.ndarray:
    """One byte of each min-hash; mixed, as the leading bits of minima are mostly zero."""
    return ((pool * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _text_node(text):
    return F.xxhash64(text)


def _signatures(texts: DataFrame, depths: np.ndarray) -> DataFrame:
    """``node, depth, paths, sketch`` of ``(node, text)`` rows: the prefix length, one
    ``(key, path)`` a trie and the signature; texts without words give none."""
    shared = int(depths.min())

    def run(batches):
        import pyarrow as pa
        hasher = WordHasher()
        for batch in batches:
            # Copies in one batch are signed once.
            node, at = np.unique(batch.column("node").to_numpy(), return_index=True)
            raw, offsets = text_buffer(batch.column("text").take(pa.array(at)))
            i, n = 0, len(node)
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + (2 << 20), "right")) - 1
                j = min(max(j, i + 1), n)
                words, bounds = hasher(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                grams, bounds = ngram_hashes(words, bounds)
                has = np.flatnonzero(np.diff(bounds))
                if len(has):
                    bounds = np.r_[bounds[has], bounds[-1]]
                    pool = min_hashes(grams, bounds)
                    keys, paths = trie_paths(pool, shared)
                    lists = np.arange(len(has) + 1, dtype=np.int32) * TREES
                    places = pa.StructArray.from_arrays(
                        [pa.array(keys.astype(np.int64).ravel()), pa.array(paths.ravel())],
                        names=["key", "path"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[i:j][has]),
                         pa.array(text_depth(grams, bounds, depths)),
                         pa.ListArray.from_arrays(pa.array(lists), places),
                         pa.array([r.tobytes() for r in short_labels(pool)], pa.binary())],
                        names=["node", "depth", "paths", "sketch"])
                i = j

    kind = "node long, depth byte, paths array<struct<key:long,path:long>>, sketch binary"
    return texts.mapInArrow(run, kind)


def _whole_groups(batches, key_cols):
    """Sorted batches cut so that each piece holds whole groups."""
    import pyarrow as pa
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        if t.num_rows == 0:
            continue
        first = _group_starts(t, key_cols)
        if first[-1] > 0:
            yield t.slice(0, int(first[-1])), first[:-1]
        rest = t.slice(int(first[-1]))
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(1, np.int64)


def _group_starts(t, key_cols) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in key_cols:
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def trie_pairs(first: np.ndarray, path: np.ndarray, depth: np.ndarray, shared: int, most: int):
    """Pairs of row numbers that meet, in slices of about ``most``. Rows are sorted by
    group (the starts ``first``), then path; rows of a group share ``shared`` labels.

    By falling depth: at each, the rows whose prefix ends there meet all rows of their
    run with a prefix as long or longer; a pair is met once, at the shorter prefix."""
    n = len(path)
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n]))
    for level in np.unique(depth)[::-1].tolist():
        rows = np.flatnonzero(depth >= level)
        prefix = path[rows] >> 8 * (MAX_DEPTH - max(level, shared))
        new = np.r_[True, (group[rows[1:]] != group[rows[:-1]]) | (prefix[1:] != prefix[:-1])]
        run = np.cumsum(new) - 1
        ends_here = depth[rows] == level
        rows = rows[np.lexsort((~ends_here, run))]  # in each run first those that end here
        start = np.flatnonzero(new)
        size = np.diff(np.r_[start, len(rows)])
        later = np.repeat(start + size, size) - 1 - np.arange(len(rows))
        after = np.where(depth[rows] == level, later, 0)
        ends = np.cumsum(after)
        i = 0
        while i < len(rows):
            j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right"))
            j = min(max(j, i + 1), len(rows))
            a = np.repeat(np.arange(i, j), after[i:j])
            begin = np.cumsum(after[i:j]) - after[i:j]
            b = a + 1 + np.arange(len(a)) - np.repeat(begin, after[i:j])
            yield rows[a], rows[b]
            i = j


def _cells(df: DataFrame, chunks, node: str = "node") -> DataFrame:
    """Each row once for every cell (pair of chunks) that its chunk belongs to."""
    mine = F.pmod(F.xxhash64(F.col(node), F.lit(7)), chunks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
    return (df.withColumn("side", mine.cast("long")).withColumn("__o", other)
            .withColumn("cell_a", F.least("side", "__o"))
            .withColumn("cell_b", F.greatest("side", "__o")).drop("__o"))


def _candidate_edges(members: DataFrame, shared: int) -> DataFrame:
    """``u, v``: each member of a trie node and its smallest connected partner there."""
    need = int(np.ceil(POOL * SKETCH_SHARE))
    key = ["key", "cell_a", "cell_b"]

    def run(batches):
        import pyarrow as pa
        for t, first in _whole_groups(batches, key):
            n = t.num_rows
            node = t.column("node").to_numpy()
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8)
            sketch = sketch.reshape(n, POOL)
            side = t.column("side").to_numpy()
            cross = t.column("cell_a").to_numpy() != t.column("cell_b").to_numpy()
            path, depth = t.column("path").to_numpy(), t.column("depth").to_numpy()
            hits = []
            for a, b in trie_pairs(first, path, depth, shared, 1 << 16):
                keep = ~cross[a] | (side[a] != side[b])
                a, b = a[keep], b[keep]
                same = (sketch[a] == sketch[b]).sum(1) >= need
                hits.append((a[same], b[same]))
            a, b = (np.concatenate(x) for x in zip(*hits))
            least = least_linked(n, a, b)
            moved = least != np.arange(n)
            edges = np.unique(np.stack([node[moved], node[least[moved]]], 1), axis=0)
            edges = edges[edges[:, 0] != edges[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])],
                                             names=["u", "v"])

    return (members.repartition(*key).sortWithinPartitions(*key, "path", "node")
            .mapInArrow(run, "u long, v long"))


def common_counts(sets: list[np.ndarray], block: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays."""
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((m, m), np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    off = np.zeros((m, m))
    for lo in range(0, int(shared.sum()), block):
        i, j = np.searchsorted(col, [lo, lo + block])
        x = np.zeros((m, block), np.float32)
        x[owner[i:j], col[i:j] - lo] = 1.0
        off += x @ x.T
    off = np.rint(off).astype(np.int64)
    np.fill_diagonal(off, out.diagonal())
    return off


def _verified(groups: DataFrame, num: int, den: int) -> DataFrame:
    """``node, links, lead`` for each text of each cell: links weighted by copies."""
    key = ["comp", "cell_a", "cell_b"]

    def run(batches):
        import pyarrow as pa
        hasher = WordHasher()
        for t, first in _whole_groups(batches, key):
            ends = np.r_[first[1:], t.num_rows]
            out = []
            for i, j in zip(first.tolist(), ends.tolist()):
                g = t.slice(i, j - i)
                node, at = np.unique(g.column("node").to_numpy(), return_index=True)
                if len(node) < 2:
                    continue
                g = g.take(pa.array(at))
                side, copies = g.column("side").to_numpy(), g.column("copies").to_numpy()
                words, bounds = hasher(*text_buffer(g.column("text")))
                grams, bounds = ngram_hashes(words, bounds)
                sets = [np.unique(grams[bounds[k]:bounds[k + 1]]) for k in range(len(node))]
                both = common_counts(sets)
                size = both.diagonal()
                ok = both * (num + den) >= num * (size[:, None] + size[None, :])
                np.fill_diagonal(ok, False)
                if g.column("cell_a")[0] != g.column("cell_b")[0]:
                    ok &= side[:, None] != side[None, :]
                a, b = np.nonzero(np.triu(ok))
                if len(a):
                    least = least_linked(len(node), a, b)
                    linked = np.flatnonzero(ok.any(1))
                    out.append((node[linked], (ok @ copies)[linked], node[least[linked]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 names=["node", "links", "lead"])

    return (groups.repartition(*key).sortWithinPartitions(*key, "node")
            .mapInArrow(run, "node long, links long, lead long"))


def link_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 threshold: tuple[int, int] = THRESHOLD,
                 target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row a different text: ``node, first_id, copies, class_id, links, leads``.

    ``class_id``: smallest doc_id of the class; ``links``: linked documents with other
    texts; ``leads``: this text holds the class's smallest doc_id (one text a class).
    """
    num, den = threshold
    depths = depths_by_size(num, den, target_recall)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("id"),
                       null_safe_text(F.col(text)).alias("text"))
    rows = rows.withColumn("node", _text_node(F.col("text")))
    nodes = stage(rows.groupBy("node").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.max(F.octet_length("text")).alias("size")), "near-nodes")

    signed = stage(_signatures(rows.select("node", "text"), depths)
                   .dropDuplicates(["node"]), "near-signatures")
    # Texts of one signature: the smallest node stands for them in all tries.
    leaves = signed.groupBy("sketch").agg(
        F.min("node").alias("leaf"), F.min("depth").alias("least"),
        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    mates = stage(signed.select("node", "sketch").join(leaves, "sketch")
                  .select("node", "leaf", "least"), "near-leaves")
    tries = signed.join(mates, "node", "left").where("leaf is null or leaf = node")
    places = tries.select("node", F.coalesce("least", "depth").alias("depth"),
                          F.explode("paths").alias("at")).select("node", "depth", "at.*")
    crowded = stage(places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                    "near-tries")
    met = places.join(crowded, "key").join(signed.select("node", "sketch"), "node")
    edges = _candidate_edges(_cells(met, F.ceil(F.col("n") / F.lit(CHUNK))), int(depths.min()))
    edges = edges.unionByName(mates.where("leaf <> node").select(
        F.col("node").alias("u"), F.col("leaf").alias("v")))
    groups = stage(components(edges).withColumnRenamed("lead", "comp"), "near-groups")

    sized = groups.join(nodes, "node")
    chunks = stage(sized.groupBy("comp").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)), F.ceil(F.sum("size") / F.lit(CHUNK_BYTES)),
        F.lit(1)).cast("long").alias("chunks")), "near-chunks")
    wanted = (sized.join(chunks, "comp")
              .select("node", F.col("first_id").alias("id"), "copies", "comp", "chunks"))
    # By node and id: one row of each group of copies, and copies spread over tasks.
    whole = rows.join(wanted, ["node", "id"])
    checked = stage(_verified(_cells(whole, F.col("chunks")).drop("id", "chunks"), num, den),
                    "near-verified")
    lead = components(checked.select(F.col("node").alias("u"), F.col("lead").alias("v")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    tagged = stage(nodes.join(lead, "node", "left").join(links, "node", "left").select(
        "node", "first_id", "copies", F.coalesce("lead", "node").alias("lead"),
        F.coalesce("links", F.lit(0)).alias("links")), "near-tagged")
    least = stage(tagged.groupBy("lead").agg(
        F.min(F.struct("first_id", "node")).alias("least")), "near-classes")
    return tagged.join(least, "lead").select(
        "node", "first_id", "copies", F.col("least.first_id").alias("class_id"), "links",
        (F.col("least.node") == F.col("node")).alias("leads"))


def _id(col):
    return F.when(col != F.lit(_LAST), col)


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id, class_id, n_links`` (other documents linked to it)."""
    names(docs, [doc_id, text])
    classes = stage(link_classes(docs, doc_id, text), "near-links")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       _text_node(null_safe_text(F.col(text))).alias("node"))
    return rows.join(classes, "node").select(
        "doc_id", _id(F.col("class_id")).alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest doc_id."""
    names(docs, [doc_id, text])
    stay = stage(link_classes(docs, doc_id, text).where("leads")
                 .select(F.col("node").alias("__node"), F.col("first_id").alias("__id")),
                 "near-stay")
    id_ = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    keyed = docs.withColumn("__id", id_).withColumn(
        "__node", _text_node(null_safe_text(F.col(text))))
    return (keyed.join(stay, ["__node", "__id"], "left_semi")
            .dropDuplicates(["__node", "__id"]).select(*docs.columns))
