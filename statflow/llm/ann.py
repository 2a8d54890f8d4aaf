"""Operator 5: approximate nearest neighbours by balanced posting lists.

Lists are in proportion to the square root of the rows (``2 * sqrt(n)``) at every size.
Their centroids are fitted in two levels of balanced k-means: the driver fits the square
root of their number as cells on a bounded sample (about ``SAMPLE`` rows, by hash), and a
task a cell fits that cell's lists on a sample of ``LIST_SAMPLE`` rows a list, at most
``CELL_SAMPLE`` a cell. Tasks then link the centroids into a nearest-neighbour graph. It
holds ``2 * sqrt(n)`` vectors (64,000 for 10**9 rows, 32 MB at 64 numbers each) and goes to
every task; centroids are searched in that graph. Every vector is
indexed: it goes to the posting list of its nearest centroid and, at a boundary, to
further lists whose centroid is within ``REPLICA_RATIO`` of the nearest distance and
not closer to a centroid chosen before. A query visits the lists whose centroid is
within ``SEARCH_RATIO`` of its nearest centroid's distance, and the nearest lists that
hold ``LEAST_VECTORS`` x k vectors together, and measures all vectors in them exactly (Euclidean distance in double precision on the original vectors).

Vectors and queries meet by a shuffle on (list, part): lists with more than
``PART_ROWS`` vectors are cut into parts by hash, and a query goes to each of them,
so no list is collected whole. Each part returns its k nearest for a query, and a
window keeps the best of all parts.

Parameters that decide recall: the two ratios and ``LEAST_VECTORS``. The fit is the same at
any size.

Defined cases: a vector takes no part if it or its id is null, it holds a null or a
non-finite component, all components are zero, or its length is not the table's most
frequent one; rows equal in id and vector count once; of several vectors of one query id
the smallest, number by number, is asked; ties go to the smaller id; with
fewer candidates than k all are returned; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import names, stage

SAMPLE = 20_000
LIST_SAMPLE, CELL_SAMPLE = 40, 20_000
REPLICAS, REPLICA_RATIO = 8, 1.15
SEARCH_RATIO, SEARCH_LISTS = 1.3, 256
LEAST_VECTORS = 40
PART_ROWS = 4096


@dataclass
class Centroids:
    """Centroids with a neighbour graph and a few entry points."""

    points: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    def search(self, x: np.ndarray, want: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``x`` up to ``want`` near centroids, nearest first:
        ``(numbers, distances)``, -1 and infinity where there are no more.

        Best-first search: the beam holds the nearest centroids met; each step opens
        every row's nearest unopened one and adds its neighbours, until all are open.
        """
        n, beam = len(x), max(beam, want)
        found = np.full((n, beam), -1)
        dist = np.full((n, beam), np.inf)
        opened = np.ones((n, beam), bool)
        seen = np.zeros((n, len(self.points)), bool)
        norm = (self.points ** 2).sum(1)
        own = (x ** 2).sum(1)

        def add(rows, new):
            nonlocal found, dist, opened
            fresh = ~seen[rows[:, None], new]
            for k in range(1, new.shape[1]):  # a neighbour may be listed twice
                fresh[:, k] &= ~(new[:, k:k + 1] == new[:, :k]).any(1)
            seen[rows[:, None], new] = True
            d = own[rows, None] + norm[new] - 2 * np.einsum("nd,nkd->nk", x[rows], self.points[new])
            d = np.where(fresh, np.sqrt(np.maximum(d, 0)), np.inf)
            all_d = np.concatenate([dist[rows], d], 1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            take = lambda a: np.take_along_axis(a, order, 1)
            dist[rows] = take(all_d)
            found[rows] = take(np.concatenate([found[rows], new], 1))
            opened[rows] = take(np.concatenate([opened[rows], ~fresh], 1))

        rows = np.arange(n)
        add(rows, np.broadcast_to(self.entries, (n, len(self.entries))))
        while len(rows):
            closed = opened[rows] | ~np.isfinite(dist[rows])
            slot = closed.argmin(1)
            live = ~closed[np.arange(len(rows)), slot]
            rows, slot = rows[live], slot[live]
            if len(rows):
                opened[rows, slot] = True
                add(rows, self.graph[found[rows, slot]])
        return np.where(np.isfinite(dist), found, -1)[:, :want], dist[:, :want]


def balanced_means(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Balanced k-means: a list's size in the last round makes it dearer or cheaper."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    points = sample[rng.permutation(len(sample))[:lists]].copy()
    size = np.full(lists, len(sample) / lists)
    own = (sample ** 2).sum(1)
    for _ in range(rounds):
        pick, spread = np.empty(len(sample), np.int64), 0.0
        for i in range(0, len(sample), 4096):
            x = sample[i:i + 4096]
            d = own[i:i + 4096, None] + (points ** 2).sum(1) - 2 * x @ points.T
            spread = max(spread, float(np.median(d.min(1))))
            pick[i:i + 4096] = (d + 0.2 * spread * (size / size.mean() - 1)).argmin(1)
        size = np.bincount(pick, minlength=lists).astype(float)
        total = np.zeros_like(points)
        np.add.at(total, pick, sample)
        empty = size == 0
        points = np.where(empty[:, None], points, total / np.maximum(size, 1)[:, None])
        if empty.any():  # start again at random members
            points[empty] = sample[rng.integers(0, len(sample), int(empty.sum()))]
    return points


def neighbours(points: np.ndarray, rows: np.ndarray, degree: int = 16) -> np.ndarray:
    """The ``degree`` nearest other points of some points, nearest first (all, if fewer)."""
    degree, norm = min(degree, len(points) - 1), (points ** 2).sum(1)
    if degree < 1:
        return np.zeros((len(rows), 1), np.int64)
    out, step = [], _step(len(points), 1 << 22)
    for i in range(0, len(rows), step):
        own = rows[i:i + step]
        d = norm[own, None] + norm - 2 * points[own] @ points.T
        d[np.arange(len(own)), own] = np.inf
        out.append(np.argsort(d, axis=1, kind="stable")[:, :degree])
    return np.concatenate(out)


def _step(lists: int, cells: int = 1 << 24) -> int:
    """Rows at a time so that rows x lists stays bounded."""
    return max(1, min(1024, cells // lists))


def linked(points: np.ndarray, near: np.ndarray, entries: int = 16, seed: int = 11) -> Centroids:
    rng = np.random.default_rng(seed)
    # A random link each keeps separate clusters of centroids connected.
    graph = np.concatenate([near, rng.integers(0, len(points), (len(points), 2))], 1)
    return Centroids(points, graph, rng.permutation(len(points))[:entries])


def fit_centroids(sample: np.ndarray, lists: int) -> Centroids:
    """Centroids of an array, in one level and one process."""
    points = balanced_means(sample, lists)
    return linked(points, neighbours(points, np.arange(len(points))))


def fit_lists(vectors: DataFrame, total: int, lists: int, sample: int = SAMPLE,
              cell_sample: int = CELL_SAMPLE) -> Centroids:
    """About ``lists`` centroids of a table of ``total`` vectors, in two levels."""
    spark, cells = vectors.sparkSession, max(1, int(np.ceil(lists ** 0.5)))
    part = 1_000_000_000
    draw = lambda salt, n: vectors.withColumn("key", F.pmod(
        F.xxhash64("vec_id", F.lit(salt)), F.lit(part))).where(F.col("key") < F.lit(-(-n * part // total)))
    x = _matrix(draw(1, sample).limit(2 * sample).select("embedding").toArrow().column(0))
    if not len(x):  # a tiny share may draw nothing
        x = _matrix(vectors.limit(1).select("embedding").toArrow().column(0))
    x = x[np.lexsort(x.T)]  # the order of rows does not matter
    top = balanced_means(x, cells)
    norm, each = (top ** 2).sum(1), -(-lists // len(top))

    def place(batches):
        import pyarrow as pa
        for batch in batches:
            m, step = _matrix(batch.column("embedding")), _step(len(top))
            at = [(norm - 2 * m[i:i + step] @ top.T).argmin(1) for i in range(0, len(m), step)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(at or [np.zeros(0)]).astype(np.int32)),
                 batch.column("key"), batch.column("vec_id"), batch.column("embedding")],
                names=["cell", "key", "vec_id", "embedding"])

    def split(key, table):
        import pyarrow as pa
        m = _matrix(table.column("embedding"))
        return pa.table({"cell": pa.array(np.full(min(each, len(m)), key[0].as_py(), np.int32)),
                         "embedding": pa.array(list(balanced_means(m[np.lexsort(m.T)], each)),
                                               pa.list_(pa.float64()))})

    first = Window.partitionBy("cell").orderBy("key", "vec_id", "embedding")
    drawn = draw(2, LIST_SAMPLE * lists).select("key", "vec_id", "embedding").mapInArrow(
        place, "cell int, key long, vec_id long, embedding array<double>")
    fitted = (drawn.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= cell_sample)
              .groupBy("cell").applyInArrow(split, "cell int, embedding array<double>"))
    points = _matrix(fitted.toArrow().column("embedding"))
    if not len(points):
        points = top
    points = points[np.lexsort(points.T)]

    def link(batches):
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                near = neighbours(points, batch.column("id").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(list(near), pa.list_(pa.int64()))], names=["id", "near"])

    near = spark.range(len(points)).mapInArrow(link, "id long, near array<long>").toArrow()
    return linked(points, _matrix(near.sort_by("id").column("near")))


def posting_lists(c: Centroids, x: np.ndarray, replicas: int = REPLICAS,
                  ratio: float = REPLICA_RATIO) -> tuple[np.ndarray, np.ndarray]:
    """``(row, list)`` pairs: the closure of each vector."""
    found, dist = c.search(x, 2 * replicas, 4 * replicas)
    chosen = found >= 0
    chosen &= dist <= ratio * dist[:, :1] + 1e-12
    for k in range(1, found.shape[1]):
        for j in range(k):
            apart = np.sqrt(((c.points[found[:, k]] - c.points[found[:, j]]) ** 2).sum(1))
            chosen[:, k] &= ~(chosen[:, j] & (apart < dist[:, k]))
        chosen[:, k] &= chosen[:, :k].sum(1) < replicas
    row, slot = np.nonzero(chosen)
    return row, found[row, slot]


def _matrix(column) -> np.ndarray:
    import pyarrow as pa
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part, each row once: repeats would
    take the places of other neighbours and make lists seem fuller than they are."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(embedding).cast("array<double>").alias("embedding"))
    good = F.forall("embedding", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    some = F.exists("embedding", lambda v: v != 0.0)
    rows = stage(rows.where(F.col("vec_id").isNotNull() & good & some).distinct(), "ann-rows")
    width = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(
        F.desc("count"), F.desc("w")).limit(1).collect()
    return rows.where(F.size("embedding") == F.lit(width[0]["w"] if width else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, sample: int = SAMPLE,
            ratio: float = SEARCH_RATIO, visit: int = SEARCH_LISTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query's vector.
    Both tables: ``vec_id, embedding`` as ``usable`` gives them; a query's own id is
    not its neighbour."""
    spark = vectors.sparkSession
    total = vectors.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if total == 0:
        return spark.createDataFrame([], schema)
    centroids = fit_lists(vectors, total, max(1, int(2 * total ** 0.5)), sample)
    step = _step(len(centroids.points))

    def index(batches):
        import pyarrow as pa
        for batch in batches:
            m = _matrix(batch.column("embedding"))
            for i in range(0, len(m), step):
                row, at = posting_lists(centroids, m[i:i + step])
                part = batch.slice(i, step).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), part.column("vec_id"), part.column("embedding")],
                    names=["list", "vec_id", "embedding"])

    kind = "list int, vec_id long, embedding array<double>"
    listed = stage(vectors.mapInArrow(index, kind), "ann-lists")
    held = listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"))  # a row a list
    sizes = np.zeros(len(centroids.points), np.int64)
    for r in held.collect():
        sizes[r["list"]] = r["n"]
    least = LEAST_VECTORS * k

    def probe(batches):
        import pyarrow as pa
        for batch in batches:
            m = _matrix(batch.column("embedding"))
            for i in range(0, len(m), step):
                found, dist = centroids.search(m[i:i + step], visit, visit)
                size = np.where(found >= 0, sizes[found], 0)
                few = np.cumsum(size, axis=1) - size < least
                row, slot = np.nonzero((found >= 0) & (few | (dist <= ratio * dist[:, :1] + 1e-12)))
                part = batch.slice(i, step).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[row, slot].astype(np.int32)), part.column("vec_id"),
                     part.column("embedding")], names=["list", "vec_id", "embedding"])

    parts = F.broadcast(held.select(
        "list", F.ceil(F.col("n") / F.lit(PART_ROWS)).cast("int").alias("parts")))
    stored = listed.join(parts, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        F.lit(0).alias("kind"), "vec_id", F.xxhash64("embedding").alias("vec"), "embedding")
    asked = queries.mapInArrow(probe, kind).join(parts, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(1).alias("kind"), "vec_id", F.lit(0).cast("long").alias("vec"), "embedding")
    met = stored.unionByName(asked).repartition("list", "part").sortWithinPartitions(
        "list", "part", "kind", "vec_id")

    def measure(batches):
        import pyarrow as pa
        at, ids, marks, vecs = None, [], [], []
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in ("list", "part", "kind")], 1)
            v, m = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            mark = batch.column("vec").to_numpy()
            cut = np.flatnonzero(np.r_[True, (where[1:] != where[:-1]).any(1), True])
            out = []
            for i, j in zip(cut[:-1], cut[1:]):
                if tuple(where[i, :2]) != at:
                    at, ids, marks, vecs = tuple(where[i, :2]), [], [], []
                if where[i, 2] == 0:
                    ids.append(v[i:j])
                    marks.append(mark[i:j])
                    vecs.append(m[i:j])
                elif ids:
                    if len(ids) > 1:
                        ids, marks, vecs = ([np.concatenate(x)] for x in (ids, marks, vecs))
                    for a in range(i, j, 256):
                        out += _nearest_block(v[a:min(a + 256, j)], m[a:min(a + 256, j)],
                                              ids[0], marks[0], vecs[0], k)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 names=["query_id", "vec_id", "vec", "score"])

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # A vector found in several lists is one; two vectors of an id stay two.
    return (met.mapInArrow(measure, "query_id long, vec_id long, vec long, score double").distinct()
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _nearest_block(q_ids, q, ids, marks, vecs, k):
    """Per query its k nearest rows of one list part, by exact distance, then id. The
    rows are distinct; ``marks`` tells an id's vectors apart."""
    rough = (q ** 2).sum(1)[:, None] + (vecs ** 2).sum(1) - 2 * q @ vecs.T
    rough[q_ids[:, None] == ids] = np.inf
    top = min(k, len(ids)) - 1
    edge = np.partition(rough, top, axis=1)[:, top]
    slack = 1e-9 * (1 + np.abs(rough[np.isfinite(rough)]).max(initial=0))
    out = []
    for i in range(len(q)):
        near = np.flatnonzero((rough[i] <= edge[i] + slack) & np.isfinite(rough[i]))
        exact = np.sqrt(((vecs[near] - q[i]) ** 2).sum(1))
        order = np.lexsort((ids[near], exact))[:k]
        out.append((np.full(len(order), q_ids[i]), ids[near][order], marks[near][order], exact[order]))
    return out


def search_self(vectors: DataFrame, modulus: int = 100, k: int = 10, **options) -> DataFrame:
    """Rows whose vec_id is divisible by ``modulus`` against all rows."""
    names(vectors, ["vec_id", "embedding"])
    rows = usable(vectors, "vec_id", "embedding")
    queries = (rows.where(F.pmod(F.col("vec_id"), F.lit(modulus)) == 0)
               .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    return nearest(rows, queries, k, **options)
