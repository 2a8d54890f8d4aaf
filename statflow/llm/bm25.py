"""Operator 2: exact top-k BM25 search with block-max pruning.

score(q, d) = sum over the query's words of  qtf * idf * tf (k1 + 1) / (tf + k1 (1 - b + b |d| / avg)),
idf = ln(1 + (N - df + 0.5) / (df + 0.5)), with N, df and avg over all documents. Words
are runs of letters and digits of the lower-cased text; whole texts are indexed and
whole texts are queries.

Index: documents are cut into shards of about ``SHARD_BYTES`` of text. A shard sends its
words (64-bit hashes) with its document counts to the hash ranges' groups, which
answer with counts over all shards, so every shard scores with global statistics. A
shard holds its postings by word; its documents are ordered so that similar ones are
neighbours, in blocks of ``BLOCK_DOCS``, with each word's largest impact in each block.

Search: queries go against every shard in batches. Rare words' postings are added up
per query. For frequent words (impacts as a dense matrix) the block maxima, with the
rare part's maximum in the block, bound a query's score in that block; a block is
evaluated only for the queries whose bound exceeds their current k-th score (as WAND
skips a pivot block), blocks with the largest bounds first. The k-th score starts at
the one that the query's own shard reached when it was indexed. Shard results are
merged per batch, and the finalists are scored again in double precision by their
shards, so the result is that of scoring everything.

Queries times documents is the work that pruning starts from: it grows with the square
of the corpus when the query set grows with it.

Shards lie in files of the shared folder that tasks write and open by name; only their
numbers, document counts and the queries pass through Spark rows. Defined cases: null or
wordless text matches nothing; a row does not find itself; rows that share
no word with the query are no results; a null doc_id is no query and sorts last among
ties; scores equal to 6 decimals go to the smaller doc_id; repeated rows are separate documents; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import (WordHasher, from_planes, names, null_safe_text, planes,
                                 release_memory, shared_folder, stage, text_buffer, text_bytes,
                                 unique_counts)
from statflow.llm.files import NewFile, open_file

SHARD_BYTES = 8 << 20
GROUP_BYTES = 64 << 20
BLOCK_DOCS = 128
ORDER_WORDS = 256
DENSE_SHARE = 1 / 40  # words in more than this part of a shard's documents are dense
K1, B = 1.2, 0.75
DIGITS = 6  # decimals of a score: the order of a sum's terms must not decide ranks
_NONE = -(1 << 63)


# ------------------------------------------------------------------ packing arrays

def _pack(*arrays: np.ndarray) -> bytes:
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        out += [struct.pack("<2sQ", a.dtype.str[1:3].encode(), len(a)), planes(a)]
    return b"".join(out)


def _unpack(raw) -> list[np.ndarray]:
    raw = memoryview(raw)
    n, at, out = struct.unpack_from("<I", raw)[0], 4, []
    for _ in range(n):
        code, size = struct.unpack_from("<2sQ", raw, at)
        dtype = np.dtype("<" + code.decode())
        at += 10
        out.append(from_planes(raw[at:at + size * dtype.itemsize], dtype))
        at += size * dtype.itemsize
    return out


# ------------------------------------------------------------------ one shard

@dataclass
class Shard:
    """Postings by document: document i has words ``word[bounds[i]:bounds[i + 1]]``."""

    words: np.ndarray    # sorted hashes
    idf: np.ndarray
    doc_ids: np.ndarray
    bounds: np.ndarray
    word: np.ndarray
    tf: np.ndarray
    norm: np.ndarray     # k1 (1 - b + b |d| / avg) of each document

    def impacts(self) -> np.ndarray:
        tf = self.tf.astype(float)
        part = tf * (K1 + 1)
        tf += np.repeat(self.norm, np.diff(self.bounds))
        part /= tf
        part *= self.idf[self.word]
        return part

    def prepare(self) -> None:
        """The block-max index: dense part, blocks and postings of rare words."""
        n, n_words = len(self.doc_ids), len(self.words)
        impact = self.impacts().astype(np.float32)
        doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.bounds))
        df = np.bincount(self.word, minlength=n_words)
        frequent = np.argsort(-df, kind="stable")
        frequent = frequent[:int((df > max(8, n * DENSE_SHARE)).sum())]
        self.dense_of = np.full(n_words, -1, np.int32)
        self.dense_of[frequent] = np.arange(len(frequent))
        column = self.dense_of[self.word]
        # Similar documents are neighbours, judged by the most frequent words.
        main = (column >= 0) & (column < ORDER_WORDS)
        rough = np.zeros((n, min(len(frequent), ORDER_WORDS)), np.float32)
        rough[doc[main], column[main]] = impact[main]
        self.order = _similar_order(rough)
        del rough, main
        self.place = np.empty(n, np.int32)
        self.place[self.order] = np.arange(n)
        doc = self.place[doc]
        self.dense = np.zeros((n, len(frequent)), np.float32)
        wide = column >= 0
        self.dense[doc[wide], column[wide]] = impact[wide]
        self.first = np.arange(0, n, BLOCK_DOCS)
        self.most = (np.maximum.reduceat(self.dense, self.first, axis=0) if n else
                     np.zeros((0, len(frequent)), np.float32))
        by_word = np.flatnonzero(~wide)
        by_word = by_word[np.argsort(self.word[by_word], kind="stable")]
        self.post_doc = doc[by_word]
        self.post_impact = impact[by_word]
        rare_df = np.where(self.dense_of >= 0, 0, df)
        self.post_first = np.r_[0, np.cumsum(rare_df)]

    def search(self, q: "Queries", k: int, floor: np.ndarray, own: np.ndarray):
        """``(query, document, rough score)`` of every document that can be among the k
        best; ``floor``: a score that k documents of the corpus reach, ``own``: number
        of the query's own document here, or -1."""
        nq, n = len(q), len(self.doc_ids)
        if not nq or not n:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        at = np.searchsorted(self.words, q.words)
        at[at == len(self.words)] = 0
        local = np.where(self.words[at] == q.words, at, -1)[q.word]
        have = local >= 0
        query, local, weight = q.query[have], local[have], q.weight[have].astype(np.float32)
        slot = self.dense_of[local]
        wide = np.zeros((nq, self.dense.shape[1]), np.float32)
        wide[query[slot >= 0], slot[slot >= 0]] = weight[slot >= 0]
        acc = self._rare(query[slot < 0], local[slot < 0], weight[slot < 0], nq)
        bound = wide @ self.most.T + np.maximum.reduceat(acc, self.first, axis=1)
        own = np.where(own >= 0, self.place[own], -1)
        floor = floor.astype(np.float32).copy()
        slack = np.float32(1e-4) * (1 + np.abs(floor))
        best = np.full((nq, k), -np.inf, np.float32)
        hits = []
        for b in np.argsort(-bound.sum(0), kind="stable").tolist():
            lo, hi = self.first[b], min(self.first[b] + BLOCK_DOCS, n)
            live = np.flatnonzero((bound[:, b] > floor - slack) & (bound[:, b] > 0))
            if not len(live):
                continue
            score = acc[live, lo:hi] + wide[live] @ self.dense[lo:hi].T
            mine = np.flatnonzero((own[live] >= lo) & (own[live] < hi))
            score[mine, own[live[mine]] - lo] = -np.inf
            r, c = np.nonzero((score > (floor - slack)[live, None]) & (score > 0))
            if not len(r):
                continue
            hits.append((live[r], lo + c, score[r, c]))
            some = np.unique(r)
            top = np.concatenate([best[live[some]], score[some]], 1)
            best[live[some]] = np.partition(top, top.shape[1] - k, axis=1)[:, -k:]
            floor = np.maximum(floor, best.min(1))
            slack = np.float32(1e-4) * (1 + np.abs(floor))
        if not hits:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        query, doc, score = (np.concatenate(x) for x in zip(*hits))
        keep = score > (floor - slack)[query]
        return query[keep], self.order[doc[keep]], score[keep].astype(float)

    def _rare(self, query, local, weight, nq: int, most: int = 1 << 20) -> np.ndarray:
        n = len(self.doc_ids)
        out = np.zeros(nq * n, np.float32)
        size = self.post_first[local + 1] - self.post_first[local]
        ends = np.cumsum(size)
        i = 0
        while i < len(local):
            j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right"))
            j = min(max(j, i + 1), len(local))
            s = size[i:j]
            at = np.repeat(self.post_first[local[i:j]] - (np.cumsum(s) - s), s)
            at += np.arange(len(at))
            # Entries are ordered by query: a slice touches few rows of the result.
            lo, hi = int(query[i]), int(query[j - 1]) + 1
            cell = np.repeat((query[i:j] - lo) * n, s) + self.post_doc[at]
            out[lo * n:hi * n] += np.bincount(cell, self.post_impact[at] * np.repeat(weight[i:j], s),
                                              (hi - lo) * n).astype(np.float32)
            i = j
        return out.reshape(nq, n)

    def exact(self, q: "Queries", query: np.ndarray, doc: np.ndarray, impact: np.ndarray | None = None) -> np.ndarray:
        """Scores of (query, document) pairs in double precision; ``impact``: ``impacts()``, if
        already known."""
        impact = self.impacts() if impact is None else impact
        out = np.zeros(len(query))
        order = np.argsort(query, kind="stable")
        wide = np.zeros(len(self.words))
        at = np.searchsorted(self.words, q.words)
        at[at == len(self.words)] = 0
        local = np.where(self.words[at] == q.words, at, -1)[q.word]
        first = np.searchsorted(q.query, np.arange(len(q) + 1))
        last, used = -1, np.zeros(0, np.int64)
        for k in order.tolist():
            if query[k] != last:
                last = query[k]
                mine = slice(first[last], first[last + 1])
                ok = local[mine] >= 0
                wide[used] = 0.0
                used = local[mine][ok]
                wide[used] = q.weight[mine][ok]
            a, b = self.bounds[doc[k]], self.bounds[doc[k] + 1]
            out[k] = np.dot(wide[self.word[a:b]], impact[a:b])
        return out

    def pack(self) -> bytes:
        return _pack(self.words, self.idf, self.doc_ids, self.bounds,
                     self.word.astype("<u4"), self.tf.astype("<u4"), self.norm)

    @staticmethod
    def load(raw) -> "Shard":
        w, idf, ids, bounds, word, tf, norm = _unpack(raw)
        return Shard(w, idf, ids, bounds, word.astype(np.int32), tf, norm)


def _similar_order(x: np.ndarray) -> np.ndarray:
    """Documents by repeated halving along the direction of largest spread."""
    parts = [np.arange(len(x))]
    while max(map(len, parts)) > BLOCK_DOCS:
        halves = []
        for p in parts:
            if len(p) <= BLOCK_DOCS:
                halves.append(p)
                continue
            y = x[p] - x[p].mean(0)
            v = y[int(np.argmax((y ** 2).sum(1)))]
            for _ in range(3):
                v = y.T @ (y @ v)
                size = np.linalg.norm(v)
                if not size:
                    break
                v = v / size
            order = p[np.argsort(y @ v, kind="stable")]
            halves += [order[:len(p) // 2], order[len(p) // 2:]]
        parts = halves
    return np.concatenate(parts)


@dataclass
class Queries:
    """A batch of queries: entries (query, word number, weight) ordered by query."""

    words: np.ndarray   # sorted hashes of the batch's words
    ids: np.ndarray     # doc_id of each query
    own: np.ndarray     # number of its document in its own shard
    floor: np.ndarray   # k-th score in its own shard, or 0
    query: np.ndarray
    word: np.ndarray
    weight: np.ndarray  # times the word occurs in the query

    def __len__(self) -> int:
        return len(self.ids)

    def pack(self) -> bytes:
        return _pack(self.words, self.ids, self.own, self.floor, self.query.astype("<u4"),
                     self.word.astype("<u4"), self.weight)

    @staticmethod
    def load(raw) -> "Queries":
        words, ids, own, floor, query, word, weight = _unpack(raw)
        return Queries(words, ids, own, floor, query.astype(np.int64), word.astype(np.int64), weight)


# ------------------------------------------------------------------ Spark stages

def _keep(folder: str, name: str, data: bytes) -> None:
    """A compressed file under its final name once it is whole; a repeated task writes it again."""
    import pyarrow as pa
    out = NewFile(folder, name)
    out.write(struct.pack("<Q", len(data)) + pa.compress(data, "zstd", asbytes=True))
    out.commit()


def _kept(folder: str, name: str):
    import pyarrow as pa
    with open_file(f"{folder}/{name}") as f:
        raw = f.read()
    return pa.decompress(memoryview(raw)[8:], struct.unpack_from("<Q", raw)[0], "zstd")


def _shards(rows: DataFrame, groups: int, folder: str) -> DataFrame:
    """Documents to shards: each is kept as a file ``raw-<shard>``; its words and document
    counts go to the hash ranges' groups."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        hasher, made = WordHasher(alnum=True), 0
        base = TaskContext.get().partitionId() << 32
        edges = np.array([(g << 64) // groups for g in range(1, groups)], np.uint64)
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id")
            valid = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), bool)
            ids = np.where(valid, ids.fill_null(0).to_numpy(zero_copy_only=False), _NONE)
            asks = np.asarray(batch.column("ask").to_numpy(zero_copy_only=False), bool)
            i, n = 0, batch.num_rows
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + SHARD_BYTES, "right")) - 1
                j = min(max(j, i + 1), n)
                h, bounds = hasher(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                words, word = np.unique(h, return_inverse=True)
                n_tokens, length = len(h), np.diff(bounds)
                del h
                word += np.repeat(np.arange(j - i), length) * max(len(words), 1)
                code, tf = np.unique(word, return_counts=True)
                del word
                doc, word = code // max(len(words), 1), code % max(len(words), 1)
                df = np.bincount(word, minlength=len(words))
                cut = np.r_[0, np.searchsorted(words, edges), len(words)]
                about = np.array([j - i, n_tokens], "<i8")
                payload = [_pack(about, words[cut[g]:cut[g + 1]], df[cut[g]:cut[g + 1]].astype("<u4"))
                           for g in range(groups)]
                shard = base + made
                made += 1
                _keep(folder, f"raw-{shard}", _pack(
                    words, ids[i:j], np.searchsorted(doc, np.arange(j - i + 1)), word.astype("<u4"),
                    tf.astype("<u4"), length, asks[i:j].astype("u1")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * groups, pa.int64()), pa.array(range(groups), pa.int32()),
                     pa.array(payload, pa.binary())], names=["shard", "part", "payload"])
                i = j
                del words, code, doc, word, tf, payload
                release_memory()

    return rows.mapInArrow(run, "shard long, part int, payload binary")


def _count(key, table):
    """One hash range: document counts over all shards, and N and all words."""
    import pyarrow as pa
    shard, part = table.column("shard").to_pylist(), key[0].as_py()
    payload = table.column("payload").combine_chunks()
    asked = [_unpack(payload[k].as_buffer()) for k in range(len(shard))]
    words, df = unique_counts(np.concatenate([a[1] for a in asked]),
                              np.concatenate([a[2] for a in asked]).astype(np.int64))
    about = np.sum([a[0] for a in asked], axis=0)
    out = [_pack(about, df[np.searchsorted(words, w)]) for _, w, _ in asked]
    release_memory()
    return pa.table({"shard": pa.array(shard, pa.int64()), "part": pa.array([part] * len(shard), pa.int32()),
                     "payload": pa.array(out, pa.binary())})


def _index(k: int, folder: str):
    def run(key, table):
        """A shard's index with global statistics, kept as a file ``index-<shard>``, and its
        queries as one batch."""
        import pyarrow as pa
        number, part = key[0].as_py(), table.column("part").to_pylist()
        payload = table.column("payload").combine_chunks()
        words, ids, bounds, word, tf, length, asks = _unpack(_kept(folder, f"raw-{number}"))
        answers = [_unpack(payload[i].as_buffer()) for i in np.argsort(part).tolist()]
        n_docs, n_words = (int(x) for x in answers[0][0])
        df = np.concatenate([a[1] for a in answers]).astype(float)
        word = word.astype(np.int32)
        average = max(n_words / n_docs, 1e-9)
        shard = Shard(words, np.log1p((n_docs - df + 0.5) / (df + 0.5)), ids, bounds, word,
                      tf, K1 * (1 - B + B * length / average))
        ask = np.flatnonzero((asks > 0) & (ids != _NONE))
        entry = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in ask]) \
            if len(ask) else np.zeros(0, np.int64)
        used, at = np.unique(word[entry], return_inverse=True)
        q = Queries(words[used], ids[ask], ask, np.zeros(len(ask)),
                    np.repeat(np.arange(len(ask)), np.diff(bounds)[ask]), at,
                    tf[entry].astype(float))
        if len(q):
            shard.prepare()
            hit, _, score = shard.search(q, k, q.floor, ask)
            order = np.lexsort((-score, hit))
            hit, score = hit[order], score[order]
            kth = np.searchsorted(hit, np.arange(len(q))) + k - 1
            ok = (kth < len(hit)) & (hit[np.minimum(kth, len(hit) - 1)] == np.arange(len(q))) \
                if len(hit) else np.zeros(len(q), bool)
            q.floor = np.where(ok, score[np.minimum(kth, max(len(hit) - 1, 0))] * (1 - 1e-4), 0.0) \
                if len(hit) else q.floor
        _keep(folder, f"index-{number}", shard.pack())
        packed = q.pack()
        del shard, q, answers, words, word, tf
        release_memory()
        return pa.table({"shard": pa.array([number], pa.int64()), "payload": pa.array([packed], pa.binary())})
    return run


def _read_batches(files, only=None):
    """``(batch number, Queries)`` of the written query table, one at a time; ``only``: of
    these batches."""
    import pyarrow.parquet as pq
    for uri in files:
        with open_file(uri) as source:
            for part in pq.ParquetFile(source).iter_batches(batch_size=1):
                for shard, raw in zip(part.column("shard").to_pylist(),
                                      part.column("payload").to_pylist()):
                    if only is not None and shard not in only:
                        continue
                    q = Queries.load(raw)
                    if len(q):
                        yield shard, q


def search_self(docs: DataFrame, modulus: int = 20, k: int = 10) -> DataFrame:
    """``query_id, rank, doc_id, score`` for the rows whose doc_id is divisible by
    ``modulus``, against all rows."""
    names(docs, ["doc_id", "text"])
    rows = docs.select(
        F.col("doc_id").cast("long"), F.lower(null_safe_text(F.col("text"))).alias("text"),
        F.coalesce(F.pmod(F.col("doc_id"), F.lit(modulus)) == 0, F.lit(False)).alias("ask"))
    groups = max(1, -(-text_bytes(rows) // GROUP_BYTES))
    folder = shared_folder(docs.sparkSession, "bm25-shards")
    made = stage(_shards(rows, groups, folder).groupBy("part").applyInArrow(
        _count, "shard long, part int, payload binary").groupBy("shard").applyInArrow(
        _index(k, folder), "shard long, payload binary"), "bm25")
    queries = stage(made.coalesce(64), "bm25-queries")
    files = [f for f in queries.inputFiles()]
    shards = made.select("shard")
    n_shards = max(1, shards.count())

    def search(batches):
        import pyarrow as pa
        for batch in batches:
            for number in batch.column("shard").to_pylist():
                shard = Shard.load(_kept(folder, f"index-{number}"))
                shard.prepare()
                for asked, q in _read_batches(files):
                    own = q.own if asked == number else np.full(len(q), -1)
                    query, doc, score = shard.search(q, k, q.floor, own)
                    if len(query):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([asked], pa.int64()), pa.array([number], pa.int64()),
                             pa.array([_pack(query.astype("<u4"), doc.astype("<u4"), score)],
                                      pa.binary())], names=["asked", "shard", "payload"])
                del shard
                release_memory()

    def merge(key, table):
        """One batch of queries: who can be among the k best of all shards."""
        import pyarrow as pa
        shard = table.column("shard").to_pylist()
        query, doc, score = (np.concatenate(x) for x in zip(
            *[_unpack(p.as_py()) for p in table.column("payload")]))
        where = np.repeat(np.arange(len(shard)),
                          [len(_unpack(p.as_py())[0]) for p in table.column("payload")])
        order = np.lexsort((-score, query))
        query, doc, score, where = query[order], doc[order], score[order], where[order]
        first = np.searchsorted(query, query)
        kth = np.minimum(first + k - 1, np.searchsorted(query, query, "right") - 1)
        keep = score >= score[kth] - 2e-4 * (1 + np.abs(score[kth]))
        out = [(shard[s], key[0].as_py(), _pack(query[keep & (where == s)], doc[keep & (where == s)]))
               for s in np.unique(where[keep]).tolist()]
        cols = list(zip(*out))
        return pa.table({"shard": pa.array(cols[0], pa.int64()), "asked": pa.array(cols[1], pa.int64()),
                         "payload": pa.array(cols[2], pa.binary())})

    # A shard is some seconds of work: one task each.
    finalists = (shards.repartition(n_shards).mapInArrow(search, "asked long, shard long, payload binary")
                 .groupBy("asked").applyInArrow(merge, "shard long, asked long, payload binary"))

    def settle(key, table):
        """One shard: its finalists in double precision."""
        import pyarrow as pa
        out = []
        wanted = dict(zip(table.column("asked").to_pylist(), table.column("payload").to_pylist()))
        shard = Shard.load(_kept(folder, f"index-{key[0].as_py()}"))
        impact = shard.impacts()
        for asked, q in _read_batches(files, wanted):
            query, doc = (x.astype(np.int64) for x in _unpack(wanted[asked]))
            # Of a shard's many equal documents only the first k can be among the k best.
            score, ids = np.round(shard.exact(q, query, doc, impact), DIGITS), shard.doc_ids[doc]
            order = np.lexsort((ids, ids == _NONE, -score, query))
            query, ids, score = query[order], ids[order], score[order]
            first = np.arange(len(query)) - np.searchsorted(query, query) < k
            out.append((q.ids[query[first]], ids[first], score[first]))
        release_memory()
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()),
                         "doc_id": pa.array(cols[1], pa.int64(), mask=cols[1] == _NONE),
                         "score": pa.array(cols[2], pa.float64())})

    scored = finalists.repartition(n_shards, "shard").groupBy("shard").applyInArrow(settle, "query_id long, doc_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (scored.withColumn("score", F.round("score", DIGITS))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "doc_id", "score"))
