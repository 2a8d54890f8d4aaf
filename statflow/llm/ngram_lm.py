"""Operator 3: language-model scoring with a weighted backoff automaton.

Model: smoothed n-grams over words, of any order from 2 (``order``, 3 by default). A state
is a history, that is up to ``order - 1`` words last read; a seen n-gram (h, w) is an arc
from state h with weight log p(w | h), where

    p(w | h) = (n(h, w) + m(h) p(w | h')) / (n(h) + m(h)),    m(h) = a * n(h) ** b

and h' is h without its first word. Every state has a failure arc to h' with weight
log(m(h) / (n(h) + m(h))); the root has an arc for each word, log p(w) with p(w) = (n(w) + 1)
/ (N + V + 1), and one for unknown words (n = 0). For each history the probabilities sum to
one. A text is one left-to-right walk that carries the state: take the word's arc if the
state has one, else follow failure arcs until a state has it; the arc's n-gram, cut to
``order - 1`` words, is the next state (the root if the word was never seen). Documents start
in the state of the end token, so sequences are linked as boundary -> words -> boundary.

(a, b) is chosen among ``GRID`` by leave-one-out likelihood of all training tokens.

On Spark: the automaton grows with the corpus, so it is never broadcast. Tasks cut their rows
into blocks of a few MB of text and keep each block's word numbers in a file of the shared
folder, so texts are never shuffled. A block counts its distinct words and bigrams (64-bit
hashes, sorted) and sends each hash range to that range's group with the block's training
counts; the group adds up the counts of all blocks and answers each block for its own hashes,
in order, with a mark on those that other blocks hold too, together with its share of N and
V. A hash comes at most once from a block, so common words are added up before the shuffle and
no key is hot. Each higher order is one more round. An n-gram whose history, or whose last
``n - 1`` words, no other block holds (in training texts or others) is in no other block
either: its count is known, and only the others are asked for. With all answers a block holds the part of the automaton that its documents can reach, and walks them.
The counts cover all training documents.

The input is read once; its partitions should be the same when a lost task is run again, as
those of a table scan are: it writes the same files again. Defined cases: null text is empty
text (its end token alone); a null doc_id counts as empty text in the fold; repeated rows are
scored each; without training documents p(w) is 1 over 1; an empty table gives an empty
result; very long texts make a block of their own; extra columns are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import (WordHasher, from_planes, learn_bucket, mix64, names,
                                 null_safe_text, planes, release_memory, shared_folder, stage,
                                 text_buffer, text_bytes, unique_counts)
from statflow.llm.files import NewFile, open_file

ORDER = 3
BLOCK_BYTES = 8 << 20
GROUP_BYTES = 16 << 20
#: Tokens that one lane of a walk reads.
LANE_TOKENS = 1024
#: (a, b) of m(h) = a * n(h) ** b.
GRID = ((1.0, 0.5), (8.0, 0.5), (0.5, 0.8), (2.0, 0.8), (8.0, 0.8),
        (0.1, 1.0), (0.5, 1.0), (2.0, 1.0), (10.0, 1.0))
_END = np.uint64(0x6E642D6F662D7478)  # hash of the end token


class Grams:
    """The distinct n-grams that end at the tokens of some documents, one order after another.

    ``index[k][i]`` is the number of the k-gram that ends at token i, -1 where the document
    is too short for one (its boundary counts as one token before it); ``prefix[k]``,
    ``suffix[k]`` and ``last[k]`` give a k-gram's history, its last k - 1 words and its last
    word, the first two as numbers of (k - 1)-grams.
    """

    def __init__(self, word: np.ndarray, bounds: np.ndarray, end: int, hashes: np.ndarray):
        self.bounds, self.end, self.words = bounds, end, hashes
        self.index, self.prefix, self.suffix = [None, word], [None, None], [None, None]
        self.hashes = [None, hashes]
        self.place = np.arange(len(word)) - np.repeat(bounds[:-1], np.diff(bounds))

    @property
    def order(self) -> int:
        return len(self.index) - 1

    def extend(self) -> None:
        """Add the next order."""
        k, word, lower = self.order + 1, self.index[1], self.index[-1]
        has = self.place >= k - 2
        history = np.empty_like(lower)
        history[1:] = lower[:-1]
        if k == 2:
            history[self.bounds[:-1]] = self.end
        codes, at = np.unique(history[has].astype(np.int64) * len(self.words) + word[has],
                              return_inverse=True)
        index = np.full(len(word), -1, np.int64)
        index[has] = at
        prefix, last = codes // len(self.words), codes % len(self.words)
        suffix = np.empty(len(codes), np.int64)
        suffix[at] = lower[has]
        self.index.append(index)
        self.prefix.append(prefix)
        self.suffix.append(suffix)
        self.hashes.append(_pair_hash(self.hashes[-1][prefix], self.words[last]))

    def counts(self, k: int, learn: np.ndarray) -> np.ndarray:
        """How often each k-gram ends at a token of ``learn``."""
        index = self.index[k]
        return np.bincount(index[learn & (index >= 0)], minlength=len(self.hashes[k]))

    def by_token(self, values: list[np.ndarray]) -> np.ndarray:
        """For each token the value of the longest n-gram that ends there."""
        out = values[1][self.index[1]]
        for k in range(2, self.order + 1):
            has = self.index[k] >= 0
            out[has] = values[k][self.index[k][has]]
        return out


class Parts:
    """What the automata of some n-grams share whatever their (a, b) is.

    ``path`` (see ``walk``): the parts of the tokens' ways; ``learn``: the tokens to leave out.
    The n-grams of all orders are numbered one order after another (``first[k]`` is where
    those of order k begin), so a token's arc is one number.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, distinct: int):
        self.grams, self.counts = grams, counts
        self.p = (counts[1] + 1.0) / (tokens + distinct + 1.0)
        self.root, self.left = np.log10(self.p), np.maximum(counts[1], 1.0) / max(tokens + distinct, 1)
        self.first = np.cumsum([0, 0, *map(len, counts[1:])])
        self.fewer = [None, *[np.maximum(n - 1.0, 0.0) for n in counts[1:]]]
        self.power = (None, [])

    def powers(self, b: float) -> list[np.ndarray]:
        """n ** b of the counts below the highest order."""
        if self.power[0] != b:
            self.power = (b, [None, *[n.astype(float) ** b for n in self.counts[1:-1]]])
        return self.power[1]

    def follow(self, path: tuple[np.ndarray, np.ndarray]) -> None:
        depth, taken = path
        index, order = self.grams.index, self.grams.order
        self.arc, self.failed = np.empty(len(depth), np.int64), [None]
        for k in range(1, order + 1):
            at = np.flatnonzero(taken == k)
            self.arc[at] = index[k][at] + self.first[k]
            if k > 1:
                at = np.flatnonzero((taken < k) & (depth >= k - 1))
                self.failed.append((at, self.grams.prefix[k][index[k][at]]))

    def leave_out(self, learn: np.ndarray) -> None:
        index = self.grams.index
        self.tokens = np.flatnonzero(learn)
        self.longest = index[1][self.tokens].copy()
        for k in range(2, self.grams.order + 1):
            own = index[k][self.tokens]
            self.longest = np.where(own >= 0, own + self.first[k], self.longest)


class Automaton:
    """The part of the backoff automaton that some documents reach.

    ``counts[k]``: training counts of the k-grams of ``grams`` (k from 1). The states of
    depth k are its k-grams with a count.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, distinct: int,
                 a: float, b: float, parts: Parts | None = None):
        self.grams, self.counts, self.tokens, self.distinct = grams, counts, tokens, distinct
        self.parts = parts = parts or Parts(grams, counts, tokens, distinct)
        self.root, self.p, self.fail, self.left = parts.root, [None, parts.p], [None], [None, parts.left]
        powers = parts.powers(b)
        for k in range(2, grams.order + 1):
            n, h, suffix = counts[k - 1], grams.prefix[k], grams.suffix[k]
            # m(h); 1 where h is no state, so that its failure arc weighs nothing.
            mass = np.where(n > 0, a * powers[k - 1], 1.0)
            total = n + mass
            self.fail.append(np.log10(mass / total))
            m = mass[h]
            self.p.append((counts[k] + m * self.p[k - 1][suffix]) / total[h])
            self.left.append((parts.fewer[k] + m * self.left[k - 1][suffix])
                             / (parts.fewer[k - 1][h] + m))

    def scores(self, path: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """For each token the weights on its part of ``path`` (see ``walk``; None: the one the
        parts follow), added up: the failure arcs from the state that the walk carried, and
        the arc taken."""
        if path is not None:
            self.parts.follow(path)
        out = np.log10(np.concatenate(self.p[1:])[self.parts.arc])
        for fail, (at, state) in zip(self.fail[1:], self.parts.failed[1:]):
            out[at] += fail[state]
        return out

    def left_out(self, learn: np.ndarray | None = None) -> np.ndarray:
        """For each token of ``learn`` (None: those of the parts) log10 of its probability if it
        is a training token that is itself left out of all counts; 0 for the others."""
        if learn is not None:
            self.parts.leave_out(learn)
        out = np.zeros(len(self.grams.place))
        out[self.parts.tokens] = np.log10(np.concatenate(self.left[1:])[self.parts.longest])
        return out


def walk(grams: Grams, counts: list[np.ndarray], lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Every document's way through the automaton, which no (a, b) changes: for each token
    ``(depth of the state before it, order of the arc taken)``.

    Documents are walked side by side, a token a step. Long ones are cut into lanes of
    ``lane`` tokens, which begin ``order - 1`` tokens early at the root: after these the
    state is that of the whole walk, since it holds no more words.
    """
    lane, order = lane or LANE_TOKENS, grams.order
    seen = [None]
    for k in range(1, order + 1):
        known = np.r_[counts[k] > 0, False]  # the last place stands for no n-gram
        seen.append(known[grams.index[k]])
    size = np.diff(grams.bounds)
    pieces = -(-size // lane)
    own = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = grams.bounds[own]
    start = begin + nth * lane
    stop = np.minimum(start + lane, grams.bounds[own + 1])
    first = np.maximum(start - (order - 1), begin)
    longest = np.argsort(first - stop, kind="stable")
    first, start, stop, begin = first[longest], start[longest], stop[longest], begin[longest]
    state = np.where((first == begin) & (counts[1][grams.end] > 0), 1, 0)
    depth, taken = np.zeros(len(grams.place), np.int8), np.ones(len(grams.place), np.int8)
    span = stop - first
    for t in range(int(span.max(initial=0))):
        live = int(np.searchsorted(-span, -t, "left"))  # lanes with more than t tokens
        at, carried = first[:live] + t, state[:live]
        arc = carried + 1
        for k in range(order, 1, -1):  # failure arcs
            arc = arc - ((arc == k) & ~seen[k][at])
        own_part = at >= start[:live]
        depth[at[own_part]], taken[at[own_part]] = carried[own_part], arc[own_part]
        state[:live] = np.where((arc > 1) | seen[1][at], np.minimum(arc, order - 1), 0)
    return depth, taken


def _sum_rows(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, bounds[:-1])  # every document has its end token at least


def _pair_hash(c: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(c * np.uint64(0x9DDFEA08EB382D69) + (w ^ np.uint64(0x2545F4914F6CDD1D)))


def _cut(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Where each of ``groups`` equal hash ranges begins in sorted hashes."""
    edges = np.array([(g << 64) // groups for g in range(1, groups)], np.uint64)
    return np.r_[0, np.searchsorted(hashes, edges), len(hashes)]


def _pack_counts(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    step = np.diff(hashes, prepend=np.uint64(0))
    return struct.pack("<Q", len(hashes)) + planes(step) + planes(counts.astype("<u4"))


def _unpack_counts(raw: memoryview) -> tuple[np.ndarray, np.ndarray, memoryview]:
    n = struct.unpack_from("<Q", raw)[0]
    at, end = 8 + 8 * n, 8 + 12 * n
    with np.errstate(over="ignore"):
        hashes = np.cumsum(from_planes(raw[8:at], "<u8"), dtype=np.uint64)
    return hashes, from_planes(raw[at:end], "<u4").astype(np.int64), raw[end:]


def _keep(folder: str, name: str, data: bytes) -> None:
    out = NewFile(folder, name)
    out.write(data)
    out.commit()


def _kept(folder: str, name: str) -> memoryview:
    with open_file(f"{folder}/{name}") as f:
        return memoryview(f.read())


class Block:
    """A block's documents: ids, fold, and the word of each token as a number in ``words``,
    the block's sorted word hashes."""

    def __init__(self, doc_ids, valid, train, bounds, words, word):
        self.doc_ids, self.valid, self.train = doc_ids, valid, train
        self.bounds, self.words, self.word = bounds, words, word
        self.learn = np.repeat(train, np.diff(bounds))

    def grams(self) -> Grams:
        return Grams(self.word, self.bounds, int(np.searchsorted(self.words, _END)), self.words)

    def dump(self) -> bytes:
        import zstandard
        # Frequent words get small numbers: the sequence compresses better.
        order = np.argsort(-np.bincount(self.word, minlength=len(self.words)), kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        zipper = zstandard.ZstdCompressor(level=1)
        parts = [zipper.compress(p) for p in (
            planes(self.bounds.astype("<i8")), self.doc_ids.astype("<i8").tobytes(),
            self.valid.astype(np.uint8).tobytes(), self.train.astype(np.uint8).tobytes(),
            planes(np.diff(self.words, prepend=np.uint64(0))), planes(order.astype("<u4")),
            planes(number[self.word].astype("<u4")))]
        return struct.pack(f"<{len(parts)}Q", *map(len, parts)) + b"".join(parts)

    @staticmethod
    def load(raw: memoryview) -> "Block":
        import zstandard
        zipper, parts, at = zstandard.ZstdDecompressor(), [], 56
        for size in struct.unpack_from("<7Q", raw):
            parts.append(zipper.decompress(raw[at:at + size]))
            at += size
        bounds, ids, valid, train, step, order, number = parts
        with np.errstate(over="ignore"):
            words = np.cumsum(from_planes(step, "<u8"), dtype=np.uint64)
        word = from_planes(order, "<u4").astype(np.int64)[from_planes(number, "<u4")]
        return Block(np.frombuffer(ids, "<i8"), np.frombuffer(valid, np.uint8) > 0,
                     np.frombuffer(train, np.uint8) > 0, from_planes(bounds, "<i8"), words, word)


_KIND = "block long, part int, payload binary"


def _questions(block: int, groups: int, words, word_n, hashes, counts):
    """Sorted hashes with the block's training counts, a row a hash range. With words every
    range is asked, for its share of N and V; else those that hold some of the n-grams."""
    import pyarrow as pa
    at_w, at_p = _cut(words, groups), _cut(hashes, groups)
    parts = [g for g in range(groups) if len(words) or at_p[g] < at_p[g + 1]] or [0]
    payload = [_pack_counts(words[at_w[g]:at_w[g + 1]], word_n[at_w[g]:at_w[g + 1]])
               + _pack_counts(hashes[at_p[g]:at_p[g + 1]], counts[at_p[g]:at_p[g + 1]])
               for g in parts]
    return [pa.array([block] * len(parts), pa.int64()), pa.array(parts, pa.int32()),
            pa.array(payload, pa.binary())]


def _blocks(docs: DataFrame, groups: int, folder: str) -> DataFrame:
    """``block, part, payload``: the words and bigrams of each block, by hash range. The
    block itself is kept as the file ``text-<block>``."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        hasher, made = WordHasher(), 0
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            train = np.asarray(batch.column("train").to_numpy(zero_copy_only=False), bool)
            ids, i, n = batch.column("doc_id"), 0, batch.num_rows
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, "right")) - 1
                j = min(max(j, i + 1), n)
                h, bounds = hasher(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                h = np.insert(h, bounds[1:], _END)
                words, word = np.unique(h, return_inverse=True)
                own = ids.slice(i, j - i)
                block = Block(own.fill_null(0).to_numpy(zero_copy_only=False),
                              np.asarray(own.is_valid().to_numpy(zero_copy_only=False), bool),
                              train[i:j], bounds + np.arange(len(bounds)), words, word)
                _keep(folder, f"text-{base + made}", block.dump())
                grams = block.grams()
                grams.extend()
                order = np.argsort(grams.hashes[2])
                yield pa.RecordBatch.from_arrays(
                    _questions(base + made, groups, words, grams.counts(1, block.learn),
                               grams.hashes[2][order], grams.counts(2, block.learn)[order]),
                    names=["block", "part", "payload"])
                made += 1
                i = j
                del h, words, word, block, grams, order
                release_memory()

    return docs.mapInArrow(run, _KIND)


def _totals(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes; twice the sum of their counts, plus 1 if several blocks hold it."""
    distinct, total = unique_counts(hashes, 2 * counts)
    edge = np.searchsorted(np.sort(hashes), distinct)
    return distinct, total + (np.diff(np.r_[edge, len(hashes)]) > 1)


def _answers(key, table):
    """One group: totals over all blocks, answered to each block in its own order."""
    import pyarrow as pa
    payload, asked = table.column("payload").combine_chunks(), []
    for k in range(table.num_rows):
        w, wn, rest = _unpack_counts(memoryview(payload[k].as_buffer()))
        asked.append((w, wn, *_unpack_counts(rest)[:2]))
    (words, word_n), (grams, gram_n) = (
        _totals(np.concatenate([a[h] for a in asked]), np.concatenate([a[h + 1] for a in asked]))
        for h in (0, 2))
    share = struct.pack("<QQ", int((word_n >> 1).sum()), int((word_n > 1).sum()))
    out = []
    for w, _, g, _ in asked:
        mine_w = word_n[np.searchsorted(words, w)].astype("<u8")
        mine_g = gram_n[np.searchsorted(grams, g)].astype("<u8")
        out.append(share + struct.pack("<QQ", len(mine_w), len(mine_g)) + planes(mine_w) + planes(mine_g))
    release_memory()
    return pa.table({"block": table.column("block"), "part": table.column("part"),
                     "payload": pa.array(out, pa.binary())})


def _open(k: int, grams: Grams, shared: list[np.ndarray]) -> np.ndarray:
    """The k-grams that other blocks may hold, by hash: those whose history and last k - 1
    words are both ``shared`` with another block. (All bigrams are asked for.)"""
    if k == 2:
        return np.argsort(grams.hashes[2])
    found = np.flatnonzero(shared[k - 1][grams.prefix[k]] & shared[k - 1][grams.suffix[k]])
    return found[np.argsort(grams.hashes[k][found])]


def _counted(folder: str, number: int, order: int, table):
    """``(block, grams, answers, N, V)`` up to ``order``: ``answers[k]`` is twice the count
    of each k-gram, plus 1 if other blocks hold it. Those of the highest order come from
    ``table``, the others were kept in earlier rounds."""
    import zstandard
    block = Block.load(_kept(folder, f"text-{number}"))
    grams, known = block.grams(), [None, None]
    tokens = distinct = 0
    part, payload = table.column("part").to_numpy(), table.column("payload").combine_chunks()
    words, highest = [], []
    for k in np.argsort(part):
        raw = memoryview(payload[int(k)].as_buffer())
        n, v, nw, ng = struct.unpack_from("<QQQQ", raw)
        tokens, distinct = tokens + n, distinct + v
        words.append(from_planes(raw[32:32 + 8 * nw], "<u8"))
        highest.append(from_planes(raw[32 + 8 * nw:32 + 8 * (nw + ng)], "<u8"))
    for k in range(2, order + 1):
        grams.extend()
        if k < order:
            raw = _kept(folder, f"counts-{k}-{number}")
            n, v, nw = struct.unpack_from("<QQQ", raw)
            kept = from_planes(zstandard.ZstdDecompressor().decompress(raw[24:]), "<u8").astype(np.int64)
            if k == 2:
                tokens, distinct, known[1] = n, v, kept[:nw]
            known.append(kept[nw:])
            continue
        if k == 2:
            known[1] = np.concatenate(words).astype(np.int64)
        found = 2 * grams.counts(k, block.learn)
        found[_open(k, grams, _shared(known))] = np.concatenate(highest)
        known.append(found)
    return block, grams, known, tokens, distinct


def _shared(known: list) -> list:
    return [None, *[n & 1 > 0 for n in known[1:]]]


def _ask(folder: str, k: int, groups: int):
    """The next round: a block with its counts below order k asks for its open k-grams."""

    def run(key, table):
        import pyarrow as pa
        import zstandard
        number = key[0].as_py()
        block, grams, known, tokens, distinct = _counted(folder, number, k - 1, table)
        words = known[1] if k == 3 else known[1][:0]
        _keep(folder, f"counts-{k - 1}-{number}", struct.pack("<QQQ", tokens, distinct, len(words))
              + zstandard.ZstdCompressor(level=1).compress(
                  planes(np.concatenate([words, known[k - 1]]).astype("<u8"))))
        grams.extend()
        asked = _open(k, grams, _shared(known))
        none = np.zeros(0, np.uint64)
        out = _questions(number, groups, none, none, grams.hashes[k][asked],
                         grams.counts(k, block.learn)[asked])
        del block, grams, known
        release_memory()
        return pa.table(out, names=["block", "part", "payload"])

    return run


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, scores array<double>, left_out array<double>")


def _score(folder: str, order: int):
    """One block with all answers: walk its documents through its automaton, then add up
    the weights on their paths for each (a, b)."""

    def run(key, table):
        import pyarrow as pa
        block, grams, known, tokens, distinct = _counted(folder, key[0].as_py(), order, table)
        counts = [None, *[n >> 1 for n in known[1:]]]
        del known
        bounds, word, n_docs = block.bounds, block.word, len(block.doc_ids)
        parts = Parts(grams, counts, tokens, distinct)
        parts.follow(walk(grams, counts))
        parts.leave_out(block.learn)
        scores, left_out = np.empty((n_docs, len(GRID))), np.empty((n_docs, len(GRID)))
        for g in sorted(range(len(GRID)), key=lambda g: GRID[g][1]):
            automaton = Automaton(grams, counts, tokens, distinct, *GRID[g], parts)
            scores[:, g] = _sum_rows(automaton.scores(), bounds)
            left_out[:, g] = _sum_rows(automaton.left_out(), bounds)
        lists = np.arange(n_docs + 1, dtype=np.int32) * len(GRID)
        out = pa.table({
            "doc_id": pa.array(block.doc_ids, mask=~block.valid), "held_out": pa.array(~block.train),
            "n_tokens": pa.array(np.diff(bounds)),
            "n_known": pa.array(_sum_rows((counts[1] > 0).astype(np.int64)[word], bounds)),
            "train_tokens": pa.array(np.full(n_docs, tokens)),
            "base_score": pa.array(_sum_rows(automaton.root[word], bounds)),
            "scores": pa.ListArray.from_arrays(pa.array(lists), pa.array(scores.ravel())),
            "left_out": pa.ListArray.from_arrays(pa.array(lists), pa.array(left_out.ravel()))})
        del block, grams, counts, automaton, parts
        release_memory()
        return out

    return run


def score_documents(docs: DataFrame, held_out_mod: int = 7, held_out: int = 2,
                    group_bytes: int = GROUP_BYTES, order: int = ORDER) -> DataFrame:
    """Learn from the rows outside the held-out fold, score every row."""
    if order < 2:
        raise ValueError("a backoff model has order 2 or more")
    names(docs, ["doc_id", "text"])
    rows = docs.select(F.col("doc_id").cast("long"), null_safe_text(F.col("text")).alias("text"),
                       (learn_bucket(F.col("doc_id"), held_out_mod) != held_out).alias("train"))
    groups = max(1, -(-text_bytes(rows) // group_bytes))
    folder = shared_folder(docs.sparkSession, "lm-blocks")
    answered = _blocks(rows, groups, folder).groupBy("part").applyInArrow(_answers, _KIND)
    for k in range(3, order + 1):
        answered = (answered.groupBy("block").applyInArrow(_ask(folder, k, groups), _KIND)
                    .groupBy("part").applyInArrow(_answers, _KIND))
    scored = stage(answered.groupBy("block").applyInArrow(_score(folder, order), _SCORES), "lm-scores")
    sums = scored.agg(*[F.sum(F.col("left_out")[g]).alias(f"g{g}") for g in range(len(GRID))]).first()
    best = max(range(len(GRID)), key=lambda g: (sums[g] if sums[g] is not None else 0.0, -g))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
        F.col("scores")[best].alias("score"), F.lit(GRID[best][0]).alias("mass_a"),
        F.lit(GRID[best][1]).alias("mass_b"))
