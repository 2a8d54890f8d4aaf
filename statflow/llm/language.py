"""Operator 9: language identification by a multilingual mixture.

Model: the byte n-grams (order 3, of lower-cased letters with single spaces) of a
text come from a mixture of languages; each language is a smoothed multinomial over
hashed n-grams learned from labelled documents. Expectation-maximisation estimates
a document's proportions, and the language set is selected by penalised likelihood:
languages are ranked by their proportion, the mixture is fitted again for the first
1, 2, ... of them, and the set with the largest log-likelihood less
``penalty * log(n-grams)`` for each further language wins. The prediction is the
language with the largest proportion in that set, the score is that proportion.

The log-likelihood is concave in the proportions, so its slope at the best single
language bounds what further languages can gain; documents where that is below the
penalty need no EM and have the same result without it. The same bound at the fit of
all languages ends the search of a document's set; other documents play no part in it.

Learning counts the n-grams of all labelled rows, spread over tasks. The model has
``BUCKETS`` rows and one column a language, so its size does not depend on the corpus.

Defined cases: null text or text without a letter is ``und`` with score 0; with no
labelled document everything is ``und``; null languages are not learned; equal texts
get equal results; ties go to the language first in alphabetical order; repeated rows
stay; whole texts are read, in pieces; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import learn_bucket, names, text_buffer

BUCKETS = 1 << 16
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)


def gram_counts(raw: np.ndarray, offsets: np.ndarray):
    """``(row, bucket, count)`` of the distinct n-grams of each row, sorted by row."""
    n_rows = len(offsets) - 1
    a = _FOLD[raw]
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    # Single spaces only; every row begins and ends with one.
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != 32) | (a[:-1] != 32) | (row[1:] != row[:-1])
    a, row = a[keep], row[keep]
    if len(a) < 3:
        return (np.zeros(0, np.int64),) * 3
    same = row[2:] == row[:-2]
    x = a.astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    bucket = (code[same] * np.uint32(2654435761)) >> np.uint32(16)
    key, count = np.unique(row[2:][same] * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


def _pieces(raw: np.ndarray, offsets: np.ndarray, size: int = 1 << 20):
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _folded(text: Column) -> Column:
    """Lower case, with a space at both ends."""
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def learn(labelled: DataFrame, text: str, lang: str,
          smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """``(languages, probabilities)``: per language the smoothed n-gram distribution
    of all its rows."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())

    def run(batches):
        import pyarrow as pa
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            raw, offsets = text_buffer(batch.column("text"))
            for i, j, part, bounds in _pieces(raw, offsets):
                row, bucket, count = gram_counts(part, bounds)
                for name in sorted(set(langs[i:j])):
                    mine = (langs[i:j] == name)[row]
                    into = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                    into += np.bincount(bucket[mine], count[mine], BUCKETS).astype(np.int64)
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()),
                                              "bucket": at, "n": counts[at]})

    sums = (rows.select(F.col(lang).alias("lang"), _folded(F.col(text)).alias("text"))
            .mapInArrow(run, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toArrow()
    seen = np.array(sums.column("lang").to_pylist(), object)
    languages = sorted(set(seen))
    probs = np.full((BUCKETS, len(languages)), smoothing)
    bucket, n = sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    for k, name in enumerate(languages):
        probs[bucket[seen == name], k] += n[seen == name]
    return languages, probs / probs.sum(0, keepdims=True) if languages else probs


def _fit(p: np.ndarray, count: np.ndarray, first: np.ndarray, pi: np.ndarray,
         rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for many documents at once: proportions and log-likelihoods. ``first``:
    where each document's n-grams begin."""
    doc = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(count)]))
    total = np.add.reduceat(count, first)
    for _ in range(rounds):
        r = p * pi[doc]
        r *= (count / np.maximum(r.sum(1), 1e-300))[:, None]
        pi = np.add.reduceat(r, first, axis=0) / total[:, None]
    mix = np.maximum((p * pi[doc]).sum(1), 1e-300)
    return pi, np.add.reduceat(count * np.log(mix), first)


def infer(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, n_rows: int,
          probs: np.ndarray, penalty: float, rounds: int = 12):
    """``(language index or -1, proportion, languages in the set)`` for each row."""
    n_lang = probs.shape[1]
    best, share = np.full(n_rows, -1), np.zeros(n_rows)
    size = np.zeros(n_rows, np.int64)
    if not len(row) or not n_lang:
        return best, share, size
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    docs, c = row[first], count.astype(float)
    total = np.add.reduceat(c, first)
    p = probs[bucket]
    single = np.add.reduceat(c[:, None] * np.log(p), first, axis=0)
    top = single.argmax(1)
    best[docs], share[docs], size[docs] = top, 1.0, 1
    cost = penalty * np.log(np.maximum(total, 2.0))
    width = np.diff(np.r_[first, len(c)])
    own = p[np.arange(len(c)), np.repeat(top, width)]
    slope = np.add.reduceat(p * (c / own)[:, None], first, axis=0).max(1) - total
    open_ = np.flatnonzero(slope > cost)
    if not len(open_) or n_lang == 1:
        return best, share, size
    mine = np.isin(np.repeat(np.arange(len(first)), width), open_)
    p, c, w = p[mine], c[mine], width[open_]
    first = np.cumsum(w) - w
    docs, cost, top_score = docs[open_], cost[open_], single[open_].max(1)
    pi, full = _fit(p, c, first, np.full((len(w), n_lang), 1.0 / n_lang), rounds)
    order = np.argsort(-pi, axis=1, kind="stable")
    # No proportions at all give a document more than this (the slope bound at its fit).
    mix = np.maximum((p * pi[np.repeat(np.arange(len(w)), w)]).sum(1), 1e-300)
    reach = full + np.add.reduceat(p * (c / mix)[:, None], first, axis=0).max(1) - total[open_]
    reach += 1e-9 * np.abs(reach)  # rounding
    for k in range(2, n_lang + 1):
        live = reach - (k - 1) * cost > top_score  # each document stops by itself
        if not live.any():
            break
        if not live.all():
            mine = np.repeat(live, w)
            p, c, w = p[mine], c[mine], w[live]
            first = np.cumsum(w) - w
            docs, cost, top_score, reach = docs[live], cost[live], top_score[live], reach[live]
            pi, order = pi[live], order[live]
        start = np.zeros_like(pi)
        np.put_along_axis(start, order[:, :k], np.take_along_axis(pi, order[:, :k], 1) + 1e-6, 1)
        start /= start.sum(1, keepdims=True)
        fitted, score = _fit(p, c, first, start, rounds)
        better = score - (k - 1) * cost > top_score
        top_score = np.where(better, score - (k - 1) * cost, top_score)
        hit = docs[better]
        best[hit], share[hit] = fitted[better].argmax(1), fitted[better].max(1)
        size[hit] = k
    return best, share, size


PENALTY = 25.0


#: The result columns; input columns of these names are replaced by them.
RESULTS = (("lang_pred", "string"), ("score", "double"), ("n_langs", "integer"))


def predict(docs: DataFrame, text: str, model: tuple[list[str], np.ndarray],
            penalty: float = PENALTY, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) plus ``lang_pred``, ``score`` and ``n_langs``."""
    languages, probs = model
    cols = [c for c in (docs.columns if keep is None else keep) if c not in dict(RESULTS)]
    into = docs.select(*cols, F.when(has_letter(F.col(text)), _folded(F.col(text))).otherwise("").alias("__text"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            raw, offsets = text_buffer(batch.column("__text"))
            n = batch.num_rows
            best, share = np.full(n, -1), np.zeros(n)
            size = np.zeros(n, np.int64)
            for i, j, part, bounds in _pieces(raw, offsets):
                best[i:j], share[i:j], size[i:j] = infer(*gram_counts(part, bounds), j - i,
                                                         probs, penalty)
                # A text too short for an n-gram says nothing: the first language is taken.
                short = (best[i:j] < 0) & (np.diff(bounds) > 0)
                if languages and short.any():
                    best[i:j][short], share[i:j][short], size[i:j][short] = \
                        0, 1.0 / len(languages), 1
            named = np.array([*languages, UNDETERMINED], object)[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in cols]
                + [pa.array(named, pa.string()), pa.array(np.clip(share, 0.0, 1.0)),
                   pa.array(size, pa.int32())],
                names=[*cols, "lang_pred", "score", "n_langs"])

    schema = into.select(*cols).schema
    for name, kind in RESULTS:
        schema = schema.add(name, kind)
    return into.mapInArrow(run, schema)


def identify(docs: DataFrame, held_out_mod: int = 5) -> DataFrame:
    """Learn from rows outside the held-out fold, predict every row."""
    names(docs, ["doc_id", "text", "lang"])
    fold = learn_bucket(F.col("doc_id"), held_out_mod) == 0
    model = learn(docs.where(~fold).select("text", "lang"), "text", "lang")
    return predict(docs.withColumn("held_out", fold), "text", model,
                   keep=["doc_id", "held_out"])
