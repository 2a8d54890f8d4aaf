"""Models (A10, M8-M16): least squares from one aggregate pass, logistic
regression, term statistics, Word2Vec and LDA topics.

Vocabularies stay tables: a document's terms are built by joining term counts with
the ranked vocabulary. Topic models of term counts are tables too (``lda``). What
reaches the driver is a fitted model: the p x p cross-product matrix, coefficients and the
topics of word vectors. Word vectors are trained in blocks of rows (``skipgram``).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions.arrays import explode_values
from statflow.operators import lda as tables
from statflow.operators import linear, skipgram, vector_em
from statflow.operators.aggregates import gram
from statflow.operators.embeddings import TermVectors
from statflow.operators.online_topics import VectorTopics
from statflow.operators.ordering import global_rank
from statflow.session import discard, ensure_checkpoint_dir, stored

# ---------------------------------------------------------------- least squares


def ols(df: DataFrame, xs: Sequence[str], y: str, intercept: bool = True,
        exact_scale: int | None = None, tol: float = linear.TOL) -> DataFrame:
    """A10: coefficients ``(term, beta)``, intercept first, from one scan.

    Tall-skinny QR over the rows complete in all columns (``exact_scale``: the exact DECIMAL
    cross-products of ``gram`` instead). A term that the terms before it determine is
    aliased: its beta is null, the others are those of the regression without it.
    """
    terms = (["const"] if intercept else []) + list(xs)
    if exact_scale is None:
        r = linear.triangular_factor(df, [*xs, y], intercept)
    else:
        r = linear.factor_of_gram(gram_matrix(gram(df, xs, y, intercept, exact_scale).collect(), len(terms) + 1))
        tol = max(tol, 1e-5)
    return coefficients(df.sparkSession, terms, linear.solve_aliased(r, len(terms), tol))


def coefficients(spark: SparkSession, terms: Sequence[str], beta: Sequence[float | None]) -> DataFrame:
    return spark.createDataFrame(list(zip(terms, beta)), "term string, beta double")


def gram_matrix(entries, n: int) -> np.ndarray:
    """The symmetric matrix of the collected rows of ``gram``."""
    g = np.zeros((n, n))
    for r in entries:
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["value"]
    return g


# ---------------------------------------------------------------- logistic regression


def fit_logistic(df: DataFrame, features: str = "features", label: str = "label", solver: str = "newton",
                 **params) -> linear.LogisticFit | LogisticRegressionModel:
    """M8: logistic regression without a penalty, threshold 0.5.

    ``newton`` (default): see ``linear.fit_logistic_newton``; the score of every feature is
    zero at the end. ``lbfgs``: Spark's own, defaults as Spark (100 iterations). The
    training rows are persisted for the iterations.
    """
    if solver == "newton":
        return linear.fit_logistic_newton(df, features, label, **params)
    fit = LogisticRegression(featuresCol=features, labelCol=label, **params).fit
    return fit_persisted(df.select(features, label), fit)


def predict(model, df: DataFrame, label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """M9: ``keep..., label, probability ARRAY<DOUBLE>, prediction``."""
    scored = model.transform(df)
    p = F.col("probability")
    if not isinstance(model, linear.LogisticFit):
        p = vector_to_array(p)
    return scored.select(*keep, label, p.alias("probability"), "prediction")


# ---------------------------------------------------------------- term statistics (SQL form)


def term_counts(df: DataFrame, doc: str, terms: str) -> DataFrame:
    """M10, SQL form: ``(doc, term, tf)``, one row per term present in a document."""
    return (explode_values(df, [doc], terms, "term")
            .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))


def tf_idf(df: DataFrame, doc: str, terms: str) -> DataFrame:
    """``(doc, term, tf, df, idf, tf_idf)`` with idf = ln((m+1)/(df+1)),
    m = number of documents (rows of ``df``), as Spark ML's IDF.

    The join is on the term and its length: neither side is partitioned that way
    already, so both get an exchange of their own below the join, and adaptive
    execution can split the rows of a very common term (it cannot split a side
    that is an aggregate directly below the join). Terms of one document, most of a
    vocabulary of n-grams, need no exchange for that: what the join does not find has df 1.
    Rows that ``df`` holds dealt by ``doc`` are counted where they are.
    """
    m = df.agg(F.count(F.lit(1))).scalar()
    tc = term_counts(df, doc, terms)
    # Counts rows (tf >= 1 always), but referencing tf keeps this branch's
    # input identical to tc's, so Spark reuses tc's shuffle instead of
    # tokenising the corpus a second time. (A plain count(tf) would be
    # rewritten to count(1) and tf pruned again.)
    dfreq = tc.groupBy("term").agg(
        F.count(F.when(F.col("tf") > 0, F.col("tf"))).alias("df")).where("df > 1")
    out = (tc.withColumn("__n", F.length("term"))
           .join(dfreq.withColumn("__n", F.length("term")), ["term", "__n"], "left")
           .withColumn("df", F.coalesce("df", F.lit(1).cast("long"))))
    idf = F.log((m + F.lit(1)) / (F.col("df") + F.lit(1)))
    return out.select(doc, "term", "tf", "df", idf.alias("idf"),
                      (F.col("tf") * idf).alias("tf_idf"))


def vocabulary(df: DataFrame, doc: str, terms: str, vocab_size: int | None = None,
               min_df: int = 1) -> DataFrame:
    """Ranked vocabulary ``(term_index, term, ttf, df)``: total count descending,
    ties by term; 0-based index; ``vocab_size`` keeps the top terms.

    The ranking is computed distributed (range partitions plus offsets), not
    with ``orderBy().limit(k)``, whose final merge would pull k rows from every
    partition into a single task.
    """
    return ranked_terms(term_counts(df, doc, terms), vocab_size, min_df)


def ranked_terms(tc: DataFrame, vocab_size: int | None = None, min_df: float = 1) -> DataFrame:
    """``vocabulary`` of a table of ``term_counts``."""
    stats = (tc.groupBy("term").agg(F.sum("tf").alias("ttf"), F.count(F.lit(1)).alias("df"))
             .where(F.col("df") >= min_df))
    ranked = global_rank(stats, [F.desc("ttf"), F.asc("term")], "rank")
    if vocab_size is not None:
        ranked = ranked.where(F.col("rank") <= vocab_size)
    return ranked.select((F.col("rank") - 1).cast("int").alias("term_index"), "term",
                         "ttf", "df")


def in_blocks(df: DataFrame, keys: Sequence[str], blocks: int, out: str = "block") -> DataFrame:
    """``df`` with the number of its block, dealt by it; rows of equal keys share a block.

    A block's distinct words are far fewer than its words: a table is looked up for them
    alone, and their rows go to the block, whose rows stay where they are.
    """
    return df.withColumn(out, F.pmod(F.hash(*keys), F.lit(blocks))).repartition(blocks, out)


def block_terms(df: DataFrame, terms: str) -> DataFrame:
    """``(block, term, n)``: the distinct terms of each block of ``in_blocks`` and their counts."""
    return stored(explode_values(df, ["block"], terms, "term")
                  .groupBy("block", "term").agg(F.count(F.lit(1)).alias("n")))


def _flat(lists):
    """``(row, place in the row, value)`` of the elements of an Arrow list array."""
    import pyarrow.compute as pc
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size), lists.flatten()


def _equal(values, known) -> tuple[np.ndarray, np.ndarray]:
    """``(at, which)``: for each of ``values`` the places of ``known`` that equal it, -1 if none."""
    import pyarrow.compute as pc
    kinds = known.drop_null().unique()
    code = pc.index_in(known, kinds, skip_nulls=True).fill_null(len(kinds)).to_numpy(zero_copy_only=False)
    order, count = np.argsort(code, kind="stable"), np.bincount(code, minlength=len(kinds) + 1)
    begin = np.cumsum(count) - count
    count[len(kinds):] = 0
    found = pc.index_in(values, kinds, skip_nulls=True).fill_null(len(kinds)).to_numpy(zero_copy_only=False)
    n = np.maximum(count[found], 1)
    at = np.repeat(np.arange(len(found)), n)
    place = begin[found][at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    hit = count[found][at] > 0
    which = np.full(len(at), -1, np.int64)
    which[hit] = order[place[hit]]
    return at, which


def encode(df: DataFrame, key: str, terms: str, held: DataFrame, vocab: DataFrame, out: str) -> DataFrame:
    """``(key, out)``: each key's terms as indices of ``vocab``, by place in the array; terms
    outside it and keys without any go. ``df`` is dealt by ``in_blocks`` on ``key``, ``held``
    its ``block_terms``; rows of equal keys are one, their terms side by side."""
    kind = dict(df.dtypes)
    codes = held.join(vocab.select("term", "term_index"), "term").select("block", "term", "term_index")

    def run(left, right):
        import pyarrow as pa
        import pyarrow.compute as pc
        row, pos, values = _flat(left.column(terms).combine_chunks())
        at, which = _equal(values, right.column("term").combine_chunks())
        hit = which >= 0
        at, which = at[hit], which[hit]
        names = left.column(key).combine_chunks().dictionary_encode("encode")
        doc = names.indices.to_numpy(zero_copy_only=False)[row[at]]
        index = right.column("term_index").to_numpy()[which]
        if len(names.dictionary) < len(left) or len(right) > pc.count_distinct(right.column("term")).as_py():
            order = np.lexsort((index, pos[at], doc))
            doc, index = doc[order], index[order]
        size = np.bincount(doc, minlength=len(names.dictionary))
        some = size > 0
        offsets = np.r_[0, np.cumsum(size[some])].astype(np.int32)
        return pa.table({key: names.dictionary.filter(pa.array(some)),
                         out: pa.ListArray.from_arrays(pa.array(offsets), pa.array(index, pa.int32()))})

    pairs = df.select("block", key, terms).groupBy("block").cogroup(codes.groupBy("block"))
    return pairs.applyInArrow(run, f"{key} {kind[key]}, {out} array<int>")


def lookup_long(df: DataFrame, keys: Sequence[str], idx: str, vocab: DataFrame,
                index_col: str = "term_index", term_col: str = "term",
                blocks: int | None = None) -> DataFrame:
    """Y5 as long rows ``(keys..., pos, term_index, term)``: array positions of
    ``idx`` looked up in a vocabulary table (join on the index; Spark
    broadcasts the vocabulary when its size allows). With ``blocks``, the rows are dealt
    to so many blocks, and a block asks for each of its indices once."""
    names = vocab.select(index_col, term_col)
    if blocks is None:
        return explode_values(df, keys, idx, index_col, pos="pos").join(names, index_col, "left")
    rows = in_blocks(df.select(*keys, idx), keys, blocks, "__b")
    # The keys' hash is of no use but that both branches read the same columns, so that
    # Spark deals the rows once.
    asked = (explode_values(rows.select(F.col("__b").alias("__c"), F.hash(*keys).alias("__k"), idx),
                            ["__c", "__k"], idx, index_col)
             .groupBy("__c", index_col).agg(F.min("__k").alias("__k")))
    kind = {**dict(df.dtypes), **dict(asked.dtypes), **dict(names.dtypes)}

    def run(left, right):
        import pyarrow as pa
        row, pos, values = _flat(left.column(idx).combine_chunks())
        at, which = _equal(values, right.column(index_col).combine_chunks())
        at_row = pa.array(row[at])
        return pa.table({index_col: values.take(pa.array(at)),
                         **{c: left.column(c).combine_chunks().take(at_row) for c in keys},
                         "pos": pa.array(pos[at], pa.int32()),
                         term_col: right.column(term_col).combine_chunks().take(pa.array(which, mask=which < 0))})

    schema = ", ".join(f"`{c}` {kind[c]}" for c in [index_col, *keys]) + f", pos int, `{term_col}` {kind[term_col]}"
    found = asked.join(names, index_col)
    return rows.groupBy("__b").cogroup(found.groupBy("__c")).applyInArrow(run, schema)


def lookup(df: DataFrame, idx: str, vocab: DataFrame, out: str,
           index_col: str = "term_index", term_col: str = "term") -> DataFrame:
    """Index array -> term array, order kept, one result for every row of ``df``.

    Rows are told apart by their own number, so equal rows keep their own arrays;
    a null array stays null, an empty one stays empty, an unknown index is null.
    """
    cols = df.columns
    rows = df.withColumn("__row", F.monotonically_increasing_id())
    ex = rows.select("*", F.posexplode_outer(idx).alias("__pos", "__i"))
    names = vocab.select(F.col(index_col).alias("__v"), F.col(term_col).alias("__t"))
    long = ex.join(names, F.col("__i") == F.col("__v"), "left")
    entry = F.when(F.col("__pos").isNotNull(), F.struct("__pos", "__t"))
    packed = long.groupBy("__row").agg(*[F.first(c).alias(c) for c in cols],
                                       F.array_sort(F.collect_list(entry)).alias("__w"))
    words = F.transform("__w", lambda e: e["__t"])
    return packed.select(*cols, F.when(F.col(idx).isNotNull(), words).alias(out))


# ---------------------------------------------------------------- topic models


@dataclass
class TopicModel:
    """``vocab``: table ``term_index, term, ttf, df``; None for word-vector models. ``lda``: a
    table of topics, or a model of topics over word vectors."""

    vocab: DataFrame | None
    embedder: skipgram.WordVectors | TermVectors | None
    lda: tables.TopicTable | VectorTopics | vector_em.EmTopics | LDAModel
    features: str


def weighted_terms(df: DataFrame, key: str, terms: str, vocab_size: int | None = None,
                   min_df: float = 1.0, out: str = "terms") -> tuple[DataFrame, DataFrame]:
    """``(vocabulary table, rows (key, terms))``, where ``terms`` holds a document's
    ``(term_index, weight)`` by index, weighted by tf-idf.

    The vocabulary is every term (``vocab_size`` keeps the most frequent ones;
    ``min_df`` below 1 is a fraction of the documents), ranked on the executors and
    joined to the term counts; a document without terms has an empty array. ``key``
    identifies the rows of ``df``. Both are tables of the checkpoint folder.
    """
    m = df.count()
    # Read twice: the texts are tokenised once.
    tc = stored(term_counts(df, key, terms))
    vocab = ranked_terms(tc, vocab_size, min_df if min_df >= 1.0 else min_df * m)
    weight = F.col("tf") * F.log(F.lit(m + 1.0) / (F.col("df") + F.lit(1)))
    packed = (tc.withColumn("__n", F.length("term"))
              .join(vocab.withColumn("__n", F.length("term")), ["term", "__n"])
              .groupBy(key).agg(F.array_sort(F.collect_list(
                  F.struct("term_index", weight.alias("weight")))).alias(out)))
    kind = packed.schema[out].dataType
    rows = stored(df.select(key).join(packed, key, "left").select(
        key, F.coalesce(out, F.array().cast(kind)).alias(out)))
    discard(tc)
    return vocab, rows


def term_vectors(df: DataFrame, key: str, terms: str, vocab_size: int | None = None,
                 min_df: float = 1.0, out: str = "tfidf_vec") -> tuple[DataFrame, DataFrame]:
    """``weighted_terms`` as sparse ML vectors: ``(vocabulary table, rows (key, tfidf_vec))``.

    The vectors' parts (size, indices, values) are written to the checkpoint folder and
    read back as the vectors they are: no Python function builds them.
    """
    vocab, rows = weighted_terms(df, key, terms, vocab_size, min_df)
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(vocab.count()).alias("size"),
                     F.transform("terms", lambda e: e["term_index"]).alias("indices"),
                     F.transform("terms", lambda e: e["weight"]).alias("values"))
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/term-vectors-{uuid.uuid4().hex}"
    rows.select(key, parts.alias(out)).write.parquet(path)
    schema = T.StructType([df.schema[key], T.StructField(out, VectorUDT())])
    return vocab, spark.read.schema(schema).parquet(path)


def fit_persisted(df: DataFrame, fit):
    """Run an iterative ``fit(df)`` over a persisted copy of ``df`` (memory,
    spilling to disk), released afterwards: every iteration would otherwise
    recompute the whole lineage (tokenising included)."""
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit(cached)
    finally:
        cached.unpersist(blocking=False)


def median_vector_size(df: DataFrame, terms: str) -> int:
    """Vector size rule of the embedding flow: median term count per row (whole number)."""
    med = df.agg(F.percentile(F.size(terms), F.lit(0.5))).first()[0]
    return max(1, int(math.floor(float(med or 1) + 0.5)))


def embed(df: DataFrame, terms: str, out: str = "word_vec", vector_size: int | str = "median",
          min_count: int = 0, seed: int = 42, num_partitions: int = 8):
    """Skip-gram vectors (``skipgram``); a row's vector is the mean of its terms' vectors.

    ``vector_size='median'`` uses the median term count per row. The result depends on
    ``num_partitions`` (blocks that train at once, more when they outgrow a task), so it
    is an argument, not derived from the machine.
    """
    size = median_vector_size(df, terms) if vector_size == "median" else int(vector_size)
    return skipgram.embed(df, terms, out, size, min_count, seed, num_partitions)


def fit_lda(df: DataFrame, features: str, k: int = 5, max_iter: int = 10, seed: int = 42,
            optimizer: str = "online") -> vector_em.EmTopics | LDAModel:
    """LDA on vectors (the topic matrix is on the driver), with the defaults of
    the topic workloads (k=5, 10 iterations, online optimiser), seeded. ``online`` is Spark's;
    ``em`` makes the updates of Spark's by passes over the rows (``vector_em``)."""
    if optimizer == "em":
        return fit_persisted(df.select(features), lambda rows: vector_em.fit_em(rows, features, k, max_iter, seed))
    lda = LDA(featuresCol=features, k=k, maxIter=max_iter, seed=seed, optimizer=optimizer)
    return fit_persisted(df.select(features), lda.fit)


def topics(model: tables.TopicTable | VectorTopics | vector_em.EmTopics | LDAModel, m: int = 10) -> DataFrame:
    """Top ``m`` terms per topic as long rows ``(topic, rank, term_index, weight)``."""
    if isinstance(model, VectorTopics | vector_em.EmTopics):
        return SparkSession.active().createDataFrame(
            model.top(m), "topic int, rank int, term_index int, weight double")
    if isinstance(model, tables.TopicTable):
        return tables.top_terms(model, m)
    desc = model.describeTopics(m)
    return desc.select(
        "topic",
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"),
    ).select("topic", "rank", F.col("tw.termIndices").alias("term_index"),
             F.col("tw.termWeights").alias("weight"))


def topic_words(tm: TopicModel, m: int = 10) -> DataFrame:
    """``(topic, rank, term_index, term, weight)``: the k x m rows of the topic
    table joined with the vocabulary table."""
    names = tm.vocab.select("term_index", "term")
    # k x m rows.
    return names.join(F.broadcast(topics(tm.lda, m)), "term_index", "right").select(
        "topic", "rank", "term_index", "term", "weight")


def doc_topics(model: tables.TopicTable | vector_em.EmTopics | LDAModel, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-document topic mixture as long rows ``(keys..., topic, weight)``."""
    if isinstance(model, tables.TopicTable):
        if len(keys) != 1:
            raise ValueError("a topic table takes documents with one key column")
        return explode_values(tables.mixtures(model, df, keys[0]), keys, "weights", "weight", pos="topic")
    if isinstance(model, vector_em.EmTopics):
        return vector_em.mixtures(model, df, keys)
    mixed = model.transform(df)
    return explode_values(mixed, keys, vector_to_array("topicDistribution"), "weight",
                          pos="topic")
