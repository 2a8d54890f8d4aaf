"""Fitted models against what must hold of them: each query fits a model, applies it and
returns rows that SQL can state without the fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from statflow.operators import lda as tables
from statflow.operators import models as M
from statflow.plans import flows
from statflow.plans.queries import DOC_TERMS_SQL
from statflow.plans.registry import query

_HELD_OUT = f"{flows._SPLIT_U} >= 0.7::DOUBLE"


def _agreeing(scored):
    """Prediction and probability tell the same; the probability is one."""
    agrees = ((F.col("prediction") == (F.col("p1") > 0.5).cast("double"))
              & F.col("p1").between(0.0, 1.0))
    return scored.select(*flows.LP_KEYS, "label", agrees.alias("agrees"))


@query("logistic_checked", f"""
SELECT l_orderkey, l_linenumber, CAST(l_discount > 0.05 AS INTEGER) AS label, true AS agrees
FROM lineitem WHERE {_HELD_OUT}
""")
def logistic_checked(spark, sf_dir):
    return _agreeing(flows.logistic_q(spark, sf_dir))


@query("flight_delay_model_checked", f"""
SELECT l_orderkey, l_linenumber, CAST(l_discount > 0.05 AS INTEGER) AS label, true AS agrees
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_HELD_OUT}
""")
def flight_delay_model_checked(spark, sf_dir):
    return _agreeing(flows.flight_delay_model_q(spark, sf_dir))


@query("logistic_calibrated", f"""
SELECT round(avg(CAST(l_discount > 0.05 AS INTEGER)), 3) AS label_mean,
       round(avg(CAST(l_discount > 0.05 AS INTEGER)), 3) AS fitted_mean
FROM lineitem WHERE NOT ({_HELD_OUT})
""")
def logistic_calibrated(spark, sf_dir):
    """With an intercept, the mean fitted probability of the training rows is their
    label mean."""
    train, _, model = flows.logistic_fit(spark, sf_dir)
    fitted = M.predict(model, train, "label").select(
        "label", F.col("probability")[1].alias("p1"))
    return fitted.agg(F.round(F.avg("label"), 3).alias("label_mean"),
                      F.round(F.avg("p1"), 3).alias("fitted_mean"))


@query("doc_topics_checked", f"""
WITH {DOC_TERMS_SQL}
SELECT doc_id, CAST(5 AS BIGINT) AS topics,
       CASE WHEN len(f) >= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM d
""")
def doc_topics_checked(spark, sf_dir):
    """A document's topic weights sum to one (to zero without a term)."""
    return flows.doc_topics_q(spark, sf_dir).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("topics"), F.round(F.sum("weight"), 6).alias("weight"))


_RANKS = "(SELECT unnest(range(0, 5)) AS topic), (SELECT unnest(range(0, {n})) AS rank)"


@query("topic_model_checked", f"""
SELECT CAST(topic AS INTEGER) AS topic, CAST(rank AS INTEGER) AS rank, true AS known, true AS falls
FROM {_RANKS.format(n=10)}
""")
def topic_model_checked(spark, sf_dir):
    """Ten terms a topic, all of the vocabulary, weights falling with the rank."""
    from pyspark.sql import Window
    words = flows.topic_model_q(spark, sf_dir)
    before = F.lag("weight").over(Window.partitionBy("topic").orderBy("rank"))
    return words.select("topic", "rank", F.col("term").isNotNull().alias("known"),
                        F.coalesce(F.col("weight") <= before, F.lit(True)).alias("falls"))


@query("lda_topics_checked", f"""
SELECT CAST(topic AS INTEGER) AS topic, CAST(rank AS INTEGER) AS rank, true AS positive
FROM {_RANKS.format(n=5)}
""")
def lda_topics_checked(spark, sf_dir):
    return flows.lda_topics_q(spark, sf_dir).select(
        "topic", "rank", (F.col("weight") > 0).alias("positive"))


_K, _SMOOTH = 5, 0.2


def _step_sql(select: str) -> str:
    """One update of the topic table from its fixed start, term weights by tf-idf."""
    k = range(_K)
    start = ", ".join(f"(CAST('0x' || substr(md5('42:{j}:' || term), 1, 12) AS BIGINT) + 0.5::DOUBLE)"
                      f" / 281474976710656.0::DOUBLE AS c{j}" for j in k)
    total = ", ".join(f"sum(c{j}) AS t{j}" for j in k)
    p = ", ".join(f"(c{j} + {_SMOOTH}::DOUBLE) / (t{j} + v * {_SMOOTH}::DOUBLE) AS p{j}" for j in k)
    share = ", ".join(f"w * p{j} / ({' + '.join(f'p{i}' for i in k)}) AS g{j}" for j in k)
    sums = ", ".join(f"sum(g{j}) AS n{j}" for j in k)
    return f"""WITH {DOC_TERMS_SQL},
tc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(bigrams) AS term FROM d) GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS term_index
          FROM tc GROUP BY term),
s AS (SELECT term, term_index, df, {start} FROM vocab),
t AS (SELECT {total}, count(*) AS v FROM s),
e AS (SELECT doc_id, term, term_index, tf * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (df + 1)) AS w, {p}
      FROM tc JOIN s USING (term), t),
g AS MATERIALIZED (SELECT doc_id, term, term_index, {share} FROM e WHERE w > 0),
n AS (SELECT term, term_index, {sums} FROM g GROUP BY ALL),
a AS (SELECT {", ".join(f"sum(n{j}) AS a{j}" for j in k)} FROM n),
m AS (SELECT doc_id, {sums}, sum({' + '.join(f'g{j}' for j in k)}) AS total FROM g GROUP BY doc_id)
{select}"""


_STEP_TERMS = " UNION ALL ".join(
    f"SELECT {j} AS topic, term, term_index, (n{j} + {_SMOOTH}::DOUBLE) / (a{j} + v * {_SMOOTH}::DOUBLE) AS weight FROM n, a, t"
    for j in range(_K))
_STEP_DOCS = " UNION ALL ".join(
    f"SELECT doc_id, {j} AS topic, round((n{j} + {_SMOOTH}::DOUBLE) / (total + {_K} * {_SMOOTH}::DOUBLE), 8) AS weight FROM m"
    for j in range(_K))


def _one_step(spark, sf_dir):
    terms = flows.text_terms(flows.spread(flows._documents(spark, sf_dir), flows.TEXT_TASKS, "doc_id"), "text")
    vocab, rows = M.weighted_terms(terms.select("doc_id", "ngrams"), "doc_id", "ngrams")
    return vocab, tables.fit_topics(tables.entries(rows, "doc_id"), vocab, _K, 1)


@query("lda_step_topics", _step_sql(f"""
SELECT topic, CAST(rank AS INTEGER) AS rank, term, round(weight * 1000000, 5) AS per_million
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term_index) - 1 AS rank
      FROM ({_STEP_TERMS})) WHERE rank < 20"""))
def lda_step_topics(spark, sf_dir):
    """One update of the topic table from its fixed start; 20 terms a topic."""
    vocab, m = _one_step(spark, sf_dir)
    words = M.topic_words(M.TopicModel(vocab, None, m, "terms"), 20)
    return words.select("topic", "rank", "term", F.round(F.col("weight") * 1000000, 5).alias("per_million"))


@query("lda_step_docs", _step_sql(_STEP_DOCS))
def lda_step_docs(spark, sf_dir):
    """The documents' mixtures after the same update."""
    _, m = _one_step(spark, sf_dir)
    total = sum((F.col(f"c{j}") for j in range(1, _K)), F.col("c0")) + _K * _SMOOTH
    return m.docs.select(F.col("d").alias("doc_id"), F.inline(F.array(*[
        F.struct(F.lit(j).alias("topic"), F.round((F.col(f"c{j}") + _SMOOTH) / total, 8).alias("weight"))
        for j in range(_K)])))


def _newton_sql(select: str, steps: int = 8) -> str:
    """Newton steps of a logistic regression on two columns, unrolled: each step solves
    its 3 x 3 system by Cramer's rule."""
    def det(m):
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    h = [["h0", "h1", "h2"], ["h1", "h3", "h4"], ["h2", "h4", "h5"]]
    solved = []
    for k in range(3):
        swapped = [[f"g{r}" if c == k else h[r][c] for c in range(3)] for r in range(3)]
        solved.append(f"b{k} + {det(swapped)} / {det(h)} AS b{k}")
    ctes = f"""x AS MATERIALIZED (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS q, CAST(l_tax AS DOUBLE) AS t,
  CAST(l_discount > 0.05 AS INTEGER) AS y, {_HELD_OUT} AS held_out FROM lineitem),
w0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"""
    for k in range(steps):
        ctes += f""",
s{k} AS MATERIALIZED (SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2,
  sum(v) AS h0, sum(v * q) AS h1, sum(v * t) AS h2, sum(v * q * q) AS h3, sum(v * q * t) AS h4, sum(v * t * t) AS h5,
  sum(y - p) AS g0, sum((y - p) * q) AS g1, sum((y - p) * t) AS g2
  FROM (SELECT *, p * (1 - p) AS v FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * q + b2 * t))) AS p
        FROM x, w{k} WHERE NOT held_out))),
w{k + 1} AS MATERIALIZED (SELECT {', '.join(solved)} FROM s{k})"""
    return f"WITH {ctes} {select.format(w=f'w{steps}')}"


def _newton(spark, sf_dir):
    from statflow.functions.scalars import binarise
    from statflow.operators.features import split
    from statflow.sources import read_table
    li = read_table(spark, sf_dir, "lineitem").select(*flows.LP_KEYS, "l_quantity", "l_tax",
                                                      binarise("l_discount", 0.05).alias("label"))
    train, test = split(li, [0.7, 0.3], 42, flows.LP_KEYS)
    return M.fit_logistic(train, ["l_quantity", "l_tax"], "label"), test


@query("logistic_coefficients", _newton_sql("""
SELECT 'const' AS term, round(b0, 7) AS beta FROM {w} UNION ALL SELECT 'l_quantity', round(b1, 7) FROM {w}
UNION ALL SELECT 'l_tax', round(b2, 7) FROM {w}"""))
def logistic_coefficients(spark, sf_dir):
    """M8: the coefficients of the Newton fit."""
    fit, _ = _newton(spark, sf_dir)
    beta = [fit.intercept, *fit.coefficients]
    return spark.createDataFrame([(t, round(float(b), 7)) for t, b in zip(["const", "l_quantity", "l_tax"], beta)],
                                 "term string, beta double")


@query("logistic_predictions", _newton_sql("""
SELECT l_orderkey, l_linenumber, y AS label, round(p, 7) AS p1, CAST(p > 0.5 AS DOUBLE) AS prediction
FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * q + b2 * t))) AS p FROM x, {w} WHERE held_out)"""))
def logistic_predictions(spark, sf_dir):
    """M9: the held-out rows scored by the same fit."""
    fit, test = _newton(spark, sf_dir)
    return M.predict(fit, test, "label", keep=flows.LP_KEYS).select(
        *flows.LP_KEYS, "label", F.round(F.col("probability")[1], 7).alias("p1"), "prediction")

