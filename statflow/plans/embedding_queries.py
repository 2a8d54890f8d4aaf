"""Term embeddings over the documents: counts, weights and one product of the range finder
against SQL from the same fixed start; the vectors themselves are checked by tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from statflow.functions.arrays import explode_values
from statflow.operators import embeddings as E
from statflow.plans.queries import DOC_TERMS_SQL, _doc_terms
from statflow.plans.registry import query

WINDOW, SIZE, STEP_COLUMNS = 2, 16, 3

_COUNTS_SQL = f"""WITH {DOC_TERMS_SQL},
p AS (SELECT doc_id, unnest(f) AS term, unnest(range(len(f))) AS place FROM d),
c AS (SELECT a.term, b.term AS context, count(*) AS n FROM p a JOIN p b
      ON a.doc_id = b.doc_id AND abs(a.place - b.place) BETWEEN 1 AND {WINDOW} GROUP BY ALL)"""
_PMI_SQL = _COUNTS_SQL + """,
t AS (SELECT term, CAST(sum(n) AS DOUBLE) AS n FROM c GROUP BY term),
m AS (SELECT c.term, c.context, ln(c.n * (SELECT sum(n) FROM t) / (a.n * b.n)) AS weight
      FROM c JOIN t a ON a.term = c.term JOIN t b ON b.term = c.context
      WHERE c.n * (SELECT sum(n) FROM t) / (a.n * b.n) > 1)"""


def _counts(spark, sf_dir):
    return E.cooccurrences(_doc_terms(spark, sf_dir).select("filtered"), "filtered", WINDOW)


@query("cooccurrences", _COUNTS_SQL + " SELECT term, context, n FROM c")
def cooccurrences_q(spark, sf_dir):
    """Words at most two places apart, stop words removed."""
    return _counts(spark, sf_dir)


@query("positive_pmi", _PMI_SQL + " SELECT term, context, round(weight, 8) AS weight FROM m")
def positive_pmi_q(spark, sf_dir):
    """The matrix whose leading eigenvectors are the embeddings."""
    pmi = E.positive_pmi(_counts(spark, sf_dir))
    return pmi.select("term", "context", F.round("weight", 8).alias("weight"))


def _start_sql(j: int) -> str:
    return (f"(CAST('0x' || substr(md5('42:{j}:' || context), 1, 12) AS BIGINT) + 0.5::DOUBLE)"
            " / 281474976710656.0::DOUBLE - 0.5::DOUBLE")


@query("embedding_step", _PMI_SQL + " SELECT term, " + ", ".join(
    f"round(sum(weight * ({_start_sql(j)})), 6) AS y{j}" for j in range(STEP_COLUMNS)) + " FROM m GROUP BY term")
def embedding_step_q(spark, sf_dir):
    """The matrix times the fixed start of the range finder."""
    pmi = E.positive_pmi(_counts(spark, sf_dir))
    out = E.multiply(pmi, E.start_block(pmi, STEP_COLUMNS), STEP_COLUMNS)
    return out.select("term", *[F.round(f"y{j}", 6).alias(f"y{j}") for j in range(STEP_COLUMNS)])


@query("document_embeddings")
def document_embeddings_q(spark, sf_dir):
    """The mean of the vectors of each document's words."""
    docs = _doc_terms(spark, sf_dir).select("doc_id", "filtered")
    model = E.embed_terms(docs, "filtered", SIZE, WINDOW)
    means = E.mean_vectors(docs, ["doc_id"], "filtered", model)
    values = F.array(*[F.col(f"v{j}") for j in range(model.size)]).cast("array<double>")
    return explode_values(means, ["doc_id"], values, "value", pos="slot")
