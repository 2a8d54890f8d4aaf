"""Online topics of signed vectors over the embeddings: one update and the rows' mixtures from
a fixed start against SQL, and the embedded topic flow on tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from statflow.operators import models as M
from statflow.operators import online_topics as O
from statflow.plans import flows
from statflow.plans.registry import query
from statflow.sources import read_table

K, SIZE, ROUNDS = 3, 64, 2
ALPHA = ETA = 1.0 / K
RATE = 0.25


def _start() -> O.VectorTopics:
    t, v = np.indices((K, SIZE))
    return O.VectorTopics(1.0 + (t * 31 + v * 17) % 7 / 7.0, ALPHA, ETA)


def _psi_sql(x: str) -> str:
    y = f"({x} + {O.SHIFT})"
    series = " - ".join(f"{c!r}::DOUBLE / pow({y}, {n})" for n, c in O.SERIES).replace("- -", "+ ")
    return f"(ln({y}) - 0.5 / {y} - {series} - " + " - ".join(
        f"1.0::DOUBLE / ({x} + {i})" for i in range(O.SHIFT)) + ")"


def _round_sql(r: int) -> str:
    """The rows' a, x / n and g of one round."""
    return f"""
s{r} AS (SELECT vec_id, topic, g, sum(g) OVER (PARTITION BY vec_id) AS total FROM g{r}),
a{r} AS (SELECT vec_id, topic, exp({_psi_sql('g')} - {_psi_sql('total')}) AS a FROM s{r}),
q{r} AS (SELECT v.vec_id, v.slot, any_value(v.x) / (sum(a * b) + 1e-100) AS q
         FROM v JOIN a{r} USING (vec_id) JOIN b ON b.slot = v.slot AND b.topic = a{r}.topic
         GROUP BY v.vec_id, v.slot),
g{r + 1} AS (SELECT a{r}.vec_id, a{r}.topic,
                {ALPHA!r}::DOUBLE + greatest(0.0::DOUBLE, any_value(a) * sum(b * q)) AS g
         FROM a{r} JOIN q{r} USING (vec_id) JOIN b ON b.slot = q{r}.slot AND b.topic = a{r}.topic
         GROUP BY a{r}.vec_id, a{r}.topic)"""


_BASE_SQL = f"""WITH v AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
                unnest(range(len(embedding))) AS slot FROM embeddings),
k AS (SELECT CAST(unnest(range({K})) AS INTEGER) AS topic),
l AS (SELECT topic, slot, 1.0::DOUBLE + (topic * 31 + slot * 17) % 7 / 7.0::DOUBLE AS l
      FROM k, (SELECT unnest(range({SIZE})) AS slot)),
t AS (SELECT topic, slot, l, sum(l) OVER (PARTITION BY topic) AS total FROM l),
b AS (SELECT topic, slot, l, exp({_psi_sql('l')} - {_psi_sql('total')}) AS b FROM t),
g0 AS (SELECT DISTINCT vec_id, topic, 1.0::DOUBLE AS g FROM v, k),""" + ",".join(
    _round_sql(r) for r in range(ROUNDS))


@query("online_topics_step", _BASE_SQL + "," + _round_sql(ROUNDS) + f""",
z AS (SELECT a{ROUNDS}.topic, q{ROUNDS}.slot, sum(a * q) AS z
      FROM a{ROUNDS} JOIN q{ROUNDS} USING (vec_id) GROUP BY ALL)
SELECT b.topic, b.slot AS term_index,
       round({1 - RATE} * l + {RATE} * ({ETA!r}::DOUBLE + greatest(0.0::DOUBLE, b * z)), 6) AS parameter
FROM b JOIN z USING (topic, slot)""")
def online_topics_step_q(spark, sf_dir):
    """One update over all vectors, from a fixed start, two rounds a row."""
    m = _start()
    n, sums = O.row_sums(m, read_table(spark, sf_dir, "embeddings"), "embedding", ROUNDS, 0.0)
    m = O.updated(m, sums, 1.0, RATE)
    rows = [(t, v, float(m.parameters[t, v])) for t in range(K) for v in range(SIZE)]
    out = spark.createDataFrame(rows, "topic int, term_index long, parameter double")
    return out.select("topic", "term_index", F.round("parameter", 6).alias("parameter"))


@query("online_topic_mixtures", _BASE_SQL + f"""
SELECT vec_id, topic, round(g / sum(g) OVER (PARTITION BY vec_id), 8) AS weight FROM g{ROUNDS}""")
def online_topic_mixtures_q(spark, sf_dir):
    """The shares of each vector under fixed topics, two rounds a row."""
    out = O.mixtures(_start(), read_table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", ROUNDS, 0.0)
    return out.select("vec_id", "topic", F.round("weight", 8).alias("weight"))


@query("topic_model_embedded_online")
def topic_model_embedded_online_q(spark, sf_dir):
    """J4 with nothing of the vocabulary on the driver: term vectors as tables, their means,
    online topics."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tm, _ = flows.topic_model_embedded(docs, "text", vector_size=16, optimizer="online",
                                       embedder="table", key="doc_id")
    return M.topics(tm.lda, 5)
