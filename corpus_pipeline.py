"""The corpus pipeline: four stages over the documents table, each a training-data operator.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import language, mixing, near_join, packing
from statflow.llm.common import ship_code, stage, table
from statflow.llm.tokens import default_tokenizer

MAX_REPEATS = 2.0
SEQUENCE_TOKENS = 2048


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, learned from these documents' own labels: a null ``lang`` becomes the
    predicted language, or stays null where no label can be learned. Documents without a
    letter go; every other document stays."""
    ship_code(spark)
    model = language.learn(docs, "text", "lang")
    # Under names of their own the documents' columns cannot clash with the results.
    own = docs.toDF(*[f"doc_{c}" for c in docs.columns])
    marked = language.predict(own.where(language.has_letter(F.col("doc_text"))), "doc_text", model)
    known = F.nullif(F.col("lang_pred"), F.lit(language.UNDETERMINED))
    filled = marked.withColumn("doc_lang", F.coalesce("doc_lang", known))
    return filled.select(*[F.col(f"doc_{c}").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each class of copies and near copies the smallest doc_id stays."""
    ship_code(spark)
    return near_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: poor sources are read up to ``MAX_REPEATS`` times, the weights as flat
    as that allows; the budget covers every source once, so no document goes."""
    ship_code(spark)
    return mixing.mixed_rows(docs, target_part=None, max_repeats=MAX_REPEATS, budget="cover")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the mixture's documents in sequences of ``SEQUENCE_TOKENS`` tokens."""
    ship_code(spark)
    return packing.pack_documents(docs, default_tokenizer(), SEQUENCE_TOKENS)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language models, min-hashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
