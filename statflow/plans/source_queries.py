"""S1-S5, K1 and J5 on the test tables: tables written as text to the shared folder,
read back by each reader."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow import sinks, sources
from statflow.plans import flows
from statflow.plans.registry import query
from statflow.session import ensure_checkpoint_dir
from statflow.sources import read_table


def _folder(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def _text(spark, df, what: str) -> str:
    path = _folder(spark, what)
    sinks.write_lines(df, path)
    return path


_PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType()),
    T.StructField("extra", T.StringType())])


@query("read_csv", """
SELECT p_partkey, p_name, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size END AS p_size,
       CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS DOUBLE) AS p_retailprice,
       CAST(NULL AS VARCHAR) AS extra
FROM part
""")
def read_csv_q(spark, sf_dir):
    """Declared schema; NA in a number is null, a missing field is null."""
    size = F.when(F.col("p_size") % 10 == 0, "NA").otherwise(F.col("p_size").cast("string"))
    lines = read_table(spark, sf_dir, "part").select(F.concat_ws(
        ",", F.col("p_partkey").cast("string"), "p_name", size,
        F.col("p_retailprice").cast("decimal(12,2)").cast("string")))
    return sources.read_csv(spark, _text(spark, lines, "csv"), _PART_SCHEMA, header=False)


@query("read_paragraphs", r"""
SELECT paragraph, count(*) AS cnt
FROM (SELECT unnest(string_split(text, chr(10))) AS paragraph FROM documents)
WHERE regexp_matches(paragraph, '[^ \t\n\x0B\f\r]') GROUP BY paragraph
""")
def read_paragraphs_q(spark, sf_dir):
    """The documents' non-blank lines."""
    path = _text(spark, read_table(spark, sf_dir, "documents").select("text"), "paragraphs")
    return (sources.read_paragraphs(spark, path).groupBy("paragraph")
            .agg(F.count(F.lit(1)).alias("cnt")))


@query("read_lines", """
SELECT line AS value, count(*) AS cnt
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line
""")
def read_lines_q(spark, sf_dir):
    """S3: every line, blank ones too."""
    path = _text(spark, read_table(spark, sf_dir, "documents").select("text"), "lines")
    return sources.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("cnt"))


@query("read_records", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ', "' || c_mktsegment || '"' AS label,
       c_mktsegment AS segment
FROM customer WHERE c_custkey % 5 <> 0
""")
def read_records_q(spark, sf_dir):
    """S4 + R5: quoted fields with commas and quotes; records of two or four fields go."""
    label = F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""'), F.col("c_mktsegment"), F.lit('"""'))
    key = F.col("c_custkey").cast("string")
    line = (F.when(F.col("c_custkey") % 10 == 0, F.concat_ws(",", key, label))
            .when(F.col("c_custkey") % 10 == 5, F.concat_ws(",", key, label, "c_mktsegment", F.lit("x")))
            .otherwise(F.concat_ws(",", key, label, "c_mktsegment")))
    path = _text(spark, read_table(spark, sf_dir, "customer").select(line), "records")
    return sources.read_records(spark, path, ["id", "label", "segment"])


def _notes(spark, sf_dir) -> str:
    """Documents as quoted records: every text whole, with its newlines, commas and quotes;
    every seventh record has a field too many, and every ninth one too few."""
    d = read_table(spark, sf_dir, "documents")

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')),
                        F.lit('"'))

    key = F.col("doc_id").cast("string")
    line = (F.when(F.col("doc_id") % 7 == 0, F.concat_ws(",", key, quoted("text"), quoted("lang"), F.lit("x")))
            .when(F.col("doc_id") % 9 == 0, F.concat_ws(",", key, quoted("text")))
            .otherwise(F.concat_ws(",", key, quoted("text"), quoted("lang"))))
    return _text(spark, d.select(line), "notes")


_NOTES_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS id, nullif(text, '') AS text, nullif(lang, '') AS lang
FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 9 <> 0
"""


@query("read_records_multiline", _NOTES_SQL)
def read_records_multiline_q(spark, sf_dir):
    """Fields with newlines, commas and doubled quotes, from files that several tasks read."""
    return sources.read_records(spark, _notes(spark, sf_dir), ["id", "text", "lang"])


@query("read_records_narrow", """
SELECT nullif(lang, '') AS lang, count(*) AS records, count(DISTINCT doc_id) AS ids
FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 9 <> 0 GROUP BY 1
""")
def read_records_narrow_q(spark, sf_dir):
    """S4 + R5: two of the three fields and a count; the field count still decides."""
    df = sources.read_records(spark, _notes(spark, sf_dir), ["id", "text", "lang"])
    return df.groupBy("lang").agg(F.count(F.lit(1)).alias("records"),
                                  F.countDistinct("id").alias("ids"))


@query("split_fields", """
SELECT event_type, user_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS event_id,
       CAST(NULL AS VARCHAR) AS missing
FROM events
""")
def split_fields_q(spark, sf_dir):
    """A bad number and a missing field are null."""
    bad = F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("event_id").cast("string"))
    lines = read_table(spark, sf_dir, "events").select(F.concat_ws(
        "|", "event_type", F.col("user_id").cast("string"), bad).alias("value"))
    return sources.split_fields(lines, ["event_type", "user_id", "event_id", "missing"], "|",
                                types={"user_id": "long", "event_id": "long"})


@query("write_tsv", """
SELECT concat_ws(chr(9), CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, '') AS value FROM customer
""")
def write_tsv_q(spark, sf_dir):
    """K1: rows as tab-separated lines (null as empty), read back."""
    path = _folder(spark, "tsv")
    sinks.write_tsv(read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit(None).cast("string").alias("gap")), path)
    return sources.read_lines(spark, path)


def _text_job(spark, sf_dir, kind: str):
    """J5 on lines of orders: priority, key, total price, status."""
    o = read_table(spark, sf_dir, "orders")
    lines = o.select(F.concat_ws(",", "o_orderpriority", F.col("o_orderkey").cast("string"),
                                 F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
                                 "o_orderstatus"))
    out = _folder(spark, f"job-{kind}")
    flows.keyed_text_job(spark, _text(spark, lines, "orders"), out, kind,
                         names=("priority", "key", "total", "status"))
    return sources.read_lines(spark, out)


@query("text_job_count", """
SELECT concat_ws(chr(9), o_orderpriority, CAST(count(*) AS VARCHAR)) AS value
FROM orders GROUP BY o_orderpriority
""")
def text_job_count_q(spark, sf_dir):
    return _text_job(spark, sf_dir, "count")


@query("text_job_profile", "SELECT concat_ws(chr(9), CAST(count(*) AS VARCHAR), '4', '4') AS value FROM orders")
def text_job_profile_q(spark, sf_dir):
    return _text_job(spark, sf_dir, "profile")


@query("text_job_mean", """
SELECT split_part(value, chr(9), 1) AS priority, round(mean, 2) AS mean
FROM (SELECT o_orderpriority AS value, avg(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE)) AS mean
      FROM orders GROUP BY o_orderpriority)
""")
def text_job_mean_q(spark, sf_dir):
    out = sources.split_fields(_text_job(spark, sf_dir, "mean"), ["priority", "mean"], "\t",
                               types={"mean": "double"})
    return out.withColumn("mean", F.round("mean", 2))


@query("text_job_cluster", """
SELECT concat_ws(chr(9), o_orderpriority, CAST(o_orderkey AS VARCHAR),
                 CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR), o_orderstatus) AS value
FROM orders
""")
def text_job_cluster_q(spark, sf_dir):
    return _text_job(spark, sf_dir, "cluster")
