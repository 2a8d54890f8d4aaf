"""Named queries over the test tables (one per operator of the inventory), each
paired with DuckDB SQL computing the same result.

Conventions shared by both sides so results compare exactly:
- every computed column is aliased to the same name in Spark and in SQL;
- integer outputs are INT or BIGINT on both sides (DuckDB sums become HUGEINT,
  so they are cast);
- means are rounded to 6 places; large sums use exact decimals or are rounded
  to a scale their magnitude supports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.functions import arrays as Y
from statflow.functions import scalars as S
from statflow.functions.constants import ENGLISH_STOP_WORDS, TOKEN_PATTERN
from statflow.operators import aggregates as A
from statflow.operators import levels as L
from statflow.operators import rows as R
from statflow.operators.jobs import cluster_by
from statflow.plans.registry import ORACLES, query
from statflow.sinks import format_line, head
from statflow.sources import read_table


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def _sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


STOP_SQL = _sql_list(ENGLISH_STOP_WORDS)

# ---------------------------------------------------------------- A1-A4, S5, R2, O3


@query("key_count", """
SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type
""")
def key_count(spark, sf_dir):
    return A.count_by(_t(spark, sf_dir, "events"), "event_type", out="cnt")


@query("key_mean", """
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean_value
FROM events GROUP BY event_type
""")
def key_mean(spark, sf_dir):
    out = A.mean_by(_t(spark, sf_dir, "events"), "event_type", "value", out="mean_value")
    return out.withColumn("mean_value", F.round("mean_value", 6))


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf_dir):
    return A.count_rows(_t(spark, sf_dir, "lineitem"))


@query("record_profile", """
SELECT count(*) AS n_lines,
       CAST(coalesce(min(len(string_split(text, ' '))), 0) AS INTEGER) AS min_fields,
       CAST(coalesce(max(len(string_split(text, ' '))), 0) AS INTEGER) AS max_fields
FROM documents
""")
def record_profile(spark, sf_dir):
    return A.record_profile(_t(spark, sf_dir, "documents"), "text", sep=" ")


_PART_LINE_SQL = ("concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, "
                  "CAST(p_size AS VARCHAR))")


def _part_lines(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", "p_brand",
                                "p_type", F.col("p_size").cast("string")).alias("value"))


@query("project_positions", f"""
WITH f AS (SELECT string_split({_PART_LINE_SQL}, ',') AS a FROM part)
SELECT concat_ws(chr(9), coalesce(a[1], ''), coalesce(a[3], ''), coalesce(a[4], ''),
                 coalesce(a[5], '')) AS line
FROM f
""")
def project_positions(spark, sf_dir):
    lines = R.project_positions(_part_lines(spark, sf_dir), [0, 2, 3, 4])
    # O3: rows arrive grouped and sorted by the first field (the key).
    keyed = lines.withColumn("key", S.field("line", 0, "\t"))
    return cluster_by(keyed, "key").select("line")


@query("filter_arity", """
SELECT doc_id, line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE len(string_split(line, ',')) = 2
""")
def filter_arity(spark, sf_dir):
    from statflow.sources import filter_arity as fa
    docs = _t(spark, sf_dir, "documents")
    lines = Y.explode_values(docs, ["doc_id"], F.split("text", "\n", -1), "line")
    return fa(lines, "line", 2, sep=",")


@query("format_line", f"""
SELECT concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), printf('%f', l_quantity),
                 printf('%f', l_discount), l_returnflag) AS line
FROM lineitem
""")
def format_line_q(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return format_line(li, [("l_orderkey", "%d"), ("l_quantity", "%f"),
                            ("l_discount", "%f"), ("l_returnflag", "%s")])


@query("head", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 10
""")
def head_q(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_totalprice")
    return head(o, 10, ["o_orderkey"])


# ---------------------------------------------------------------- R1, R3-R8


@query("project", """
SELECT o_orderkey, o_custkey, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice
FROM orders
""")
def project_q(spark, sf_dir):
    o = R.project(_t(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return R.to_number(o, "o_totalprice", "int", strict=True)


_NULLIF_SQL = """SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount,
       nullif(l_tax, 0) AS l_tax FROM lineitem"""


def _lineitem_nullif(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
                     F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))


@query("drop_null_any", f"""
SELECT * FROM ({_NULLIF_SQL}) WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL
""")
def drop_null_any(spark, sf_dir):
    return R.drop_null_any(_lineitem_nullif(spark, sf_dir))


@query("drop_null_subset", f"""
SELECT * FROM ({_NULLIF_SQL}) WHERE l_discount IS NOT NULL
""")
def drop_null_subset(spark, sf_dir):
    return R.drop_null_subset(_lineitem_nullif(spark, sf_dir), ["l_discount"])


@query("binarise", """
SELECT CAST(l_discount > 0.05 AS INTEGER) AS label, count(*) AS cnt
FROM lineitem GROUP BY 1
""")
def binarise_q(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return (li.select(S.binarise("l_discount", 0.05).alias("label"))
            .groupBy("label").agg(F.count(F.lit(1)).alias("cnt")))


# ---------------------------------------------------------------- F1-F7


@query("hhmm_to_hour", """
WITH t AS (SELECT event_id, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS hhmm FROM events)
SELECT event_id, hhmm,
       CAST(floor(hhmm / 100) + round((hhmm - floor(hhmm / 100) * 100) / 60) AS INTEGER)
         AS hour
FROM t
""")
def hhmm_to_hour_q(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    t = ev.select("event_id", (F.hour("ts") * 100 + F.minute("ts")).alias("hhmm"))
    return t.withColumn("hour", S.hhmm_to_hour("hhmm"))


NAME_RULES = [("ring|bolt", "FASTENER"), ("widget", None)]
TYPE_RULES = [("ECONOMY|SMALL", "BUDGET"), ("LARGE", None)]


@query("fold_by_pattern", """
SELECT p_partkey,
       CASE WHEN regexp_matches(p_name, 'ring|bolt') THEN 'FASTENER'
            WHEN regexp_matches(p_name, 'widget') THEN p_name ELSE 'OthersM' END AS name_group,
       CASE WHEN regexp_matches(p_type, 'ECONOMY|SMALL') THEN 'BUDGET'
            WHEN regexp_matches(p_type, 'LARGE') THEN p_type ELSE 'OthersM' END AS type_group
FROM part
""")
def fold_by_pattern_q(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey",
                    S.fold_by_pattern("p_name", NAME_RULES).alias("name_group"),
                    S.fold_by_pattern("p_type", TYPE_RULES).alias("type_group"))


@query("extract_number", rf"""
WITH t AS (SELECT c_custkey, c_name,
                  CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS bal FROM customer)
SELECT c_custkey,
       TRY_CAST(regexp_extract(c_name, '{S.UNSIGNED_NUMBER}', 1) AS DOUBLE) AS name_number,
       TRY_CAST(regexp_extract(bal, '{S.UNSIGNED_NUMBER}', 1) AS DOUBLE) AS bal_unsigned,
       TRY_CAST(regexp_extract(bal, '{S.SIGNED_NUMBER}', 1) AS DOUBLE) AS bal_signed
FROM t
""")
def extract_number_q(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    bal = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    return c.select("c_custkey",
                    S.extract_number("c_name").alias("name_number"),
                    S.extract_number(bal).alias("bal_unsigned"),
                    S.extract_number(bal, signed=True).alias("bal_signed"))


_SPEC_SQL = """CASE WHEN p_type = 'PROMO' THEN CAST(p_size AS VARCHAR) || ' hp'
            ELSE CAST(p_size AS VARCHAR) || ' hp @ ' || CAST(p_partkey % 20 AS VARCHAR) || ','
                 || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || ' RPM' END"""


def _ratio_sql(pattern: str) -> str:
    g = [f"TRY_CAST(regexp_extract(spec, '{pattern}', {i}) AS DOUBLE)" for i in (1, 2, 3)]
    return f"{g[0]} / nullif({g[1]} * 1000 + {g[2]}, 0)"


@query("extract_ratio", f"""
WITH t AS (SELECT p_partkey, {_SPEC_SQL} AS spec FROM part)
SELECT p_partkey, spec,
       {_ratio_sql(S.RATIO_GREEDY)} AS ratio_greedy,
       {_ratio_sql(S.RATIO_FIXED)} AS ratio_fixed
FROM t
""")
def extract_ratio_q(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    # Text per part: PROMO parts have no rpm (no comma), the others "x hp @ a,bcd RPM"
    # with one- and two-digit thousands; all rows are kept.
    spec = F.when(F.col("p_type") == "PROMO", F.concat(size, F.lit(" hp"))).otherwise(
        F.concat(size, F.lit(" hp @ "), (F.col("p_partkey") % 20).cast("string"), F.lit(","),
                 F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.lit(" RPM")))
    t = p.select("p_partkey", spec.alias("spec"))
    return t.select("p_partkey", "spec",
                    S.extract_ratio("spec", "greedy").alias("ratio_greedy"),
                    S.extract_ratio("spec", "fixed").alias("ratio_fixed"))


@query("flag_years", """
SELECT o_orderkey, CAST(coalesce(CAST(o_orderstatus = 'F' AS INTEGER), 0) AS INTEGER) AS is_final,
       CAST(2020 - year(o_orderdate) AS INTEGER) AS age
FROM orders
""")
def flag_years(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.flag("o_orderstatus", "F").alias("is_final"),
                    S.years_before(F.year("o_orderdate")).alias("age"))


# ---------------------------------------------------------------- A5-A7, W1, T1-T3, F8, F9


def _freq_sql(table: str, col: str) -> str:
    """Frequency table of one column with integer running counts."""
    return f"""
WITH c AS (SELECT {col} AS level, count(*) AS cnt FROM {table} GROUP BY {col}),
r AS (SELECT level, cnt,
             CAST(sum(cnt) OVER (ORDER BY cnt DESC, level ASC NULLS FIRST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum,
             CAST(sum(cnt) OVER () AS BIGINT) AS n
      FROM c)"""


def _frequent_sql(table: str, col: str, mode: str, p: float = 0.03, cum_p: float = 0.8) -> str:
    cond = (f"cum / n <= CAST({cum_p} AS DOUBLE)" if mode == "strict"
            else f"(cum - cnt) / n < CAST({cum_p} AS DOUBLE)")
    return _freq_sql(table, col) + f"""
SELECT level, cnt, cum, cnt / n AS share, cum / n AS cum_share FROM r
WHERE {cond} AND cnt / n > CAST({p} AS DOUBLE)"""


@query("freq_table", _freq_sql("part", "p_brand") + """
SELECT level, cnt, cum, cnt / n AS share, cum / n AS cum_share FROM r""")
def freq_table_q(spark, sf_dir):
    return L.freq_table(_t(spark, sf_dir, "part"), "p_brand")


@query("frequent_levels_strict", _frequent_sql("part", "p_brand", "strict"))
def frequent_levels_strict(spark, sf_dir):
    return L.frequent_levels(_t(spark, sf_dir, "part"), "p_brand", mode="strict")


@query("frequent_levels_inclusive", _frequent_sql("part", "p_brand", "inclusive"))
def frequent_levels_inclusive(spark, sf_dir):
    return L.frequent_levels(_t(spark, sf_dir, "part"), "p_brand", mode="inclusive")


@query("frequent_nations_strict", _frequent_sql("customer", "c_nationkey", "strict"))
def frequent_nations_strict(spark, sf_dir):
    return L.frequent_levels(_t(spark, sf_dir, "customer"), "c_nationkey", mode="strict")


@query("frequent_nations_inclusive", _frequent_sql("customer", "c_nationkey", "inclusive"))
def frequent_nations_inclusive(spark, sf_dir):
    return L.frequent_levels(_t(spark, sf_dir, "customer"), "c_nationkey", mode="inclusive")


# Many levels (order keys), four of them common.
_MIXED = "CASE WHEN l_linenumber = 1 THEN concat('line ', l_suppkey % 4) ELSE concat(l_orderkey, '') END"


@query("frequent_levels_many", f"""
WITH c AS (SELECT level, count(*) AS cnt, (SELECT count(*) FROM lineitem) AS n
           FROM (SELECT {_MIXED} AS level FROM lineitem) GROUP BY level),
r AS (SELECT *, CAST(sum(cnt) OVER (ORDER BY cnt DESC, level ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum FROM c)
SELECT level, cnt, cum, cnt / n AS share, cum / n AS cum_share FROM r
WHERE cum / n <= 0.8::DOUBLE AND cnt / n > 0.03::DOUBLE
""")
def frequent_levels_many(spark, sf_dir):
    """A6 on a column with very many levels: summaries first, then the candidates' counts."""
    li = _t(spark, sf_dir, "lineitem").select(F.expr(_MIXED).alias("level"))
    return L.frequent_levels(li, "level", sketch=True)


SIZE_RANGE = list(range(1, 30))  # fixed values: the day-of-month range of the flight flow
SIZE_RANGE_SQL = ", ".join(str(v) for v in SIZE_RANGE)


@query("levels", "SELECT DISTINCT p_type AS level FROM part")
def levels_q(spark, sf_dir):
    return L.levels(_t(spark, sf_dir, "part"), "p_type")


@query("levels_in", _freq_sql("part", "p_size") + f"""
SELECT level, cnt, cum, cnt / n AS share, cum / n AS cum_share FROM r
WHERE level IN ({SIZE_RANGE_SQL})""")
def levels_in_q(spark, sf_dir):
    return L.levels_in(L.freq_table(_t(spark, sf_dir, "part"), "p_size"), SIZE_RANGE)


@query("dropped_levels", f"""
SELECT DISTINCT p_size AS level FROM part WHERE p_size NOT IN ({SIZE_RANGE_SQL})
""")
def dropped_levels_q(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    kept = L.levels(part, "p_size").where(F.col("level").isin(SIZE_RANGE))
    return L.dropped_levels(L.levels(part, "p_size"), kept)


def _level_report_sql() -> str:
    parts = []
    for col in ("p_brand", "p_type", "p_size"):
        parts.append(f"""SELECT '{col}' AS "column", CAST({col} AS VARCHAR) AS level,
                         count(*) AS cnt FROM part GROUP BY {col}""")
    counts = " UNION ALL ".join(parts)
    return f"""
WITH c AS ({counts}),
r AS (SELECT "column", level, cnt,
             CAST(sum(cnt) OVER (PARTITION BY "column" ORDER BY cnt DESC, level ASC NULLS FIRST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum,
             CAST(sum(cnt) OVER (PARTITION BY "column") AS BIGINT) AS n
      FROM c)
SELECT "column", level, cnt, cum, n, cnt / n AS share, cum / n AS cum_share,
       CASE "column"
         WHEN 'p_brand' THEN cum / n <= 0.8::DOUBLE AND cnt / n > 0.03::DOUBLE
         WHEN 'p_type' THEN (cum - cnt) / n < 0.8::DOUBLE AND cnt / n > 0.03::DOUBLE
         ELSE level IN ({_sql_list(SIZE_RANGE)}) END AS kept
FROM r"""


@query("level_report", _level_report_sql())
def level_report_q(spark, sf_dir):
    specs = {"p_brand": {"p": 0.03, "cum_p": 0.8, "mode": "strict"},
             "p_type": {"p": 0.03, "cum_p": 0.8, "mode": "inclusive"},
             "p_size": {"allowed": SIZE_RANGE}}
    return L.level_report(_t(spark, sf_dir, "part"), specs)


FOLD_KEPT = [3] + list(range(10, 21))


@query("fold_levels_exact", f"""
SELECT p_partkey, CASE WHEN CAST(p_size AS VARCHAR) IN ({_sql_list(FOLD_KEPT)})
                       THEN CAST(p_size AS VARCHAR) ELSE '9999' END AS p_size
FROM part
""")
def fold_levels_exact(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return L.fold_levels(part, "p_size", FOLD_KEPT, match="exact")


_PREFIX_COND = " OR ".join(f"starts_with(CAST(p_size AS VARCHAR), '{k}')" for k in FOLD_KEPT)


@query("fold_levels_prefix", f"""
SELECT p_partkey,
       CASE WHEN p_size IS NULL THEN NULL
            WHEN CAST(p_size AS VARCHAR) = '' OR {_PREFIX_COND} THEN CAST(p_size AS VARCHAR)
            ELSE '9999' END AS p_size
FROM part
""")
def fold_levels_prefix(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return L.fold_levels(part, "p_size", FOLD_KEPT, match="prefix")


# ---------------------------------------------------------------- M1-M3, M5


def _index_sql(col: str, name: str) -> str:
    return (f"{name} AS (SELECT {col} AS level, row_number() OVER (ORDER BY count(*) DESC, {col})"
            f" - 1 AS idx FROM part GROUP BY {col}), n{name} AS (SELECT count(*) AS n FROM {name})")


_INDEX_SQL = "WITH " + _index_sql("p_brand", "b") + ", " + _index_sql("p_type", "t")


def _indexed_part(spark, sf_dir):
    from statflow.operators.features import string_index
    part = _t(spark, sf_dir, "part")
    return string_index(part, ["p_brand", "p_type"])


@query("string_index", _INDEX_SQL + """
SELECT p_partkey, CAST(b.idx AS INTEGER) AS brand_idx, CAST(t.idx AS INTEGER) AS type_idx
FROM part JOIN b ON part.p_brand = b.level JOIN t ON part.p_type = t.level
""")
def string_index_q(spark, sf_dir):
    df = _indexed_part(spark, sf_dir)
    return df.select("p_partkey", F.col("p_brand_indexed").cast("int").alias("brand_idx"),
                     F.col("p_type_indexed").cast("int").alias("type_idx"))


@query("one_hot", _INDEX_SQL + """
SELECT p_partkey, CAST(b.idx AS INTEGER) AS slot, 1.0::DOUBLE AS value
FROM part JOIN b ON part.p_brand = b.level
WHERE b.idx < (SELECT n FROM nb) - 1
""")
def one_hot_q(spark, sf_dir):
    from statflow.operators.features import one_hot, vector_entries
    df = one_hot(_indexed_part(spark, sf_dir), ["p_brand_indexed"])
    return vector_entries(df, ["p_partkey"], "p_brand_indexed_encoded")


@query("assemble", _INDEX_SQL + """
SELECT p_partkey, 0 AS slot, p_retailprice AS value FROM part WHERE p_retailprice <> 0
UNION ALL
SELECT p_partkey, CAST(1 + b.idx AS INTEGER), 1.0::DOUBLE
FROM part JOIN b ON part.p_brand = b.level WHERE b.idx < (SELECT n FROM nb) - 1
UNION ALL
SELECT p_partkey, CAST(1 + (SELECT n FROM nb) - 1 + t.idx AS INTEGER), 1.0::DOUBLE
FROM part JOIN t ON part.p_type = t.level WHERE t.idx < (SELECT n FROM nt) - 1
""")
def assemble_q(spark, sf_dir):
    from statflow.operators.features import assemble, one_hot, vector_entries
    df = one_hot(_indexed_part(spark, sf_dir), ["p_brand_indexed", "p_type_indexed"])
    df = assemble(df, ["p_retailprice", "p_brand_indexed_encoded", "p_type_indexed_encoded"])
    return vector_entries(df, ["p_partkey"], "features")


@query("build_features", ORACLES["assemble"])
def build_features_q(spark, sf_dir):
    """M6: the same vectors in one step, level lists on the executors only."""
    from statflow.operators.features import build_features, vector_entries
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    _, df = build_features(part, ["p_brand", "p_type"], ["p_retailprice"])
    return vector_entries(df, ["p_partkey"], "features")


TYPE_LEVELS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("dummies", "SELECT p_partkey, " + ", ".join(
    f"CAST(coalesce(CAST(p_type = '{lv}' AS INTEGER), 0) AS INTEGER) AS type_{lv}"
    for lv in TYPE_LEVELS[1:]) + " FROM part")
def dummies_q(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_type")
    return L.dummies(part, "p_type", TYPE_LEVELS, prefix="type", baseline="ECONOMY")


# ---------------------------------------------------------------- A8-A10, A13, A14


@query("impute_mean", f"""
WITH s AS ({_NULLIF_SQL})
SELECT l_orderkey, l_linenumber,
       round(coalesce(l_discount, (SELECT avg(l_discount) FROM s)), 6) AS l_discount,
       round(coalesce(l_tax, (SELECT avg(l_tax) FROM s)), 6) AS l_tax
FROM s
""")
def impute_mean_q(spark, sf_dir):
    out = A.impute_mean(_lineitem_nullif(spark, sf_dir), ["l_discount", "l_tax"])
    return out.withColumns({c: F.round(c, 6) for c in ("l_discount", "l_tax")})


@query("impute_const", f"""
SELECT l_orderkey, l_linenumber, coalesce(l_discount, 0.0::DOUBLE) AS l_discount,
       coalesce(l_tax, 0.01::DOUBLE) AS l_tax
FROM ({_NULLIF_SQL})
""")
def impute_const_q(spark, sf_dir):
    return A.impute_const(_lineitem_nullif(spark, sf_dir), {"l_discount": 0.0, "l_tax": 0.01})


GRAM_X = ["l_quantity", "l_discount", "l_tax"]
GRAM_Y = "l_extendedprice"


def _gram_sql() -> str:
    terms = [("const", "CAST(1 AS DECIMAL(18,2))")] + [
        (c, f"CAST({c} AS DECIMAL(18,2))") for c in GRAM_X + [GRAM_Y]]
    sums, sel = [], []
    for i, (ni, ei) in enumerate(terms):
        for j in range(i, len(terms)):
            nj, ej = terms[j]
            sums.append(f"sum({ei} * {ej}) AS g_{i}_{j}")
            sel.append(f"SELECT {i} AS i, {j} AS j, '{ni}' AS term_i, '{nj}' AS term_j, "
                       f"round(CAST(g_{i}_{j} AS DOUBLE), {_gram_digits(ni, nj)}) AS value FROM s")
    return f"WITH s AS (SELECT {', '.join(sums)} FROM lineitem) " + " UNION ALL ".join(sel)


def _gram_digits(ni: str, nj: str) -> int:
    """The exact y'y exceeds 2^53 units, where the last bit of decimal-to-double
    conversion is engine specific: it is compared to the nearest hundred."""
    return -2 if ni == nj == GRAM_Y else 6


@query("gram", _gram_sql())
def gram_q(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    g = A.gram(li, GRAM_X, GRAM_Y, exact_scale=2)
    yy = (F.col("term_i") == GRAM_Y) & (F.col("term_j") == GRAM_Y)
    return g.withColumn("value", F.when(yy, F.round("value", _gram_digits(GRAM_Y, GRAM_Y)))
                        .otherwise(F.round("value", 6)))


_OLS_NULLS_SQL = """SELECT nullif(l_quantity, 10) AS x, nullif(l_extendedprice, 0) AS y,
       nullif(l_tax, 0.02) AS z FROM lineitem"""


@query("ols_nulls", f"""
WITH s AS ({_OLS_NULLS_SQL}), c AS (SELECT x, y FROM s WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT 'const' AS term, round(regr_intercept(y, x), 4) AS beta FROM c
UNION ALL SELECT 'x', round(regr_slope(y, x), 4) FROM c
""")
def ols_nulls(spark, sf_dir):
    """A10 on rows with gaps (batched cross-products): incomplete rows do not count."""
    from statflow.operators.models import ols
    li = _t(spark, sf_dir, "lineitem").select(
        F.nullif("l_quantity", F.lit(10.0)).alias("x"),
        F.nullif("l_extendedprice", F.lit(0.0)).alias("y"))
    return ols(li, ["x"], "y").withColumn("beta", F.round("beta", 4))


@query("ols_simple", """
SELECT 'const' AS term, round(regr_intercept(l_extendedprice, l_quantity), 6) AS beta
FROM lineitem
UNION ALL
SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 6) FROM lineitem
""")
def ols_simple(spark, sf_dir):
    from statflow.operators.models import ols
    out = ols(_t(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice", exact_scale=2)
    return out.withColumn("beta", F.round("beta", 6))


def _ols_multi_sql() -> str:
    """Normal equations solved by Cramer's rule over the exact cross-product sums."""
    from itertools import permutations
    terms = [("const", "CAST(1 AS DECIMAL(18,2))")] + [
        (c, f"CAST({c} AS DECIMAL(18,2))") for c in GRAM_X + [GRAM_Y]]
    p = len(GRAM_X) + 1
    sums = [f"CAST(sum({terms[i][1]} * {terms[j][1]}) AS DOUBLE) AS g_{i}_{j}"
            for i in range(p + 1) for j in range(i, p + 1) if not (i == p and j == p)]

    def g(i, j):
        return f"g_{min(i, j)}_{max(i, j)}"

    def det(col_of):  # col_of(r, c) -> SQL for entry (r, c)
        out = []
        for perm in permutations(range(p)):
            inv = sum(1 for a in range(p) for b in range(a + 1, p) if perm[a] > perm[b])
            sign = "-" if inv % 2 else "+"
            out.append(sign + " " + " * ".join(col_of(r, perm[r]) for r in range(p)))
        return "(" + " ".join(out) + ")"

    base = det(lambda r, c: g(r, c))
    parts = []
    for k in range(p):
        num = det(lambda r, c, k=k: g(r, p) if c == k else g(r, c))
        parts.append(f"SELECT '{terms[k][0]}' AS term, round({num} / {base}, 4) AS beta FROM s")
    return f"WITH s AS (SELECT {', '.join(sums)} FROM lineitem) " + " UNION ALL ".join(parts)


@query("ols_multi", _ols_multi_sql())
def ols_multi(spark, sf_dir):
    from statflow.operators.models import ols
    out = ols(_t(spark, sf_dir, "lineitem"), GRAM_X, GRAM_Y, exact_scale=2)
    return out.withColumn("beta", F.round("beta", 4))


# ---------------------------------------------------------------- Y1-Y5, A12, M10, M11

TOK_SQL = f"regexp_extract_all(lower(text), '{TOKEN_PATTERN}')"
FILT_SQL = f"list_filter({TOK_SQL}, lambda x: NOT list_contains([{STOP_SQL}], x))"
DOC_TERMS_SQL = f"""d AS (SELECT doc_id, f,
       list_transform(range(1, len(f)), lambda i: f[i] || ' ' || f[i + 1]) AS bigrams
  FROM (SELECT doc_id, {FILT_SQL} AS f FROM documents))"""


TEXT_TASKS = 32  # documents are one file: deal its rows to so many tasks at least,
TEXT_ROWS = 10_000  # and to more if there are more rows than so many a task
TEXT_BYTES = 64 << 20  # or more text, where a task holds a block's words at once


def _doc_terms(spark, sf_dir, key=None):
    from statflow.operators.partitioning import spread
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    return _with_terms(spread(docs, max(TEXT_TASKS, -(-docs.count() // TEXT_ROWS)), key))


def _with_terms(docs):
    return (docs.withColumn("tokens", Y.tokenize("text"))
            .withColumn("filtered", Y.remove_stopwords("tokens"))
            .withColumn("bigrams", Y.ngrams("filtered", 2))
            .drop("text"))


@query("tokenize", f"""
SELECT token, count(*) AS cnt
FROM (SELECT unnest({TOK_SQL}) AS token FROM documents) GROUP BY token
""")
def tokenize_q(spark, sf_dir):
    d = _doc_terms(spark, sf_dir)
    return (Y.explode_values(d, [], "tokens", "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))


@query("remove_stopwords", f"""
SELECT token, count(*) AS cnt
FROM (SELECT unnest({FILT_SQL}) AS token FROM documents) GROUP BY token
""")
def remove_stopwords_q(spark, sf_dir):
    d = _doc_terms(spark, sf_dir)
    return (Y.explode_values(d, [], "filtered", "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))


@query("ngrams", f"""
WITH {DOC_TERMS_SQL}
SELECT bigram, count(*) AS cnt FROM (SELECT unnest(bigrams) AS bigram FROM d) GROUP BY bigram
""")
def ngrams_q(spark, sf_dir):
    d = _doc_terms(spark, sf_dir)
    return (Y.explode_values(d, [], "bigrams", "bigram")
            .groupBy("bigram").agg(F.count(F.lit(1)).alias("cnt")))


@query("median_size", f"""
WITH {DOC_TERMS_SQL}
SELECT quantile_cont(len(bigrams), 0.5) AS median_size FROM d
""")
def median_size_q(spark, sf_dir):
    return A.median_size(_doc_terms(spark, sf_dir), "bigrams")


@query("term_counts", f"""
WITH {DOC_TERMS_SQL}
SELECT doc_id, term, count(*) AS tf
FROM (SELECT doc_id, unnest(bigrams) AS term FROM d) GROUP BY doc_id, term
""")
def term_counts_q(spark, sf_dir):
    from statflow.operators.models import term_counts
    return term_counts(_doc_terms(spark, sf_dir), "doc_id", "bigrams")


@query("tf_idf", f"""
WITH {DOC_TERMS_SQL},
tc AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(bigrams) AS term FROM d) GROUP BY doc_id, term),
dfq AS (SELECT term, count(*) AS df FROM tc GROUP BY term),
m AS (SELECT count(*) AS m FROM documents)
SELECT doc_id, term, tf, df,
       round(ln((m + 1) / (df + 1)), 9) AS idf,
       round(tf * ln((m + 1) / (df + 1)), 9) AS tf_idf
FROM tc JOIN dfq USING (term), m
""")
def tf_idf_q(spark, sf_dir):
    from statflow.operators.models import tf_idf
    out = tf_idf(_doc_terms(spark, sf_dir, "doc_id"), "doc_id", "bigrams")
    return out.withColumns({c: F.round(c, 9) for c in ("idf", "tf_idf")})


@query("lookup", f"""
WITH toks AS (SELECT doc_id, unnest({TOK_SQL}) AS term,
                     unnest(range(0, len({TOK_SQL}))) AS pos FROM documents),
v AS (SELECT term, CAST(row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS INTEGER)
             AS term_index FROM toks GROUP BY term)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, term_index, term FROM toks JOIN v USING (term)
""")
def lookup_q(spark, sf_dir):
    from statflow.operators.models import block_terms, encode, in_blocks, lookup_long
    from statflow.operators.ordering import global_rank
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(TEXT_TASKS, -(-n // TEXT_ROWS), -(-(size or 0) // TEXT_BYTES))
    d = _with_terms(in_blocks(docs, ["doc_id"], blocks)).select("block", "doc_id", "tokens")
    held = block_terms(d, "tokens")
    # Vocabulary: total count descending, ties by term, ranked distributed.
    stats = held.groupBy("term").agg(F.sum("n").alias("ttf"))
    vocab = global_rank(stats, [F.desc("ttf"), F.asc("term")], "rank").select(
        (F.col("rank") - 1).cast("int").alias("term_index"), "term")
    # Encode: token positions -> indices, one array per document.
    coded = encode(d, "doc_id", "tokens", held, vocab, "idx")
    # Decode: indices -> words.
    return lookup_long(coded, ["doc_id"], "idx", vocab, blocks=blocks)


@query("vocabulary", f"""
WITH {DOC_TERMS_SQL},
tc AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(bigrams) AS term FROM d) GROUP BY doc_id, term)
SELECT CAST(row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS INTEGER) AS term_index,
       term, CAST(sum(tf) AS BIGINT) AS ttf, count(*) AS df
FROM tc GROUP BY term
""")
def vocabulary_q(spark, sf_dir):
    from statflow.operators.models import vocabulary
    return vocabulary(_doc_terms(spark, sf_dir, "doc_id").select("doc_id", "bigrams"), "doc_id", "bigrams")


@query("lookup_arrays", """
WITH v AS (SELECT p_brand AS term, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER)
                  AS term_index FROM (SELECT DISTINCT p_brand FROM part)),
a AS (SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN []
             ELSE [CAST(l_partkey % 25 AS INTEGER), CAST(l_suppkey % 27 AS INTEGER)] END AS idx
      FROM lineitem)
SELECT l_returnflag, CASE WHEN len(idx) = 0 THEN '' ELSE
       coalesce((SELECT term FROM v WHERE term_index = idx[1]), '?') || ',' ||
       coalesce((SELECT term FROM v WHERE term_index = idx[2]), '?') END AS words
FROM a
""")
def lookup_arrays_q(spark, sf_dir):
    """Y5 on every line item: repeated rows, empty arrays and indices without a term."""
    from statflow.operators.models import lookup
    from statflow.operators.ordering import global_rank
    brands = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("term")).distinct()
    vocab = global_rank(brands, [F.asc("term")], "rank").select(
        (F.col("rank") - 1).cast("int").alias("term_index"), "term")
    idx = F.when(F.col("l_linenumber") == 7, F.array().cast("array<int>")).otherwise(
        F.array((F.col("l_partkey") % 25).cast("int"), (F.col("l_suppkey") % 27).cast("int")))
    rows = _t(spark, sf_dir, "lineitem").select("l_returnflag", idx.alias("idx"))
    out = lookup(rows, "idx", vocab, "words")
    return out.select("l_returnflag", F.array_join("words", ",", "?").alias("words"))


# ---------------------------------------------------------------- U1


@query("keyed_job", """
SELECT l_suppkey, count(*) AS n_lines,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem GROUP BY l_suppkey
""")
def keyed_job_q(spark, sf_dir):
    from statflow.operators.jobs import keyed_job

    def mapper(pdf):
        return pdf.assign(revenue=pdf["l_extendedprice"] * (1 - pdf["l_discount"]))[
            ["l_suppkey", "revenue"]]

    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount")
    out = keyed_job(li, "l_suppkey", mapper, "l_suppkey long, revenue double",
                    aggs=[F.count(F.lit(1)).alias("n_lines"), F.sum("revenue").alias("revenue")])
    return out.withColumn("revenue", F.round("revenue", 2))


@query("keyed_job_reducer", """
SELECT l_suppkey, count(*) AS n_lines, max(l_quantity) AS most FROM lineitem GROUP BY l_suppkey
""")
def keyed_job_reducer_q(spark, sf_dir):
    """U1 with a user mapper and a user (combining) reducer, ten output partitions."""
    from statflow.operators.jobs import keyed_job

    def mapper(pdf):
        return pdf.assign(n_lines=1, most=pdf["l_quantity"])[["l_suppkey", "n_lines", "most"]]

    def reducer(pdf):
        return pdf.groupby("l_suppkey", as_index=False).agg({"n_lines": "sum", "most": "max"})

    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    schema = "l_suppkey long, n_lines long, most double"
    return keyed_job(li, "l_suppkey", mapper, schema, reducer=reducer, reduce_schema=schema,
                     n_out=10)


@query("keyed_job_first_last", """
SELECT user_id, arg_min(value, (ts, event_id)) AS first_value,
       arg_max(value, (ts, event_id)) AS last_value, count(*) AS n,
       CAST(coalesce(sum(CAST(value > before AS INTEGER)), 0) AS BIGINT) AS rises
FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
GROUP BY user_id
""")
def keyed_job_first_last_q(spark, sf_dir):
    """U1 with a sorted reducer, one object a key: first and last value in time, rises."""
    import pandas as pd

    from statflow.operators.jobs import each_key, keyed_job

    class FirstLast:
        def __init__(self, key):
            self.user, self.first, self.last, self.n, self.rises = key[0], None, None, 0, 0

        def add(self, rows):
            v = rows["value"].to_numpy()
            if self.n == 0:
                self.first = v[0]
            else:
                self.rises += int(v[0] > self.last)
            self.rises += int((v[1:] > v[:-1]).sum())
            self.last, self.n = v[-1], self.n + len(v)

        def finish(self):
            return pd.DataFrame({"user_id": [self.user], "first_value": [self.first],
                                 "last_value": [self.last], "n": [self.n], "rises": [self.rises]})

    ev = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return keyed_job(ev, "user_id", stream=each_key(FirstLast, ["user_id"]), order=["ts", "event_id"],
                     reduce_schema="user_id long, first_value double, last_value double, n long, rises long",
                     n_out=10)


@query("keyed_job_differences", """
SELECT event_type, user_id, event_id,
       value - lag(value) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS step
FROM events
""")
def keyed_job_differences_q(spark, sf_dir):
    """U1 with a sorted reducer of whole batches: running differences along (type, user),
    dealt by type and user, the last value carried over batch edges."""
    from statflow.operators.jobs import keyed_job

    class Steps:
        last = None

        def batch(self, rows, starts):
            before = rows["value"].shift(1).to_numpy().copy()
            if self.last is not None:
                before[0] = self.last
            before[starts] = float("nan")
            self.last = rows["value"].iloc[-1]
            out = rows[["event_type", "user_id", "event_id"]].copy()
            step = (rows["value"].to_numpy() - before).astype(object)
            step[starts] = None
            return out.assign(step=step)

        def end(self):
            return None

    ev = _t(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id", "value")
    return keyed_job(ev, ["event_type", "user_id"], stream=Steps, order=["ts", "event_id"],
                     reduce_schema="event_type string, user_id long, event_id long, step double")
