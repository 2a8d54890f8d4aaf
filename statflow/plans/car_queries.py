"""J1 on the test tables: used-car records made from lineitem x part, as text.

Each field is one SQL expression that Spark and DuckDB read alike; the records are
cleaned, imputed and regressed by the same flow that reads the CSV.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions import scalars as S
from statflow.operators.partitioning import spread
from statflow.plans import flows
from statflow.plans.registry import query
from statflow.sources import read_table


def _tenths(value: str) -> str:
    return f"concat(CAST({value} AS DECIMAL(12,1)), '')"


def _inches(value: str, gap: str) -> str:
    return f"CASE WHEN {gap} THEN '--' ELSE concat({_tenths(value)}, ' in') END"


_RPM = ("concat(p_size + 100, ' {unit} @ ', l_partkey % 12, ',', "
        "CASE WHEN l_suppkey % 10 = 0 THEN '000' ELSE concat(l_suppkey % 9 + 1, '50') END, ' RPM')")

FIELDS = {
    "price": "concat(CAST(l_extendedprice AS DECIMAL(12,2)), '')",
    "franchise_dealer": "CASE l_returnflag WHEN 'R' THEN 'True' WHEN 'A' THEN 'False' ELSE '' END",
    "is_new": "CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'False' END",
    "body_type": "CASE p_type WHEN 'ECONOMY' THEN 'SUV / Crossover' WHEN 'LARGE' THEN 'Sedan' "
                 "WHEN 'PROMO' THEN '' ELSE 'Pickup Truck' END",
    "engine_cylinders": "CASE p_size % 3 WHEN 0 THEN 'I4' WHEN 1 THEN 'V6' ELSE 'H4' END",
    "listing_color": "CASE p_size % 4 WHEN 0 THEN 'BLACK' WHEN 1 THEN 'WHITE' ELSE 'SILVER' END",
    "wheel_system": "CASE l_suppkey % 5 WHEN 0 THEN 'AWD' WHEN 1 THEN '4WD' WHEN 2 THEN '4X2' ELSE 'FWD' END",
    "daysonmarket": "concat(l_orderkey % 900, '')",
    "savings_amount": "concat(l_suppkey * 7 % 3000, '')",
    "year": "concat(2000 + l_orderkey % 21, '')",
    "maximum_seating": "CASE WHEN l_orderkey % 11 = 0 THEN '--' ELSE concat(l_partkey % 7 + 2, ' seats') END",
    "transmission_display": "CASE WHEN l_linenumber % 3 = 0 THEN 'Automatic' "
                            "ELSE concat(l_orderkey % 8 + 2, '-Speed Automatic') END",
    "city_fuel_economy": f"CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE {_tenths('l_quantity')} END",
    "latitude": "concat(CAST(25 + l_partkey % 2300 / 100.0 AS DECIMAL(12,2)), '')",
    "longitude": "concat(CAST(-70 - l_orderkey % 4900 / 100.0 AS DECIMAL(12,2)), '')",
    "mileage": "concat(l_orderkey * 13 % 200000, '')",
    "seller_rating": "concat(CAST(l_tax * 50 AS DECIMAL(12,1)), '')",
    "highway_fuel_economy": "concat(l_suppkey % 40 + 10, '')",
    "horsepower": "concat(p_size * 6 + 80, '')",
    "engine_displacement": "concat(l_partkey % 37 * 100, '')",
    "back_legroom": _inches("l_suppkey % 13 + 30", "l_orderkey % 7 = 0"),
    "front_legroom": _inches("l_partkey % 17 + 35", "l_orderkey % 9 = 0"),
    "fuel_tank_volume": "concat(CAST(l_suppkey % 23 + 9 AS DECIMAL(12,1)), ' gal')",
    "height": _inches("l_orderkey % 29 + 50", "l_partkey % 10 = 0"),
    "length": _inches("l_partkey % 71 + 150", "l_suppkey % 12 = 0"),
    "wheelbase": _inches("l_orderkey % 43 + 90", "l_suppkey % 14 = 0"),
    "width": _inches("l_partkey % 31 + 60", "l_linenumber = 5"),
    "power": f"CASE WHEN l_linenumber = 6 THEN '' ELSE {_RPM.format(unit='hp')} END",
    "torque": f"CASE WHEN l_orderkey % 6 = 0 THEN '--' ELSE {_RPM.format(unit='lb-ft')} END",
}
KEYS = ["l_orderkey", "l_linenumber"]
DIGITS = 8
# Engines format exact halves differently; this keeps whole-number sums off that edge.
OFF_EDGE = 1.0000000123


RECORD_TASKS = 32
_USED = {w for e in [*FIELDS.values(), "p_partkey"] for w in re.findall(r"\b[lp]_\w+", e)} | {"p_partkey"}


def car_records(spark, sf_dir) -> DataFrame:
    li, part = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")
    # Small tables come from one scan task: the text work is dealt over several.
    used = [c for c in li.columns if c in _USED], [c for c in part.columns if c in _USED]
    both = spread(li.select(*used[0]).join(part.select(*used[1]), li["l_partkey"] == part["p_partkey"]), RECORD_TASKS)
    return both.select(*[F.expr(e).alias(n) for n, e in FIELDS.items()])


# ---- the same in SQL


def _number(col: str, pattern: str) -> str:
    return f"TRY_CAST(regexp_extract({col}, '{pattern}', 1) AS DOUBLE)"


def _ratio(col: str) -> str:
    x, a, b = (f"TRY_CAST(regexp_extract({col}, '{S.RATIO_FIXED}', {i}) AS DOUBLE)" for i in (1, 2, 3))
    return f"{x} / nullif({a} * 1000 + {b}, 0)"


def _features_sql() -> str:
    records = ", ".join(f"{e} AS {n}" for n, e in FIELDS.items())
    raw = [f"CAST(CAST(price AS FLOAT) AS DOUBLE) AS price"]
    raw += [f"CAST(coalesce({c} = 'True', false) AS DOUBLE) AS {c}" for c in flows.CAR_BOOL]
    numeric = flows.CAR_INT + flows.CAR_FLOAT
    for c in numeric:
        raw.append((_ratio(c) if c in flows.CAR_RATIO else
                    _number(c, S.UNSIGNED_NUMBER if c in flows.CAR_TEXT_NUMBER else S.SIGNED_NUMBER))
                   + f" AS {c}")
    dummies = {"body_type_SUV": "regexp_matches(body_type, 'SUV|Crossover')",
               "body_type_Sedan": "regexp_matches(body_type, 'Sedan')",
               "engine_I": "regexp_matches(engine_cylinders, 'I')",
               "color_BLACK": "listing_color = 'BLACK'", "color_WHITE": "listing_color = 'WHITE'",
               "WS_AWD": "regexp_matches(wheel_system, 'AWD|4WD|4X2')"}
    raw += [f"CAST({e} AS DOUBLE) AS {n}" for n, e in dummies.items()]
    means = ", ".join(f"avg({c}) AS {c}" for c in numeric)
    out = ["n.price AS price"] + [f"n.{c} AS {c}" for c in flows.CAR_BOOL]
    for c in numeric:
        filled = f"coalesce(n.{c}, m.{c})"
        out.append(f"{f'2020 - {filled}' if c == 'year' else filled} AS {c}")
    out += [f"n.{d} AS {d}" for d in dummies]
    return f"""r AS (SELECT {records} FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT {', '.join(raw)} FROM r WHERE TRY_CAST(price AS FLOAT) IS NOT NULL),
m AS (SELECT {means} FROM n),
x AS (SELECT {', '.join(out)} FROM n, m)"""


_ROUNDED = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in ["price", *flows.CAR_REGRESSORS])


@query("car_features", f"WITH {_features_sql()} SELECT {_ROUNDED} FROM x")
def car_features_q(spark, sf_dir):
    df = flows.car_features(car_records(spark, sf_dir))
    return df.select(*[F.round(c, DIGITS).alias(c) for c in df.columns])


def _gram_sql() -> str:
    terms = ["1.0", *flows.CAR_REGRESSORS, "price"]
    names = ["const", *flows.CAR_REGRESSORS, "price"]
    pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    sums = ", ".join(f"sum({terms[i]} * {terms[j]}) AS g_{i}_{j}" for i, j in pairs)
    rows = " UNION ALL ".join(f"SELECT '{names[i]}' AS term_i, '{names[j]}' AS term_j, "
                              f"printf('%.6e', g_{i}_{j} * {OFF_EDGE}) AS value FROM g" for i, j in pairs)
    return f"WITH {_features_sql()}, g AS (SELECT {sums} FROM x) {rows}"


@query("car_gram", _gram_sql())
def car_gram_q(spark, sf_dir):
    """A9 + A13 with 30 regressors (528 sums) from one scan, to seven digits."""
    g = flows.car_gram(car_records(spark, sf_dir))
    return g.select("term_i", "term_j", F.format_string(
        "%.6e", F.col("value") * F.lit(OFF_EDGE)).alias("value"))


_TERMS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS term, true AS holds"
                                for t in ["const", *flows.CAR_REGRESSORS])


@query("car_price_ols", _TERMS_SQL)
def car_price_ols_q(spark, sf_dir):
    """J1's 31 coefficients, checked: for each term, the residuals' sum against it is
    a rounding error (below 1e-6 of the sum of absolute products)."""
    records = car_records(spark, sf_dir)
    values = flows.car_table(records)
    x = flows.car_features(records, values=values)
    beta_of = {r["term"]: r["beta"] for r in flows.car_price_ols(records, values=values).collect()}
    names = ["const", *flows.CAR_REGRESSORS]
    beta = [beta_of[c] or 0.0 for c in names]  # an aliased term takes no part
    fitted = sum((F.col(c) * F.lit(float(b)) for c, b in zip(names[1:], beta[1:])), F.lit(float(beta[0])))
    with_r = x.withColumn("__r", F.col("price") - fitted).withColumn("const", F.lit(1.0))
    sums = with_r.agg(*[F.struct(
        F.abs(F.sum(F.col(c) * F.col("__r"))).alias("off"),
        F.sum(F.abs(F.col(c) * F.col("price"))).alias("size")).alias(f"t{k}")
        for k, c in enumerate(names)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("term"),
                 (F.col(f"t{k}.off") <= 1e-6 * F.col(f"t{k}.size")).alias("holds"))
        for k, n in enumerate(names)])))


def _betas_sql() -> str:
    """The normal equations solved by Gauss-Jordan elimination, a step a CTE. A term whose
    pivot is a rounding error of its own square is aliased: its row and column go."""
    terms = ["1.0", *flows.CAR_REGRESSORS, "price"]
    p = len(terms) - 1
    sums = ", ".join(f"sum({terms[i]} * {terms[j]}) AS g_{min(i, j)}_{max(i, j)}"
                     for i in range(p + 1) for j in range(i, p + 1))
    cells = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, g_{min(i, j)}_{max(i, j)} AS v FROM g"
                               for i in range(p) for j in range(p + 1))
    steps = "".join(f""",
m{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN d.v <= 1e-9 * g.g_{k}_{k} THEN CASE WHEN a.i = {k} OR a.j = {k} THEN NULL ELSE a.v END
                        WHEN r.v IS NULL OR c.v IS NULL THEN NULL
                        WHEN a.i = {k} THEN a.v / d.v ELSE a.v - c.v * r.v / d.v END AS v
  FROM m{k} a JOIN m{k} r ON r.i = {k} AND r.j = a.j JOIN m{k} c ON c.j = {k} AND c.i = a.i
  JOIN m{k} d ON d.i = {k} AND d.j = {k}, g)""" for k in range(p))
    names = " ".join(f"WHEN {k} THEN '{t}'" for k, t in enumerate(["const", *flows.CAR_REGRESSORS]))
    return f"""WITH {_features_sql()}, g AS MATERIALIZED (SELECT {sums} FROM x),
m0 AS MATERIALIZED ({cells}){steps}
SELECT CASE i {names} END AS term, CASE WHEN v IS NOT NULL THEN printf('%.4e', v) END AS beta
FROM m{p} WHERE j = {p}"""


@query("car_price_betas", _betas_sql())
def car_price_betas_q(spark, sf_dir):
    """J1's 31 coefficients, to five digits; aliased regressors (three of sf0.001's, whose
    ten suppliers determine them) are null."""
    betas = flows.car_price_ols(car_records(spark, sf_dir))
    return betas.select("term", F.when(F.col("beta").isNotNull(),
                                       F.format_string("%.4e", F.col("beta"))).alias("beta"))
