"""End-to-end flows (J1-J5), each a composition of the operators.

J1 used-car price OLS, J2 delay classifier (features + model), J3/J4 topic
models, J5 keyed text jobs. The flows that the test tables can drive are also
registered as queries at the bottom (J2 re-aimed at lineitem x part, J3/J4 on
documents).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.functions import arrays as Y
from statflow.functions import scalars as S
from statflow.functions.constants import OTHER_LEVEL, OTHERS_LABEL
from statflow.operators import aggregates as A
from statflow.operators import embeddings
from statflow.operators import lda as tables
from statflow.operators import levels as L
from statflow.operators import linear
from statflow.operators import models as M
from statflow.operators import online_topics
from statflow.operators import rows as R
from statflow.operators.features import build_features, split
from statflow.operators.partitioning import spread
from statflow.plans.registry import query
from statflow.session import ensure_checkpoint_dir, small_methods, stored
from statflow.sinks import write_tsv
from statflow.sources import read_lines, read_table, split_fields

# ---------------------------------------------------------------- J1 used-car price OLS

# The 66 field names of a used-car listing record, in file order.
CAR_COLUMNS = [
    "vin", "back_legroom", "bed", "bed_height", "bed_length", "body_type", "cabin", "city",
    "city_fuel_economy", "combine_fuel_economy", "daysonmarket", "dealer_zip", "description",
    "engine_cylinders", "engine_displacement", "engine_type", "exterior_color", "fleet",
    "frame_damaged", "franchise_dealer", "franchise_make", "front_legroom", "fuel_tank_volume",
    "fuel_type", "has_accidents", "height", "highway_fuel_economy", "horsepower",
    "interior_color", "isCab", "is_certified", "is_cpo", "is_new", "is_oemcpo", "latitude",
    "length", "listed_date", "listing_color", "listing_id", "longitude", "main_picture_url",
    "major_options", "make_name", "maximum_seating", "mileage", "model_name", "owner_count",
    "power", "price", "salvage", "savings_amount", "seller_rating", "sp_id", "sp_name",
    "theft_title", "torque", "transmission", "transmission_display", "trimId", "trim_name",
    "vehicle_damage_category", "wheel_system", "wheel_system_display", "wheelbase", "width",
    "year",
]

# Column groups of the used-car records, in the order the
# regression uses them (intercept first, then these 30 regressors).
CAR_BOOL = ["franchise_dealer", "is_new"]
CAR_INT = ["daysonmarket", "savings_amount", "year", "maximum_seating", "transmission_display"]
CAR_FLOAT = ["city_fuel_economy", "latitude", "longitude", "mileage", "seller_rating",
             "highway_fuel_economy", "horsepower", "engine_displacement", "back_legroom",
             "front_legroom", "fuel_tank_volume", "height", "length", "wheelbase", "width",
             "power", "torque"]
CAR_TEXT_NUMBER = ["back_legroom", "front_legroom", "fuel_tank_volume", "height", "length",
                   "maximum_seating", "transmission_display", "wheelbase", "width"]
CAR_RATIO = ["power", "torque"]
CAR_SIGNED = ["daysonmarket", "savings_amount", "year", "city_fuel_economy", "latitude",
              "longitude", "mileage", "seller_rating", "highway_fuel_economy", "horsepower",
              "engine_displacement"]
# Category folds (pattern -> label, None keeps the text) and the
# dummy columns they feed, baseline "OthersM".
CAR_FOLDS = {
    "body_type": [("SUV|Crossover", "SUV"), ("Sedan", None)],
    "engine_cylinders": [("I", "I")],
    "listing_color": [("BLACK|WHITE", None)],
    "wheel_system": [("AWD|4WD|4X2", "AWD")],
}
CAR_DUMMIES = [("body_type", "body_type", ["SUV", "Sedan"]), ("engine_cylinders", "engine", ["I"]),
               ("listing_color", "color", ["BLACK", "WHITE"]), ("wheel_system", "WS", ["AWD"])]
CAR_REGRESSORS = CAR_BOOL + CAR_INT + CAR_FLOAT + [
    f"{prefix}_{lv}" for _, prefix, lvs in CAR_DUMMIES for lv in lvs]


def car_values(records: DataFrame, ratio_mode: str = "fixed") -> DataFrame:
    """J1 before imputation: ``price`` and the 30 regressors as numbers, ``year`` as read.

    ``records`` holds the text columns (``read_records`` drops records with
    the wrong field count); numbers that are missing are null.
    """
    df = records.select("price", *CAR_BOOL, *CAR_FOLDS, *CAR_INT, *CAR_FLOAT)
    df = df.withColumn("price", F.col("price").try_cast("float").cast("double"))
    df = R.drop_null_subset(df, ["price"])
    exprs = {}
    for c, rules in CAR_FOLDS.items():
        exprs[c] = S.fold_by_pattern(c, rules, OTHERS_LABEL)
    # One function over the texts of a kind: its code is compiled once, where thirty
    # expressions in one generated method would be too long for the JVM to compile.
    for cols, number in ((CAR_TEXT_NUMBER, lambda x: S.extract_number(x)), (CAR_RATIO, lambda x: S.extract_ratio(x, ratio_mode)),
                         (CAR_SIGNED, lambda x: S.extract_number(x, signed=True))):
        df = df.withColumn(f"__{cols[0]}", F.transform(F.array(*cols), number))
        exprs.update({c: F.col(f"__{cols[0]}")[k] for k, c in enumerate(cols)})
    for c in CAR_BOOL:
        exprs[c] = S.flag(c, "True").cast("double")
    df = df.withColumns(exprs)
    for col, prefix, lvs in CAR_DUMMIES:
        df = L.dummies(df, col, lvs, prefix=prefix)
    return df.select("price", *[F.col(c).cast("double") for c in CAR_REGRESSORS])


def car_table(records: DataFrame, ratio_mode: str = "fixed") -> DataFrame:
    """``car_values`` from a table in the checkpoint folder: the texts are read once."""
    with small_methods(records.sparkSession):
        return stored(car_values(records, ratio_mode))


def car_features(records: DataFrame, ratio_mode: str = "fixed", values: DataFrame | None = None) -> DataFrame:
    """J1 features: ``price`` + the 30 regressors, cleaned and mean-imputed.

    Missing numbers take the global column mean; ``year`` becomes the age relative to
    2020 after imputation. ``values``: the records' ``car_table``, if there is one.
    """
    values = car_table(records, ratio_mode) if values is None else values
    df = A.impute_mean(values, CAR_INT + CAR_FLOAT)
    return df.withColumn("year", S.years_before("year", 2020).cast("double"))


# The same imputation and age as a linear map of one scan's sums.
CAR_DESIGN = linear.Imputed(CAR_REGRESSORS, "price", CAR_INT + CAR_FLOAT, {"year": (2020.0, -1.0)})


def car_gram(records: DataFrame, ratio_mode: str = "fixed") -> DataFrame:
    """J1's cross-products (A9) over the imputed features, from one scan of the records."""
    with small_methods(records.sparkSession):
        return linear.imputed_gram(car_values(records, ratio_mode), CAR_DESIGN)


def car_price_ols(records: DataFrame, ratio_mode: str = "fixed", values: DataFrame | None = None) -> DataFrame:
    """31 ``(term, beta)`` rows, intercept first, from one scan of the records (or of
    ``values``, their ``car_table``); a regressor that those before it determine has a null
    beta."""
    with small_methods(records.sparkSession):
        r = linear.imputed_factor(car_values(records, ratio_mode) if values is None else values, CAR_DESIGN)
    terms = ["const", *CAR_REGRESSORS]
    return M.coefficients(records.sparkSession, terms, linear.solve_aliased(r, len(terms)))


def car_price_ols_file(spark: SparkSession, path: str, ratio_mode: str = "fixed",
                       header: bool = False, multiline: bool = True) -> DataFrame:
    """J1 from the raw CSV: quoted records, wrong field counts skipped; of the 66 fields
    the 29 in use leave the parser. A header line drops out with the records without a
    price; ``multiline=False`` is for files without quoted newlines (see ``read_records``)."""
    from statflow.sources import read_records
    used = ["price", *CAR_BOOL, *CAR_FOLDS, *CAR_INT, *CAR_FLOAT]
    return car_price_ols(read_records(spark, path, CAR_COLUMNS, header, multiline, used), ratio_mode)


# ---------------------------------------------------------------- J2 delay classifier


def fold_features(df: DataFrame, label: str, label_gt: float, frequent: Sequence[str],
                  allowed: Mapping[str, Sequence], hour_cols: Sequence[str] = (),
                  keep: Sequence[str] = (), p: float = 0.03, cum_p: float = 0.8,
                  mode: str = "strict", match: str = "exact") -> DataFrame:
    """J2 feature frame: project, drop nulls, hhmm -> hour, fold rare levels.

    ``frequent`` columns keep levels passing the share/cumulative cutoff
    (A6, ``mode``); ``allowed`` columns keep levels inside a fixed set (T2).
    The frequent columns' level counts come from one scan; only kept levels,
    bounded by 1/p, reach the driver. An exact fold needs no look at the data for
    the allowed columns; a prefix fold needs their observed levels. Folded columns
    are STRING, other levels become '9999'; the label is ``label > label_gt``.
    """
    fold_cols = list(frequent) + list(allowed)
    cols = list(dict.fromkeys([label, *keep, *hour_cols, *fold_cols]))
    df = R.drop_null_any(df.select(*cols))
    df = df.withColumns({c: S.hhmm_to_hour(c) for c in hour_cols})
    kept: dict[str, list] = {c: [] for c in frequent}
    kept.update({c: [str(v) for v in vs] for c, vs in allowed.items()})
    for r in L.frequent_level_table(df, list(frequent), p, cum_p, mode).collect():
        kept[r["column"]].append(r["level"])
    if match == "prefix":
        seen = L.level_counts(df, list(allowed)).select("column", "level")
        chosen = F.lit(False)
        for c in allowed:
            chosen = chosen | ((F.col("column") == c) & F.col("level").isin(kept[c]))
            kept[c] = []
        for r in seen.where(chosen).collect():  # at most the allowed sets
            kept[r["column"]].append(r["level"])
    df = df.withColumns({c: L.fold_levels_expr(c, sorted(kept[c]), OTHER_LEVEL, match)
                         for c in fold_cols})
    return df.withColumn(label, S.binarise(label, label_gt))


def delay_model(features: DataFrame, label: str, categorical: Sequence[str],
                numeric: Sequence[str], keys: Sequence[str], seed: int = 42,
                weights: Sequence[float] = (0.7, 0.3), keep: Sequence[str] = ()):
    """J2 model: index -> one-hot -> assemble, seeded hash split, logistic regression;
    returns (feature model, lr model, scored test rows). The rows are read twice (level
    counts, encoding): pass rows that are stored or persisted; training and scores
    read the encoded table. ``keys`` identify a row."""
    pipe, data = build_features(features, categorical, numeric)
    data = data.select(*keys, *keep, label, "features")
    train, test = split(data, list(weights), seed, keys)
    lr = M.fit_logistic(train, "features", label)
    return pipe, lr, M.predict(lr, test, label, keep=list(keys) + list(keep))


# The flight-delay record layout (29 fields, in file order) and
# the level rules of the delay classifier.
FLIGHT_FIELDS = [
    ("Year", "int"), ("Month", "int"), ("DayofMonth", "int"), ("DayOfWeek", "int"),
    ("DepTime", "double"), ("CRSDepTime", "double"), ("ArrTime", "double"),
    ("CRSArrTime", "double"), ("UniqueCarrier", "string"), ("FlightNum", "string"),
    ("TailNum", "string"), ("ActualElapsedTime", "double"), ("CRSElapsedTime", "double"),
    ("AirTime", "double"), ("ArrDelay", "double"), ("DepDelay", "double"),
    ("Origin", "string"), ("Dest", "string"), ("Distance", "double"), ("TaxiIn", "double"),
    ("TaxiOut", "double"), ("Cancelled", "int"), ("CancellationCode", "string"),
    ("Diverted", "int"), ("CarrierDelay", "double"), ("WeatherDelay", "double"),
    ("NASDelay", "double"), ("SecurityDelay", "double"), ("LateAircraftDelay", "double"),
]
FLIGHT_FREQUENT = ["UniqueCarrier", "Origin", "Dest"]
FLIGHT_ALLOWED = {
    "Year": list(range(1989, 2008)), "Month": list(range(2, 13)),
    "DayofMonth": list(range(1, 30)), "DayOfWeek": list(range(2, 8)),
    "CRSDepTime": list(range(7, 22)), "CRSArrTime": list(range(8, 23)),
}
FLIGHT_HOURS = ["CRSDepTime", "CRSArrTime"]
FLIGHT_NUMERIC = ["ActualElapsedTime", "Distance"]


def flight_schema():
    from pyspark.sql import types as T
    kinds = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
    return T.StructType([T.StructField(n, kinds[k], True) for n, k in FLIGHT_FIELDS])


def flight_features(spark: SparkSession, path: str, mode: str = "strict",
                    match: str = "exact") -> DataFrame:
    """J2 as defined for flight records: ``ArrDelay > 0`` label, hours from hhmm,
    carrier/airports folded by frequency, calendar and hour levels by range.
    ``DepDelay`` is read and null-checked but is no feature."""
    from statflow.sources import read_csv
    df = read_csv(spark, path, flight_schema())
    return fold_features(df, "ArrDelay", 0.0, FLIGHT_FREQUENT, FLIGHT_ALLOWED,
                         hour_cols=FLIGHT_HOURS, keep=["DepDelay"] + FLIGHT_NUMERIC,
                         mode=mode, match=match)


def flight_delay_flow(spark: SparkSession, path: str, seed: int = 42, mode: str = "strict",
                      match: str = "exact", keys: Sequence[str] = ()):
    """J2 end to end on flight records. Without ``keys`` that identify a row, rows get
    their position in the scan, so equal flights are split like any others. The feature
    rows are stored: the file is not parsed again for levels, training and scores,
    and a row keeps its position."""
    feats = flight_features(spark, path, mode, match)
    cats = FLIGHT_FREQUENT + list(FLIGHT_ALLOWED)
    if not keys:
        keys, feats = ["row"], feats.withColumn("row", F.monotonically_increasing_id())
    feats = stored(feats)
    return delay_model(feats, "ArrDelay", cats, FLIGHT_NUMERIC, list(keys), seed=seed)


# The J2 flow re-aimed at lineitem x part.
SIZE_ALLOWED = list(range(1, 30))
LP_FREQUENT = ["p_brand", "p_type"]
LP_NUMERIC = ["l_quantity", "l_extendedprice"]
LP_KEYS = ["l_orderkey", "l_linenumber"]


def lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*LP_KEYS, "l_partkey", "l_discount",
                                                      *LP_NUMERIC)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    # No hint: the planner (and AQE at runtime) broadcasts part only when its
    # measured size is under the threshold, else sort-merge joins.
    return li.join(part, li.l_partkey == part.p_partkey).drop("l_partkey", "p_partkey")


def lineitem_part_features(spark: SparkSession, sf_dir: str, mode: str = "strict",
                           match: str = "exact") -> DataFrame:
    return fold_features(lineitem_part(spark, sf_dir), "l_discount", 0.05, LP_FREQUENT,
                         {"p_size": SIZE_ALLOWED}, keep=LP_KEYS + LP_NUMERIC,
                         mode=mode, match=match).withColumnRenamed("l_discount", "label")


def flagship(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    """J2 end to end on lineitem x part: label, probability, prediction per held-out row."""
    feats = stored(lineitem_part_features(spark, sf_dir))
    return delay_model(feats, "label", LP_FREQUENT + ["p_size"], LP_NUMERIC, LP_KEYS, seed=seed)[2]


# ---------------------------------------------------------------- J3/J4 topic models


def text_terms(df: DataFrame, text: str, out: str = "ngrams", n: int = 2) -> DataFrame:
    """tokens -> stop words removed -> n-grams (Y1-Y3), JVM expressions only."""
    return (df.withColumn("words", Y.tokenize(text))
            .withColumn("filtered_words", Y.remove_stopwords("words"))
            .withColumn(out, Y.ngrams("filtered_words", n)))


def topic_model(df: DataFrame, text: str, key: str, k: int = 5, max_iter: int = 10,
                seed: int = 42, vocab_size: int | None = None, min_df: float = 1.0,
                partitions: int | None = None):
    """N-grams -> term counts over the whole vocabulary -> IDF -> LDA.

    ``key`` identifies the rows. Returns (TopicModel, rows ``key, terms``); the topics are a
    table (see ``operators.lda``), and so are the rows.
    """
    terms = text_terms(spread(df, partitions, key), text).select(key, "ngrams")
    vocab, rows = M.weighted_terms(terms, key, "ngrams", vocab_size, min_df)
    lda = tables.fit_topics(tables.entries(rows, key), vocab, k, max_iter, seed)
    return M.TopicModel(vocab, None, lda, "terms"), rows


def topic_model_embedded(df: DataFrame, text: str, k: int = 5, max_iter: int = 10,
                         seed: int = 42, vector_size: int | str = "median",
                         optimizer: str = "em", partitions: int | None = None,
                         embedder: str = "word2vec", key: str | None = None):
    """N-grams -> term vectors (size = median n-gram count) -> topics of their means.

    ``optimizer="online"`` (the original's choice) is ``online_topics``: word vectors hold
    negative values, on which Spark's own online loop may never end. It needs the rows'
    ``key``. ``em`` makes ``max_iter`` rounds of expectation maximisation (``vector_em``).
    ``embedder="word2vec"`` trains skip-gram vectors; ``"table"`` (online topics only) takes
    those of ``embeddings.embed_terms``.
    """
    terms = text_terms(spread(df, partitions), text)
    if optimizer != "online":
        if embedder != "word2vec":
            raise ValueError("vectors as tables go with the online optimiser")
        w2v, embedded = M.embed(terms, "ngrams", "word_vec", vector_size, seed=seed)
        return M.TopicModel(None, w2v, M.fit_lda(embedded, "word_vec", k, max_iter, seed, optimizer),
                            "word_vec"), embedded
    if key is None:
        raise ValueError("online topics need the column that identifies a row")
    ensure_checkpoint_dir(df.sparkSession)
    if embedder == "word2vec":
        model, embedded = M.embed(terms, "ngrams", "word_vec", vector_size, seed=seed)
        embedded = embedded.select(key, vector_to_array("word_vec").alias("word_vec"))
    else:
        terms = stored(terms.select(key, "ngrams"))
        size = M.median_vector_size(terms, "ngrams") if vector_size == "median" else int(vector_size)
        model = embeddings.embed_terms(terms, "ngrams", size, seed=seed)
        values = F.array(*[F.col(f"v{j}") for j in range(model.size)]).cast("array<double>")
        embedded = embeddings.mean_vectors(terms, [key], "ngrams", model).select(
            key, values.alias("word_vec"))
    embedded = stored(embedded)
    topics = online_topics.fit_online(embedded, [key], "word_vec", k, max_iter, seed)
    return M.TopicModel(None, model, topics, "word_vec"), embedded


# ---------------------------------------------------------------- J5 keyed text jobs


def keyed_text_job(spark: SparkSession, in_path: str, out_path: str, kind: str,
                   names: Sequence[str] = ("symbol", "date", "open", "high"),
                   sep: str = ",") -> DataFrame:
    """Text lines -> fields -> one keyed job -> tab-separated output.

    ``kind``: ``count`` (rows per key, key order), ``mean`` (mean of the third
    field per key, 6 decimals), ``profile`` (lines, min and max fields) or
    ``cluster`` (first four fields, tab-joined, sorted by key).
    """
    from statflow.operators.jobs import cluster_by
    from statflow.sinks import format_line
    lines = read_lines(spark, in_path)
    key, value = names[0], names[2]
    if kind == "profile":
        out = A.record_profile(lines, "value", sep)
    else:
        # Only the mean needs a number; the other jobs pass the text through.
        types = {value: "double"} if kind == "mean" else None
        fields = split_fields(lines, list(names), sep, types=types)
        if kind == "count":
            out = A.count_by(fields, key, out="count")
        elif kind == "mean":
            out = format_line(A.mean_by(fields, key, value, count_out=None),
                              [(key, "%s"), ("mean", "%f")])
        elif kind == "cluster":
            out = cluster_by(fields, key).select(
                F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                    for c in names]).alias("line"))
        else:
            raise ValueError(f"unknown kind {kind!r}")
    write_tsv(out, out_path)
    return out


# ---------------------------------------------------------------- registered flow queries


def _frequent_cte(col: str) -> str:
    return f"""{col}_c AS (SELECT {col} AS level, count(*) AS cnt FROM j GROUP BY {col}),
{col}_r AS (SELECT level, cnt,
  CAST(sum(cnt) OVER (ORDER BY cnt DESC, level ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS cum, CAST(sum(cnt) OVER () AS BIGINT) AS n FROM {col}_c),
{col}_k AS (SELECT level FROM {col}_r WHERE cum / n <= 0.8::DOUBLE AND cnt / n > 0.03::DOUBLE)"""


_ALLOWED_SQL = ", ".join(f"'{v}'" for v in SIZE_ALLOWED)


@query("flight_delay_features", f"""
WITH j AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
                  p_brand, p_type, p_size
           FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL
             AND l_extendedprice IS NOT NULL AND l_discount IS NOT NULL AND p_brand IS NOT NULL
             AND p_type IS NOT NULL AND p_size IS NOT NULL),
{_frequent_cte("p_brand")},
{_frequent_cte("p_type")}
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
       CASE WHEN p_brand IN (SELECT level FROM p_brand_k) THEN p_brand ELSE '9999' END AS p_brand,
       CASE WHEN p_type IN (SELECT level FROM p_type_k) THEN p_type ELSE '9999' END AS p_type,
       CASE WHEN CAST(p_size AS VARCHAR) IN ({_ALLOWED_SQL}) THEN CAST(p_size AS VARCHAR)
            ELSE '9999' END AS p_size,
       CAST(l_discount > 0.05 AS INTEGER) AS label
FROM j
""")
def flight_delay_features_q(spark, sf_dir):
    return lineitem_part_features(spark, sf_dir)


@query("flight_delay_model")
def flight_delay_model_q(spark, sf_dir):
    out = flagship(spark, sf_dir)
    return out.select(*LP_KEYS, "label", F.col("probability")[1].alias("p1"), "prediction")


_SPLIT_U = ("CAST('0x' || substr(md5('42:' || l_orderkey || ':' || l_linenumber), 1, 12) AS BIGINT)"
            " / 281474976710656.0::DOUBLE")


@query("split", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN {_SPLIT_U} < 0.7::DOUBLE THEN 'train' ELSE 'test' END
         AS part
FROM lineitem
""")
def split_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(*LP_KEYS)
    train, test = split(li, [0.7, 0.3], 42, LP_KEYS)
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


TEXT_TASKS = 32  # documents are one file: deal its rows to so many tasks


def _documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _documents_model(spark, sf_dir):
    return topic_model(_documents(spark, sf_dir), "text", "doc_id", partitions=TEXT_TASKS)


@query("topic_model")
def topic_model_q(spark, sf_dir):
    tm, _ = _documents_model(spark, sf_dir)
    return M.topic_words(tm, 10)


@query("doc_topics")
def doc_topics_q(spark, sf_dir):
    tm, rows = _documents_model(spark, sf_dir)
    return M.doc_topics(tm.lda, rows, ["doc_id"])


@query("lda_topics")
def lda_topics_q(spark, sf_dir):
    tm, _ = _documents_model(spark, sf_dir)
    return M.topics(tm.lda, 5)


@query("word2vec")
def word2vec_q(spark, sf_dir):
    from statflow.operators.features import vector_entries
    terms = text_terms(spread(_documents(spark, sf_dir), TEXT_TASKS), "text")
    _, embedded = M.embed(terms.select("doc_id", "ngrams"), "ngrams", "word_vec")
    return vector_entries(embedded, ["doc_id"], "word_vec")


@query("topic_model_embedded")
def topic_model_embedded_q(spark, sf_dir):
    tm, _ = topic_model_embedded(_documents(spark, sf_dir), "text", partitions=TEXT_TASKS)
    return M.topics(tm.lda, 5)


def logistic_fit(spark, sf_dir):
    """M5, M7, M8 on numeric lineitem columns, label ``l_discount > 0.05``: training
    rows, held-out rows and the model."""
    from statflow.operators.features import assemble
    li = read_table(spark, sf_dir, "lineitem").select(
        *LP_KEYS, "l_quantity", "l_extendedprice", "l_tax",
        S.binarise("l_discount", 0.05).alias("label"))
    data = assemble(li, ["l_quantity", "l_extendedprice", "l_tax"])
    train, test = split(data, [0.7, 0.3], 42, LP_KEYS)
    return train, test, M.fit_logistic(train, "features", "label")


@query("logistic")
def logistic_q(spark, sf_dir):
    """M5, M8, M9 alone: scored held-out rows with P(label = 1)."""
    _, test, model = logistic_fit(spark, sf_dir)
    scored = M.predict(model, test, "label", keep=LP_KEYS)
    return scored.select(*LP_KEYS, "label", F.col("probability")[1].alias("p1"), "prediction")
