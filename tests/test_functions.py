"""Scalar and array functions on literal edge rows."""

from pyspark.sql import functions as F

from statflow.functions import arrays as Y
from statflow.functions import scalars as S
from statflow.functions.constants import ENGLISH_STOP_WORDS
from statflow.operators import levels as L


def _col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def _eval(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_hhmm_to_hour(spark):
    df = _col(spark, [0.0, 45.0, 729.0, 730.0, 1229.0, 1230.0, 2359.0], "double")
    assert _eval(df, S.hhmm_to_hour("v")) == [0, 1, 7, 8, 12, 13, 24]


def test_extract_number(spark):
    df = _col(spark, ["", "--", "12..3", "-7", "--5", "35.1 in", "5 seats", "6-Speed", None])
    assert _eval(df, S.extract_number("v")) == [None, None, None, 7.0, 5.0, 35.1, 5.0, 6.0, None]
    assert _eval(df, S.extract_number("v", signed=True)) == [
        None, None, None, -7.0, None, 35.1, 5.0, 6.0, None]


def test_extract_ratio_modes(spark):
    df = _col(spark, ["177 hp @ 5,750 RPM", "200 lb-ft @ 12,500 RPM", "150 hp", "5 hp @ 0,000"])
    greedy = _eval(df, S.extract_ratio("v", "greedy"))
    fixed = _eval(df, S.extract_ratio("v", "fixed"))
    assert greedy[0] == fixed[0] == 177 / 5750
    assert greedy[1] == 200 / 2500 and fixed[1] == 200 / 12500
    assert greedy[2] is None and fixed[2] is None
    assert greedy[3] is None and fixed[3] is None


def test_flag_and_years(spark):
    df = _col(spark, ["True", "False", "", None])
    assert _eval(df, S.flag("v")) == [1, 0, 0, 0]
    years = _col(spark, [2019, 2020], "int")
    assert _eval(years, S.years_before("v")) == [1, 0]


def test_fold_by_pattern(spark):
    df = _col(spark, ["SUV / Crossover", "Sedan", "Sedan Deluxe", "Coupe", None, ""])
    rules = [("SUV|Crossover", "SUV"), ("Sedan", None)]
    assert _eval(df, S.fold_by_pattern("v", rules)) == [
        "SUV", "Sedan", "Sedan Deluxe", "OthersM", "OthersM", "OthersM"]


def test_fold_levels_prefix_and_exact(spark):
    df = _col(spark, ["AAX", "B", "AA", "CC", "", None])
    assert _eval(df, L.fold_levels_expr("v", ["AA", "CC"], match="prefix")) == [
        "AAX", "9999", "AA", "CC", "", None]
    assert _eval(df, L.fold_levels_expr("v", [], match="prefix")) == [
        "AAX", "B", "AA", "CC", "", None]
    assert _eval(df, L.fold_levels_expr("v", ["AA", "CC"], match="exact")) == [
        "9999", "9999", "AA", "CC", "9999", "9999"]
    assert _eval(df, L.fold_levels_expr("v", [], match="exact")) == ["9999"] * 6


def test_fold_levels_integers(spark):
    df = _col(spark, list(range(1, 51)), "int")
    kept = [3] + list(range(10, 21))
    exact = _eval(df, L.fold_levels_expr("v", kept, match="exact"))
    prefix = _eval(df, L.fold_levels_expr("v", kept, match="prefix"))
    assert [v for v in exact if v != "9999"] == [str(k) for k in kept]
    assert set(v for v in prefix if v != "9999") == {str(k) for k in kept} | {
        str(k) for k in range(30, 40)}


def test_tokens_stopwords_ngrams(spark):
    df = _col(spark, ["I have God’s a|b dream, DREAM", "one", None])
    toks = _eval(df, Y.tokenize("v"))
    assert toks[0] == ["i", "have", "god", "s", "a|b", "dream", "dream"]
    filt = _eval(df, Y.remove_stopwords(Y.tokenize("v")))
    assert filt[0] == ["god", "a|b", "dream", "dream"]
    grams = _eval(df, Y.ngrams(Y.remove_stopwords(Y.tokenize("v")), 2))
    assert grams[0] == ["god a|b", "a|b dream", "dream dream"]
    assert grams[1] == []
    tri = _eval(df, Y.ngrams(Y.tokenize("v"), 3))
    assert tri[0][0] == "i have god" and len(tri[0]) == 5


def test_stop_words_match_spark(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_explode_values_drops_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, a array<string>")
    rows = Y.explode_values(df, ["k"], "a", "x", pos="p").orderBy("k", "p").collect()
    assert [(r.k, r.p, r.x) for r in rows] == [(1, 0, "a"), (1, 1, "b")]
