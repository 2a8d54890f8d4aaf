"""Level tables, cutoffs and the distributed running total."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from statflow.operators import levels as L
from statflow.operators.ordering import global_rank, running_total


def test_running_total_matches_window(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), i, rnd.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    got = running_total(df, "v", [F.desc("v"), F.asc("k")], "cum", partition_by=["g"],
                        num_partitions=7)
    w = (Window.partitionBy("g").orderBy(F.desc("v"), F.asc("k"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    want = df.withColumn("cum", F.sum("v").over(w))
    assert sorted(map(tuple, got.select("g", "k", "cum").collect())) == \
        sorted(map(tuple, want.select("g", "k", "cum").collect()))


def test_global_rank(spark):
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(101)], "k int, v int")
    got = {r.k: r.rank for r in global_rank(df, ["v"], "rank").collect()}
    assert sorted(got.values()) == list(range(1, 102))
    assert got[0] == 1  # v = 0 comes first


def _levels_df(spark, counts):
    rows = [(lv,) for lv, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "x string")


def test_freq_table_ties_and_shares(spark):
    df = _levels_df(spark, {"b": 3, "a": 3, "c": 2, "d": 2})
    rows = L.freq_table(df, "x").orderBy("cum").collect()
    assert [(r.level, r.cnt, r.cum) for r in rows] == [
        ("a", 3, 3), ("b", 3, 6), ("c", 2, 8), ("d", 2, 10)]
    assert rows[-1].cum_share == 1.0 and rows[0].share == 0.3


def test_frequent_levels_modes_at_exact_cutoff(spark):
    # cumulative shares: 0.4, 0.8 (exactly the cutoff), 0.9, 0.95, 1.0
    df = _levels_df(spark, {"a": 8, "b": 8, "c": 2, "d": 1, "e": 1})
    strict = {r.level for r in L.frequent_levels(df, "x", 0.03, 0.8, "strict").collect()}
    inclusive = {r.level for r in L.frequent_levels(df, "x", 0.03, 0.8, "inclusive").collect()}
    assert strict == {"a", "b"}
    assert inclusive == {"a", "b"}
    df2 = _levels_df(spark, {"a": 7, "b": 8, "c": 3, "d": 1, "e": 1})
    strict2 = {r.level for r in L.frequent_levels(df2, "x", 0.03, 0.8, "strict").collect()}
    incl2 = {r.level for r in L.frequent_levels(df2, "x", 0.03, 0.8, "inclusive").collect()}
    # shares 0.40, 0.75, 0.90: inclusive also takes c, the level that crosses 0.8
    assert strict2 == {"a", "b"} and incl2 == {"a", "b", "c"}
    assert strict2 <= incl2


def test_frequent_levels_topk_equals_full(spark):
    rnd = random.Random(3)
    rows = [(str(int(rnd.paretovariate(1.2))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "x string")
    for mode in ("strict", "inclusive"):
        fast = {r.level for r in L.frequent_levels(df, "x", 0.03, 0.8, mode).collect()}
        table = L.level_table(df, ["x"])
        cond = L._kept_condition(0.03, 0.8, mode)
        full = {r.level for r in table.where(cond).collect()}
        assert fast == full


def test_level_report_partition(spark):
    df = spark.createDataFrame([(i % 7, str(i % 3)) for i in range(100)], "a int, b string")
    rep = L.level_report(df, {"a": {"allowed": [1, 2, 3]},
                              "b": {"p": 0.03, "cum_p": 0.8, "mode": "inclusive"}})
    pdf = rep.toPandas()
    assert set(pdf[pdf.column == "a"].level) == {str(i) for i in range(7)}
    assert set(pdf[(pdf.column == "a") & pdf.kept].level) == {"1", "2", "3"}
    kept = L.frequent_levels(df, "b", mode="inclusive")
    all_b = L.levels(df, "b")
    dropped = {r.level for r in L.dropped_levels(all_b, kept).collect()}
    kept_set = {r.level for r in kept.collect()}
    assert kept_set | dropped == {"0", "1", "2"} and not kept_set & dropped


def test_level_counts_one_pass(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "a int, b string")
    got = {(r.column, r.level): r.cnt for r in L.level_counts(df, ["a", "b"]).collect()}
    assert got == {("a", "1"): 2, ("a", "2"): 1, ("b", "x"): 2, ("b", "y"): 1}


def test_dummies(spark):
    df = spark.createDataFrame([("SUV",), ("Sedan",), ("OthersM",), (None,)], "t string")
    out = L.dummies(df, "t", ["SUV", "Sedan", "OthersM"], prefix="body", baseline="OthersM")
    assert out.columns == ["body_SUV", "body_Sedan"]
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_results_stable_under_repartition(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    base = sorted(map(tuple, L.freq_table(df, "p_brand").collect()))
    for n in (1, 7):
        assert sorted(map(tuple, L.freq_table(df.repartition(n), "p_brand").collect())) == base


def test_frequent_levels_without_share_floor(spark):
    df = _levels_df(spark, {"a": 5, "b": 3, "c": 1, "d": 1})
    for mode in ("strict", "inclusive"):
        got = {r.level for r in L.frequent_levels(df, "x", 0.0, 0.8, mode).collect()}
        want = {r.level for r in L.level_table(df, ["x"]).where(
            L._kept_condition(0.0, 0.8, mode)).collect()}
        assert got == want
    assert {r.level for r in L.frequent_levels(df, "x", 0.0, 0.8, "strict").collect()} == {"a", "b"}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "x string")
    assert L.freq_table(empty, "x").count() == 0
    assert L.frequent_levels(empty, "x").count() == 0
    assert L.level_table(empty, ["x"]).count() == 0


def test_running_total_keeps_null_groups(spark):
    from statflow.operators.ordering import running_total
    df = spark.createDataFrame([("a", 1, 10), (None, 1, 5), (None, 2, 7)], "g string, o int, v int")
    got = {(r.g, r.o): r.t for r in running_total(df, "v", ["o"], "t", partition_by=["g"]).collect()}
    assert got == {("a", 1): 10, (None, 1): 5, (None, 2): 12}


@pytest.mark.parametrize("p", [0.0, 0.01, 0.2])
def test_frequent_levels_is_one_rule_for_every_share(spark, p):
    from statflow.operators.levels import frequent_levels
    counts = {"a": 50, "b": 30, "c": 10, "d": 9, "e": 1}
    df = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "c string")
    got = {r.level: r.cum for r in frequent_levels(df, "c", p=p, cum_p=0.9).collect()}
    want = {"a": 50, "b": 80, "c": 90}
    assert got == {k: v for k, v in want.items() if counts[k] / 100 > p}


def test_running_totals_of_several_values(spark):
    from statflow.operators.ordering import running_totals
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 3, i) for i in range(60)], "g int, v long").repartition(4)
    out = running_totals(df, {"a": "v", "b": F.lit(1).cast("long")}, ["v"], ["g"], num_partitions=5)
    assert out.columns == ["g", "v", "a", "b"]
    for g in (None, 0, 1, 2):
        rows = sorted((r.v, r.a, r.b) for r in out.collect() if r.g == g)
        total = 0
        for k, (v, a, b) in enumerate(rows):
            total += v
            assert (a, b) == (total, k + 1)


def test_summaries_keep_the_same_levels(spark):
    """Millions of levels would not differ: skew, ties at the cutoff, nulls, rare levels in
    their thousands, two columns at once."""
    df = spark.range(0, 60_000, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 7 = 0 THEN 1 WHEN id % 11 = 0 THEN 2 ELSE CAST(id AS INT) END AS a",
        "CASE WHEN id < 1800 THEN 'x' WHEN id < 3601 THEN 'y' ELSE concat('r', id % 20000) END AS b")
    for col in ("a", "b"):
        for mode in ("strict", "inclusive"):
            args = dict(p=0.03, cum_p=0.8, mode=mode)
            want = [tuple(r) for r in L.frequent_levels(df, col, **args).orderBy("cum").collect()]
            got = L.frequent_levels(df, col, **args, sketch=True)
            assert dict(got.dtypes) == dict(L.frequent_levels(df, col, **args).dtypes)
            assert [tuple(r) for r in got.orderBy("cum").collect()] == want and want
    both = {tuple(r) for r in L.frequent_level_table(df, ["a", "b"], sketch=True).collect()}
    assert both == {tuple(r) for r in L.frequent_level_table(df, ["a", "b"]).collect()}
    assert L.heavy_counts(df, ["a"], 0.03).count() <= 67
    empty = df.where("b = 'none'")
    assert L.frequent_levels(empty, "b", sketch=True).count() == 0
    with pytest.raises(ValueError):
        L.heavy_counts(df, ["a"], 1e-6)
