"""Driver contract: entry smoke run, registry shape, and a sample of oracle checks."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_registry_shape():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 50
    assert set(orc) <= set(qs)
    assert all(isinstance(s, str) and s.strip() for s in orc.values())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert set(df.columns) >= {"label", "probability", "prediction"}
    assert df.count() > 0


FAST = ["key_count", "key_mean", "record_profile", "project_positions", "filter_arity",
        "format_line", "hhmm_to_hour", "extract_ratio", "freq_table", "frequent_levels_strict",
        "frequent_levels_inclusive", "frequent_levels_many", "level_report", "fold_levels_prefix", "string_index",
        "assemble", "gram", "ols_simple", "ols_multi", "ngrams", "tf_idf", "lookup", "keyed_job",
        "flight_delay_features", "ols_nulls", "vocabulary", "lookup_arrays", "split",
        "keyed_job_reducer", "keyed_job_first_last", "keyed_job_differences", "car_features", "car_gram", "car_price_ols", "read_csv",
        "read_paragraphs", "read_lines", "read_records", "read_records_multiline",
        "read_records_narrow", "split_fields", "write_tsv",
        "text_job_count", "text_job_mean", "text_job_profile", "text_job_cluster",
        "logistic_checked", "logistic_calibrated", "flight_delay_model_checked",
        "doc_topics_checked", "topic_model_checked", "lda_topics_checked",
        "lda_step_topics", "lda_step_docs", "logistic_coefficients", "logistic_predictions",
        "car_price_betas"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duck(SF)
    ok, msg, _ = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, msg


def test_car_betas_at_full_rank(spark):
    df = entry.queries()["car_price_betas"](spark, "/root/testdata/sf0.01")
    assert df.columns == ["term", "beta"]
    ok, msg, n = compare(df, duck("/root/testdata/sf0.01"), entry.oracle_sql()["car_price_betas"])
    assert ok and n == 31, msg
