"""Plan properties the scale design relies on (checked on the executed plans)."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_columns(plan: str):
    return [s.split(",") for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_aggregate_is_partial_and_pruned(spark):
    plan = _executed_plan(entry.queries()["key_mean"](spark, SF))
    assert "partial_avg" in plan and "partial_count" in plan
    scans = _scan_columns(plan)
    assert scans and all(len(cols) == 2 for cols in scans)  # event_type, value


def test_projection_prunes_scan(spark):
    plan = _executed_plan(entry.queries()["project"](spark, SF))
    scans = _scan_columns(plan)
    assert scans and all(len(cols) == 3 for cols in scans)


def test_tf_idf_tokenises_once(spark):
    plan = _executed_plan(entry.queries()["tf_idf"](spark, SF))
    assert "ReusedExchange" in plan


def test_keyed_job_combines_before_shuffle(spark):
    plan = _executed_plan(entry.queries()["keyed_job"](spark, SF))
    assert "MapInPandas" in plan and "partial_sum" in plan


def test_no_hint_join_uses_measured_size(spark):
    plan = _executed_plan(entry.queries()["flight_delay_features"](spark, SF))
    # part is tiny here, so adaptive execution broadcasts it by measured size.
    assert "BroadcastHashJoin" in plan
