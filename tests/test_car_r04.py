"""The used-car flow reads its texts once and runs compiled code."""

import __spark_entry__ as entry
from statflow.plans import car_queries, flows
from statflow.session import METHOD_SETTING

SF = "/root/testdata/sf0.001"


def test_texts_are_read_once(spark, monkeypatch):
    calls, values = [], flows.car_values
    monkeypatch.setattr(flows, "car_values", lambda *a: calls.append(spark.conf.get(METHOD_SETTING)) or values(*a))
    setting = spark.conf.get(METHOD_SETTING)
    assert entry.queries()["car_price_ols"](spark, SF).where("holds").count() == 31
    assert calls == ["8000"] and spark.conf.get(METHOD_SETTING) == setting
    plan = entry.queries()["car_features"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and len(calls) == 2


def test_records_are_no_interpreted_function(spark):
    plan = car_queries.car_records(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


def test_values_in_a_table_give_the_same_fit(spark):
    records = car_queries.car_records(spark, SF)
    values = flows.car_table(records)
    a, b = ({r.term: r.beta for r in flows.car_price_ols(records, values=v).collect()} for v in (None, values))
    assert a.keys() == b.keys() and all((a[t] is None) == (b[t] is None) for t in a)
    assert all(abs(a[t] - b[t]) <= 1e-9 * max(1.0, abs(a[t])) for t in a if a[t] is not None)
    assert flows.car_features(records).count() == flows.car_features(records, values=values).count() == values.count()
