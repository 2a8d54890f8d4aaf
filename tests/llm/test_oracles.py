"""SQL oracles of the training-data queries."""

import pytest

import __spark_entry__ as entry
from statflow.llm.oracles import oracles
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_oracle(spark, name):
    ok, msg, _ = compare(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name])
    assert ok, msg
