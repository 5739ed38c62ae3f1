"""The registered queries that SQL can express, on the smallest tables, and the registry."""

import re

import pytest

import __spark_entry__ as entry
from pagemill.llm import registry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SF), registry.QUERIES[name], registry.ORACLE[name], SF) == ""


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*registry.QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op1_source_mix", "op3_secret_scan", "op7_document_fingerprints", "op10_quality_rules"])
def test_native_plans(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoopJoin", plan)
