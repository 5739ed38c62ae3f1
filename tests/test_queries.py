"""Every registered query against its SQL, and what all plans must not contain."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for m in entry.LIBRARY for name, query in m.QUERIES.items()}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF).count() > 0
    else:
        assert compare(spark, con, query, sql, SF) == ""
    plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == {name for m in entry.LIBRARY for name in m.ORACLE}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "page_id", "url", "title", "chunk_idx", "content", "n_tokens", "truncated"]
    assert df.count() > 0


def test_plans(spark):
    plan = lambda name: entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan("topk_exact")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan("token_count")
    assert "TakeOrderedAndProject" in plan("latest_by_name")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in plan("latest_by_name")
    chunks = plan("chunk_rows")
    assert "hashpartitioning" not in chunks and "Python" not in chunks
