"""Every core query beside its SQL over the smallest tables, and the plans of the hot ones."""

import pytest
from compare_sql import compare, duck

import __spark_entry__ as entry
from layerline.plans import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    same, text = compare(spark, con, DATA, name, queries.QUERIES[name], queries.ORACLE.get(name))
    assert same, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p4_found", "reconcile_records", "embedding_view_full"])
def test_no_python_in_plans(spark, name):
    p = plan(queries.QUERIES[name](spark, DATA))
    assert "Python" not in p and "Arrow" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_are_pruned(spark):
    df = queries.QUERIES["duplicate_ids"](spark, DATA)
    assert "ReadSchema: struct<build_id:string,id:string>" in df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    p = plan(queries.QUERIES["enabled_sources"](spark, DATA))
    assert "PushedFilters: [IsNotNull(enabled), EqualTo(enabled,true)]" in p
