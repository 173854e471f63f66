"""Every registered query beside its SQL, and the plans of the heavy ones."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from linkledger.adapters import catalog, oracle, star

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], oracle.ORACLE[name], SF) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["connector", "connection_count"]


def plan(df, stage="executedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join_in_plans(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.modified_since(spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(catalog.QUERIES["cloud_connector_counts"](spark, SF))
    assert "EqualTo(cloud,true)" in text and "ReadSchema: struct<connector:string,cloud:boolean>" in text


def test_documents_come_in_fragments(spark):
    docs = star.documents(spark, SF)
    assert docs.filter("path LIKE 'part-%/scan-%'").count() == (star.FRAGMENTS - 1) * docs.filter("path LIKE 'scan-%'").count()


@pytest.mark.parametrize("name", ["report_cloud_by_connector", "report_cloud_with_owners", "report_connector_in"])
def test_reports_sort_by_the_key_too(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    ranged = [line for line in text.split("\n") if "rangepartitioning(" in line]
    assert ranged and all("item_id" in line and "endpoint" in line for line in ranged)
