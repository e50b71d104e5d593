"""Every named query against its SQL on whole small tables, and the plans that matter."""

import sys
from pathlib import Path

import pytest
from conftest import SMALL

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402
from martflow import oracles, registry  # noqa: E402
from tools.check import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = compare(spark, con, SMALL, name)
    assert ok, note


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(oracles.SQL) <= set(registry.QUERIES)
    assert not contract.entry(spark).isEmpty()


def plan(spark, name):
    df = registry.QUERIES[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name",
    [
        "customer_first_product",
        "favourite_products_by_name",
        "first_purchase_after_join",
        "first_purchase_before_join",
        "second_longest_per_category",
    ],
)
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "renamed_sales")
    assert "LessThan(l_shipdate" in text
    assert "l_tax" not in text and "l_partkey" not in text


def test_top_product_needs_no_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_product")


def test_stored_buckets_are_joined_without_an_exchange(spark):
    """With sides too large to broadcast, the join reads both as they are stored."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, _ = registry._bucketed_facts(spark, SMALL)
        text = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert text.count("Bucketed: true") == 2
