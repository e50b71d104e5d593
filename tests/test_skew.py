"""A third of all rows on one customer, product, supplier and user."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martflow import registry
from tools.check import compare, connect

TABLES = ("customer", "documents", "labels", "part", "supplier")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))

    def table(name):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")

    def one(test, value, column):
        return F.when(test, F.lit(value)).otherwise(F.col(column)).cast("bigint")

    line = F.col("l_orderkey") + F.col("l_linenumber")
    changed = {
        "orders": table("orders").withColumn(
            "o_custkey", one(F.col("o_orderkey") % 3 == 0, 7, "o_custkey")
        ),
        "lineitem": table("lineitem").withColumns(
            {
                "l_partkey": one(line % 3 == 0, 11, "l_partkey"),
                "l_suppkey": one(line % 3 == 1, 5, "l_suppkey"),
            }
        ),
        "events": table("events").withColumn(
            "user_id", one(F.col("event_id") % 3 == 0, 3, "user_id")
        ),
    }
    for name in TABLES:
        changed[name] = table(name)
    for name, df in changed.items():
        # several files: AQE splits a reducer's input between map outputs
        df.repartition(8).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def con(skewed):
    import duckdb

    con = duckdb.connect()
    for t in (*TABLES, "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed}/{t}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize(
    "name",
    [
        "customer_total_spent",
        "customer_first_product",
        "favourite_products_by_id",
        "first_purchase_after_join",
        "promo_points_first_week",
        "clean_impute_rows",
        "dim_features_dense",
        "fact_sales_all",
        "right_join_by_store",
        "order_bills",
        "stock_allocation",
        "cart_after_removals",
        "placed_order_lines",
        "stream_changes_to_table",
    ],
)
def test_results_under_skew(spark, con, skewed, name):
    ok, note = compare(spark, con, skewed, name)
    assert ok, note


SPLIT = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def final_plan(spark, make, **more):
    """The executed plan with thresholds scaled down to the small tables, and without the setting that
    forces a split: it must follow from how the query is written."""
    settings = {**SPLIT, "spark.sql.adaptive.forceOptimizeSkewedJoin": "false", **more}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = make()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name,key",
    [
        ("first_purchase_after_join", "customer_id"),
        ("promo_points_first_week", "customer_id"),
        ("cart_lines", "item_id"),
    ],
)
def test_hot_partitions_of_joins_can_be_split(spark, skewed, name, key):
    """AQE splits the hot key's partition: it may do so only where another shuffle follows the join."""
    plan = final_plan(spark, lambda: registry.QUERIES[name](spark, skewed))
    assert re.search(rf"SortMergeJoin\(skew=true\) \[{key}", plan), plan


@pytest.mark.parametrize(
    "name",
    ["first_purchase_after_join", "first_purchase_before_join", "spend_before_join", "promo_points_first_week"],
)
def test_hot_customers_are_split_beside_a_broadcast_menu(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(registry.fx, "menu", lambda spark, folder, menu=registry.fx.menu: F.broadcast(menu(spark, folder)))
    monkeypatch.setattr(registry, "_loyalty", lambda spark, folder: (registry.fx.sales(spark, folder), registry.fx.menu(spark, folder), registry.fx.members(spark, folder)))
    plan = final_plan(spark, lambda: registry.QUERIES[name](spark, skewed))
    assert "BroadcastHashJoin [product_id" in plan, plan
    assert re.search(r"SortMergeJoin\(skew=true\) \[customer_id", plan), plan
