"""Copies found by fingerprint: exact for missing values, signed zeros and colliding hashes."""

import re

import pytest
from pyspark.sql import functions as F

from martflow import registry
from martflow.operators import fingerprint as fp
from martflow.operators import quality
from conftest import SMALL

COLUMNS = "a int, b string, c double"
ROWS = [
    (1, None, 0.0), (1, None, -0.0), (None, "1", 0.0), (1, "x", float("nan")), (1, "x", float("nan")),
    (2, "NA", None), (2, None, None), (None, None, None), (None, None, None), (None, None, None),
]


def test_missing_values_take_part_in_the_comparison(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    assert tuple(quality.duplicate_counts(df).first()) == (10, 4)
    assert sorted(r._n for r in fp.repeated_rows(df).collect()) == [2, 2, 3]
    marks = fp.with_fingerprint(df).select(*fp.FINGERPRINT).distinct().count()
    assert marks == 6


def test_equal_fingerprints_of_different_rows_are_told_apart(spark, monkeypatch):
    """With a hash that says nothing, rows are still compared in full."""
    monkeypatch.setattr(fp, "fingerprint", lambda columns: [F.lit(7).alias(n) for n in fp.FINGERPRINT])
    df = spark.createDataFrame(ROWS, COLUMNS)
    assert tuple(quality.duplicate_counts(df).first()) == (10, 4)


@pytest.mark.parametrize("rows", [[], [(1, "x", 1.0)]])
def test_no_copies(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    assert tuple(quality.duplicate_counts(df).first()) == (len(rows), 0)
    found = {(r.metric, r.column): r.value for r in quality.profile(df).collect()}
    assert found[("rows", "")] == len(rows) and found[("duplicates", "")] == 0


def test_a_third_of_all_rows_are_one_row(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), F.lit("t").alias("b")
    )
    assert tuple(quality.duplicate_counts(df).first()) == (9000, 2999)


def exchanges(df):
    """What each hash exchange of the plan deals out: the attributes of the node below it."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning", text)


def test_the_first_pass_deals_out_24_bytes_a_row(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    counts = df.select(*fp.fingerprint(df.columns)).groupBy(*fp.FINGERPRINT).agg(F.count("*").alias("n"))
    (columns,) = exchanges(counts)
    assert len(columns.split(", ")) == 3 and "_h1" in columns and "_h2" in columns


@pytest.mark.parametrize("name", ["duplicate_profile", "full_profile"])
def test_whole_rows_move_only_where_they_repeat(spark, name):
    """No exchange of whole rows but behind the join with the stored fingerprints, which is broadcast."""
    df = registry.QUERIES[name](spark, SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text
    for found in exchanges(df):
        assert "_n" in found or "count" in found  # partial counts of rows that repeat
