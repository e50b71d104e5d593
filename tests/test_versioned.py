"""Replacing as a whole: a writer that fails midway leaves the old rows."""

import pytest
from pyspark.sql import functions as F

from martflow.sources.versioned import VersionedTable, replace_partitions


@pytest.mark.parametrize("fmt,options", [("parquet", {}), ("csv", {"header": "true"})])
def test_a_writer_that_fails_midway_keeps_the_old_rows(spark, tmp_path, rows, fmt, options):
    old = spark.range(4).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"))
    table = VersionedTable(spark, str(tmp_path / "t"), old.schema, fmt, **options)
    assert table.read().count() == 0
    table.replace(old)
    broken = spark.range(0, 100, 1, 4).select(
        "id", F.when(F.col("id") < 90, "new").otherwise(F.raise_error(F.lit("stopped")).cast("string")).alias("v")
    )
    with pytest.raises(Exception, match="stopped"):
        table.replace(broken)
    assert rows(table.read()) == rows(old)
    assert not table.replace_if_any(old.limit(0)) and rows(table.read()) == rows(old)
    table.replace(table.read().filter("id > 1"))  # from the table itself
    assert sorted(r.id for r in table.read().collect()) == [2, 3]
    assert table.replace_if_any(old) and table.read().count() == 4


def test_only_partitions_of_the_new_rows_are_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    replace_partitions(spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "month int, v string"), path, ["month"])
    replace_partitions(spark.createDataFrame([(2, "d"), (3, "e")], "month int, v string"), path, ["month"])
    assert rows(spark.read.parquet(path).select("month", "v")) == [(1, "a"), (2, "d"), (3, "e")]
