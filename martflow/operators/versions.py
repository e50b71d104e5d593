"""Numbered folders, of which the highest that can be read counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def latest_folder(spark: SparkSession, path: str, schema: str) -> int | None:
    """The highest number of a folder ``version=<n>`` below ``path`` that holds rows; None without any."""
    try:
        table = spark.read.schema(f"{schema}, version long").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing stored yet
            return None
        raise
    return table.agg(F.max("version")).first()[0]
