"""Relational databases over JDBC. URL and credentials always come from the caller."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: ranges of a numeric, date or timestamp column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def credentials(prefix: str = "MARTFLOW_DB") -> dict[str, str]:
    """User, password and driver from ``<prefix>_USER``, ``_PASSWORD`` and ``_DRIVER``."""
    found = {k: os.environ.get(f"{prefix}_{k.upper()}") for k in ("user", "password", "driver")}
    return {k: v for k, v in found.items() if v}


def read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    properties: Mapping[str, str] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table or a query; exactly one of them.

    ``query`` runs remotely as written, including ORDER BY and LIMIT, which Spark does not
    push down by itself. It cannot be split; filters on a split table are pushed down.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if query is not None and split is not None:
        raise ValueError("a query is read by one task; use a table to read in parallel")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    options["dbtable" if table else "query"] = table or query
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **kwargs)).load()


def write_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
) -> dict[str, str]:
    """``connections`` bounds how many tasks write to the database at the same time."""
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        **(properties or {}),
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    df.write.format("jdbc").mode(mode).options(**write_options(url, table, **kwargs)).save()
