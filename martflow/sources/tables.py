"""Catalog databases and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def scan(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def create_external(
    spark: SparkSession, name: str, schema: StructType, path: str, fmt: str = "ORC"
) -> None:
    """Empty external table with a declared schema; an old definition is dropped first."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    drop_table(spark, name)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{path}'")


def load_table(
    df: DataFrame, name: str, schema: StructType, path: str, fmt: str = "ORC"
) -> DataFrame:
    """Create the external table and overwrite it with the columns of the schema.

    Columns are matched by name and cast here, because ``insertInto`` goes by position.
    """
    spark = df.sparkSession
    create_external(spark, name, schema, path, fmt)
    ordered = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    ordered.write.insertInto(name, overwrite=True)
    return spark.table(name)


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    single_file: bool = False,
) -> DataFrame:
    """Save as a catalog table (external with ``path``).

    ``bucket_by=(n, columns)`` stores the rows hashed by a join key: later joins on that
    key read co-located buckets and need no shuffle.
    """
    writer = (df.coalesce(1) if single_file else df).write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, columns = bucket_by
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_rows(spark: SparkSession, name: str, rows: Sequence[tuple], columns: Sequence[str]) -> None:
    """Append a few literal rows (seed data); columns left out become NULL."""
    schema = spark.table(name).schema
    given = StructType([schema[c] for c in columns])
    seed = spark.createDataFrame(list(rows), given)
    full = seed.select(
        *[
            F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    full.write.insertInto(name)
