"""File sources: CSV in all its declared forms, delimited text lines, external CSV tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martflow.functions.text import fields


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer: bool = False,
    recursive: bool = False,
    check_header: bool = True,
    separator: str = ",",
    header: bool = True,
    **options: str,
) -> DataFrame:
    """Headered CSV; every column is text unless a schema is declared or inferred.

    With a declared schema the header names are checked against it, so that a changed
    column order fails instead of shifting data (``check_header=False`` goes by position).
    ``recursive`` reads all files below the path; globs work either way.
    """
    reader = spark.read.option("header", header).option("sep", separator)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not (check_header and header))
    elif infer:
        reader = reader.option("inferSchema", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.options(**options).csv(path)


def parse_delimited(
    lines: DataFrame,
    types: Mapping[str, str],
    line: str = "value",
    separator: str = ",",
) -> DataFrame:
    """Text lines to typed columns plus ``reject``: 'arity', 'type' or NULL for a good row.

    ``types`` maps field names, in order, to Spark types. Rejected rows stay visible here;
    ``accepted`` drops them and ``reject_counts`` counts them.
    """
    # Unnesting a one-element array keeps later filters above the split: pushed below it,
    # they would split every line again for each field they look at.
    parts = F.col("_parts")
    lines = lines.select(F.explode(F.array(fields(F.col(line), separator))).alias("_parts"))
    whole = F.size(parts) == len(types)
    columns: dict[str, Column] = {
        name: F.when(whole, F.get(parts, i)).try_cast(kind)
        for i, (name, kind) in enumerate(types.items())
    }
    bad_type = F.lit(False)
    for name in types:
        bad_type = bad_type | columns[name].isNull()
    reject = F.when(~F.coalesce(whole, F.lit(False)), "arity").when(bad_type, "type")
    return lines.select(*[c.alias(n) for n, c in columns.items()], reject.alias("reject"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull()).drop("reject")


def reject_counts(parsed: DataFrame) -> DataFrame:
    """``(reject, lines)``; accepted lines are counted under 'none'."""
    reason = F.coalesce("reject", F.lit("none")).alias("reject")
    return parsed.groupBy(reason).agg(F.count("*").alias("lines"))


def read_delimited(
    spark: SparkSession, path: str, types: Mapping[str, str], separator: str = ","
) -> DataFrame:
    return parse_delimited(spark.read.text(path), types, separator=separator)


def register_external_csv(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    separator: str = ",",
    header: bool = False,
) -> DataFrame:
    """External table on delimited text that other jobs wrote; nothing is copied."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING CSV "
        f"OPTIONS (sep '{separator}', header '{str(header).lower()}') LOCATION '{path}'"
    )
    return spark.table(name)
