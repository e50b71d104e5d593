"""Rows as JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def as_message(df: DataFrame, value: str = "value") -> DataFrame:
    """One JSON object per row in a single text column. NULL fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias(value))


def unwrap(value: Column | str) -> Column:
    """Undo one extra layer of JSON encoding (an object sent as a JSON string)."""
    value = F.col(value) if isinstance(value, str) else value
    envelope = F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "v string")
    return F.when(F.ltrim(value).startswith('"'), envelope["v"]).otherwise(value)


def is_readable(value: Column | str) -> Column:
    """Whether the text is a JSON object, encoded once or twice."""
    kind = F.json_object_keys(unwrap(value))
    return F.coalesce(kind.isNotNull(), F.lit(False))


def parse_message(value: Column | str, schema: StructType | str) -> Column:
    """Typed struct from single- or double-encoded JSON; malformed text gives NULL fields."""
    return F.from_json(unwrap(value), schema)
