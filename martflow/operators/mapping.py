"""Field mapping: rename, retype and drop columns from a declared list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_mapping(df: DataFrame, fields: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """``(source, source_type, target, target_type)`` per field; unlisted columns are dropped.

    A value that does not fit the declared type becomes NULL.
    """
    return df.select(
        *[
            F.col(source).try_cast(source_type).try_cast(target_type).alias(target)
            for source, source_type, target, target_type in fields
        ]
    )


def typed(df: DataFrame, schema) -> DataFrame:
    """Select the columns of a schema **by name** and cast them; bad values become NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
