"""Tests and replacements for values that stand for "missing"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Text that stands for a missing value in the raw files.
SENTINELS = ("NA", "na")


def is_missing(c: Column | str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """NULL or one of the sentinel texts. Never NULL itself."""
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    return c.isNull() | F.coalesce(text.isin(*sentinels), F.lit(False))


def missing_test(df: DataFrame, name: str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """``is_missing`` for a column of ``df``; only text columns look at the sentinels."""
    if isinstance(df.schema[name].dataType, StringType):
        return is_missing(name, sentinels)
    return F.col(name).isNull()


def blank_to_null(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Replace the sentinel texts by NULL in every text column."""
    return df.replace(list(sentinels), None)
