"""Picking rows per group and overall.

All picks are written as a ranking window compared with a constant. Catalyst turns that
into a ``WindowGroupLimit`` that runs *before* the shuffle as well, so each task sends at
most the few rows that can still win: n rows per group for ``nth_per_group``, the rows tied
at the task's best value for ``leaders_per_group``. A group holding a third of all rows
therefore costs its own scan, not one giant task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nth_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int = 1
) -> DataFrame:
    """The n-th row of every group; ``order_by`` must end in a unique key to be deterministic."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).filter(F.col("_place") == n).drop("_place")


def leaders_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """All rows tied for the first place of their group."""
    place = F.rank().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """The first k rows overall (planned as a per-task heap, not as a sort)."""
    return df.orderBy(*order_by).limit(k)
