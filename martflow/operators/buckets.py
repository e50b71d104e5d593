"""Ordered work in ranges: how numbering, filling and settling are cut into tasks.

An ordered computation over one huge group is cut into consecutive ranges of about as many rows
each: Spark samples the order columns and deals rows out by them, so that the cut follows the rows,
whatever their values are. Ranges are worked on in parallel; what one range hands to the next is
one small row for each range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.session import materialize

# Row position as ``monotonically_increasing_id`` packs it: the task, then the row within it.
TASK_BITS = 33


def ranged(df: DataFrame, order_by: Sequence[str], label: str, parts: int | None = None) -> DataFrame:
    """``df`` stored in the order of ``order_by``, with ``_part`` (its range) and ``_at`` (place in it).

    Ranges have ascending numbers; rows with equal values are in one range. Stored, because the cut is
    sampled: whoever reads it twice must see the same one.
    """
    cut = df.repartitionByRange(parts, *order_by) if parts else df.repartitionByRange(*order_by)
    placed = cut.sortWithinPartitions(*order_by).withColumn("_row", F.monotonically_increasing_id())
    stored = materialize(placed, label)
    return stored.withColumns(
        {
            "_part": F.shiftright("_row", TASK_BITS),
            "_at": F.col("_row").bitwiseAND(F.lit((1 << TASK_BITS) - 1)),
        }
    ).drop("_row")


def dense_ids(
    df: DataFrame, order_by: Sequence[str], name: str, start_after: int = 0, parts: int | None = None
) -> DataFrame:
    """Gapless ids 1, 2, 3, ... in the order of ``order_by``, which must be unique.

    Rows are numbered inside their range; the offset of a range is the number of rows before it, a
    running sum over one row for each range. The input is computed once and stored.
    """
    rows = ranged(df, order_by, "numbered", parts)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    identity = (F.col("_offset") + F.col("_at") + F.lit(start_after + 1)).cast("bigint")
    return rows.join(offsets, "_part").select(*[f"`{c}`" for c in df.columns], identity.alias(name))


def forward_fill(
    df: DataFrame,
    value: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Fill NULLs of ``value`` with the latest earlier value of the same group.

    ``order_by`` must be unique per group. Each part of a group that lies in one range is filled on its
    own; what is carried into it comes from one row for each earlier range of the group. Rows before the
    first known value stay NULL.
    """
    rows = ranged(df, [*partition_by, *order_by], "filled", parts)
    marked = rows.withColumn("_k", F.struct(*(partition_by or [F.lit(0).alias("all")])))
    known = F.when(F.col(value).isNotNull(), F.col("_at"))
    earlier = (
        Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        marked.groupBy("_k", "_part")
        .agg(F.max_by(F.col(value), known).alias("_last"))
        .select("_k", "_part", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    )
    so_far = (
        Window.partitionBy("_k", "_part")
        .orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = marked.withColumn("_local", F.last(value, ignorenulls=True).over(so_far))
    filled = F.coalesce("_local", "_carried").alias(value)
    return local.join(carried, ["_k", "_part"]).select(
        *[filled if c == value else F.col(f"`{c}`") for c in df.columns]
    )
