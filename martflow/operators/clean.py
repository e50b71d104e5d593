"""Cleaning: sentinels, incomplete rows, imputation, outliers, merging increments."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.dates import leading_date
from martflow.functions.missing import SENTINELS, blank_to_null
from martflow.operators.buckets import forward_fill
from martflow.session import materialize


def clean_drop(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Sentinels become NULL, then every row with a NULL goes."""
    return blank_to_null(df, sentinels).dropna("any")


def means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of every column."""
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def modes(df: DataFrame, columns: Sequence[str], buckets: int = 1 << 16, first: int = 16) -> DataFrame:
    """One row with the most frequent text of every column.

    NULLs do not count, the lowest value wins a tie; a column without values has NULL. ``df`` is read
    two or three times. First, rows are counted by bucket (a hash of the value): a task sends at most
    ``buckets`` numbers for each column, whatever the values. Then the values of the ``first`` fullest
    buckets are counted. No value is more frequent than its bucket is full, so this proves the winner
    against every bucket that holds fewer rows. Values of buckets that might hold a winner still, all
    of them where every value is rare, are counted as well. Only counted values are dealt out.
    """
    names = [f"m{i}" for i in range(len(columns))]
    every = F.array(*[F.struct(F.lit(m).alias("c"), F.col(c).alias("v")) for m, c in zip(names, columns)])
    pairs = df.select(F.explode(every).alias("p")).select("p.c", "p.v").filter("v IS NOT NULL")
    pairs = pairs.withColumn("bucket", F.pmod(F.xxhash64("v"), F.lit(buckets)).cast("int"))
    held = materialize(pairs.groupBy("c", "bucket").agg(F.count("*").alias("held")), "mode-buckets")
    fullest = Window.partitionBy("c").orderBy(F.desc("held"), "bucket")
    top = held.withColumn("place", F.row_number().over(fullest)).filter(F.col("place") <= first).collect()

    def among(kind: Callable[[str], Column]) -> Column:
        return reduce(lambda x, y: x | y, [(F.col("c") == m) & kind(m) for m in names])

    rank = F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))

    def winners(some: DataFrame) -> DataFrame:
        counts = some.groupBy("c", "v").agg(F.count("*").alias("n"))
        best = [F.min(F.when(F.col("c") == m, rank)).alias(m) for m in names]
        return materialize(counts.agg(*best), "mode-winners")

    tried = among(lambda m: F.col("bucket").isin([r.bucket for r in top if r.c == m]))
    found = winners(pairs.filter(tried))
    counted = found.select(*[f"{m}.n" for m in names]).first()
    # As many rows as the winner has, not more: a tie may go to a lower value.
    open_ = among(lambda m: F.col("held") >= F.lit(-(counted[names.index(m)] or 0)))
    rest = held.filter(open_ & ~tried).select("c", "bucket")
    if not rest.isEmpty():
        found = found.union(winners(pairs.join(rest, ["c", "bucket"], "left_semi")))
    return found.agg(*[F.min(m)["v"].alias(c) for m, c in zip(names, columns)])


def fill_from(df: DataFrame, one_row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs from a one-row frame, read as scalar subqueries of the same plan."""
    values = {c: F.coalesce(F.col(c), one_row.select(c).scalar()) for c in columns}
    return df.withColumns(values) if values else df


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to double (bad text is missing) and fill with the column mean."""
    numeric = df.withColumns({c: F.col(c).try_cast("double") for c in columns})
    return fill_from(numeric, means(numeric, columns), columns)


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the column's most frequent value; runs the jobs of ``modes``."""
    return fill_from(df, modes(df, columns), columns) if columns else df


def fill_dates(
    df: DataFrame,
    date: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Parse a date text and carry the last known date forward along ``order_by``."""
    parsed = df.withColumn(date, leading_date(F.col(date).cast("string")))
    return forward_fill(parsed, date, order_by, partition_by)


def clean_impute(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    date: str | None = None,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """Sentinels to NULL, drop copies, fill numbers, texts and dates, in this order.

    Copies are dropped before filling, so rows that only become equal by filling stay. The rows
    without copies are stored: means, modes, dates and the result all read them.
    """
    out = materialize(blank_to_null(df, sentinels).dropDuplicates(), "without-copies")
    if numeric:
        out = impute_mean(out, numeric)
    if categorical:
        out = impute_mode(out, categorical)
    if date:
        out = fill_dates(out, date, order_by, partition_by)
    return out


def z_bounds(df: DataFrame, columns: Sequence[str], k: float = 3) -> DataFrame:
    """One row: ``<c>_low`` and ``<c>_high`` = mean -/+ k sample standard deviations."""
    spread = {c: F.lit(float(k)) * F.stddev_samp(c) for c in columns}
    return df.agg(
        *[(F.avg(c) - spread[c]).alias(f"{c}_low") for c in columns],
        *[(F.avg(c) + spread[c]).alias(f"{c}_high") for c in columns],
    )


def drop_outliers(df: DataFrame, columns: Sequence[str], k: float = 3) -> DataFrame:
    """Keep rows inside the bounds of *all* columns; bounds come from the whole input.

    A NULL value, or a NULL bound (fewer than two values), drops the row.
    """
    bounds = z_bounds(df, columns, k)
    out = df
    for c in columns:
        low = bounds.select(f"{c}_low").scalar()
        high = bounds.select(f"{c}_high").scalar()
        out = out.filter(F.col(c).between(low, high))
    return out


def merge_increment(
    history: DataFrame,
    increment: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Clean the increment, append it to the history by column name, clean the whole.

    The cleaned increment is stored first: the second cleaning reads it several times (for
    means, modes and dates), and each reading would repeat the first cleaning.
    """
    part = clean(increment)
    part = materialize(
        part.select(
            *[F.col(c).cast(history.schema[c].dataType).alias(c) for c in history.columns]
        ),
        "increment",
    )
    return clean(history.unionByName(part))
