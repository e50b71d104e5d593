"""Data quality: profiles, checks, verdicts and constraint violations, all as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.missing import SENTINELS, missing_test
from martflow.operators.clean import z_bounds
from martflow.operators.fingerprint import repeated_rows


def missing_counts(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """One row: missing values per column, from one pass."""
    return df.agg(*[F.count_if(missing_test(df, c, sentinels)).alias(c) for c in df.columns])


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: all rows, and rows beyond the first of each set of equal rows.

    Fingerprints of the rows are counted when this is called; rows are compared in full only where
    a fingerprint repeats.
    """
    return df.agg(
        F.count("*").alias("row_count"), _rows_beyond_the_first(df).alias("duplicate_rows")
    )


def _rows_beyond_the_first(df: DataFrame) -> Column:
    return F.coalesce(repeated_rows(df).agg(F.sum(F.col("_n") - 1)).scalar(), F.lit(0))


def profile(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``(metric, column, value)`` with row, duplicate and missing counts.

    Rows and missing values are counted where they are; copies are found by fingerprint.
    """
    sums = {("rows", ""): F.count("*"), ("duplicates", ""): _rows_beyond_the_first(df)}
    for c in df.columns:
        sums[("missing", c)] = F.count_if(missing_test(df, c, sentinels))
    row = df.agg(*[s.cast("bigint").alias(f"_{i}") for i, s in enumerate(sums.values())])
    cells = [
        F.struct(F.lit(m).alias("metric"), F.lit(c).alias("column"), F.col(f"_{i}").alias("value"))
        for i, (m, c) in enumerate(sums)
    ]
    return row.select(F.inline(F.array(*cells)))


def outlier_counts(df: DataFrame, columns: Sequence[str], k: float = 3) -> DataFrame:
    """``(column, outliers)``: values outside mean -/+ k standard deviations."""
    bounds = z_bounds(df, columns, k)
    row = df.agg(
        *[
            F.count_if(
                ~F.col(c).between(
                    bounds.select(f"{c}_low").scalar(), bounds.select(f"{c}_high").scalar()
                )
            ).alias(c)
            for c in columns
        ]
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers")) for c in columns]
    return row.select(F.inline(F.array(*cells)))


def validate(
    df: DataFrame,
    numeric: Sequence[str] = (),
    k: float = 3,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """``(check, column, observed, passed)`` for missing values, duplicates and outliers."""
    basics = profile(df, sentinels).filter("metric <> 'rows'")
    found = basics.select(
        F.col("metric").alias("check"), "column", F.col("value").alias("observed")
    )
    if numeric:
        odd = outlier_counts(df, numeric, k)
        found = found.unionByName(
            odd.select(F.lit("outliers").alias("check"), "column", F.col("outliers").alias("observed"))
        )
    return found.withColumn("passed", F.col("observed") == 0)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: does the data pass, that is, hold neither duplicates nor outliers?"""
    counted = F.when(F.col("check").isin("duplicates", "outliers"), F.col("observed"))
    issues = F.coalesce(F.sum(counted), F.lit(0))
    return checks.agg(issues.alias("issues"), (issues == 0).alias("passed"))


def check_constraints(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    foreign: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """``(constraint, column, violations)`` for declared keys that files cannot enforce.

    Keys are counted before they are compared, so a key shared by many rows reaches the
    comparison as one row per task.
    """
    results = []
    if not_null:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        cells = [
            F.struct(F.lit("not_null").alias("constraint"), F.lit(c).alias("column"), F.col(c).alias("violations"))
            for c in not_null
        ]
        results.append(row.select(F.inline(F.array(*cells))))
    for columns in unique:
        extra = (
            df.dropna(subset=list(columns))
            .groupBy(*columns)
            .agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("v"))
        )
        results.append(_violations(extra, "unique", ",".join(columns)))
    for c, (parent, key) in (foreign or {}).items():
        used = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("_k")).agg(
            F.count("*").alias("n")
        )
        orphans = used.join(parent.select(F.col(key).alias("_k")), "_k", "left_anti")
        results.append(
            _violations(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v")), "foreign_key", c)
        )
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _violations(one_row: DataFrame, constraint: str, column: str) -> DataFrame:
    return one_row.select(
        F.lit(constraint).alias("constraint"),
        F.lit(column).alias("column"),
        F.col("v").cast("bigint").alias("violations"),
    )
