"""Whole jobs: several results written in one go. The only plans that act.

Each result is written once; whatever is needed again is read from what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martflow import schemas
from martflow.operators.clean import merge_increment
from martflow.operators.quality import validate, verdict
from martflow.plans import loyalty, products, star
from martflow.sources.sinks import write_csv, write_csv_if_any
from martflow.sources.tables import ensure_database, load_table, write_table


def loyalty_answers(
    sales: DataFrame, menu: DataFrame, members: DataFrame, until: date = loyalty.PROMOTION_END
) -> dict[str, DataFrame]:
    """The ten loyalty results by name, all lazy."""
    return {
        "total_spent": loyalty.total_spent(sales, menu),
        "visit_days": loyalty.visit_days(sales),
        "first_product": loyalty.first_product(sales, menu),
        "top_product": loyalty.top_product(sales, menu),
        "favourite_products": loyalty.favourite_products(sales, menu),
        "first_purchase_after_join": loyalty.first_purchase_after_join(sales, menu, members),
        "first_purchase_before_join": loyalty.first_purchase_before_join(sales, menu, members),
        "spend_before_join": loyalty.spend_before_join(sales, menu, members),
        "loyalty_points": loyalty.loyalty_points(sales, menu),
        "promotion_points": loyalty.promotion_points(sales, menu, members, until),
    }


def write_all(results: Mapping[str, DataFrame], write: Callable[[DataFrame, str], None]) -> None:
    """One table per result, e.g. ``write=lambda df, name: write_jdbc(df, url, name, "overwrite")``."""
    for name, df in results.items():
        write(df, name)


def product_report(
    products_table: DataFrame, cleaned_path: str, single_file: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Write the cleaned products; size pivot and second-longest are read from that file."""
    cleaned = products.cleaned_products(products_table)
    write_csv(cleaned, cleaned_path, header=True, single_file=single_file)
    stored = products_table.sparkSession.read.schema(cleaned.schema).csv(cleaned_path, header=True)
    return products.size_pivot(stored), products.nth_longest(stored)


def curate(
    history: DataFrame,
    increment: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    path: str,
    numeric: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Merge an increment into the history, store the result as CSV, and check what was stored.

    Returns the checks and the one-row verdict.
    """
    merged = merge_increment(history, increment, clean)
    write_csv_if_any(merged, path)
    stored = history.sparkSession.read.schema(merged.schema).csv(path, header=True)
    checks = validate(stored, numeric)
    return checks, verdict(checks)


def load_retail_table(
    raw: DataFrame, schema: StructType, table: str, path: str, csv_path: str, fmt: str = "orc"
) -> DataFrame:
    """Typed external table plus a CSV copy of the same rows."""
    stored = write_table(star.typed_load(raw, schema), table, fmt, path)
    write_csv(stored, csv_path, mode="overwrite")
    return stored


def store_star(
    spark: SparkSession,
    past_sales: DataFrame,
    features: DataFrame,
    store: DataFrame,
    database: str,
    folder: str,
) -> dict[str, DataFrame]:
    """Five dimensions and the fact as external ORC tables with declared schemas."""
    ensure_database(spark, database)
    with_id = star.with_feature_id(features)
    parts = {
        "dim_store": (star.dim_store(store), schemas.DIM_STORE),
        "dim_date": (star.dim_date(past_sales), schemas.DIM_DATE),
        "dim_department": (star.dim_department(past_sales), schemas.DIM_DEPARTMENT),
        "dim_holiday": (star.dim_holiday(past_sales), schemas.DIM_HOLIDAY),
        "dim_features": (star.dim_features(features), schemas.DIM_FEATURES),
        "fact_sales": (star.fact_sales(past_sales, with_id), schemas.FACT_SALES),
    }
    return {
        name: load_table(df, f"{database}.{name}", schema, f"{folder}/{name}")
        for name, (df, schema) in parts.items()
    }


def unload(tables: Mapping[str, DataFrame], folder: str, single_file: bool = False) -> None:
    """Delimited files without header per table, replacing earlier ones."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}", "overwrite", header=False, single_file=single_file)
