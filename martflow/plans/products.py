"""Product list: outliers, key parts, year, size classes, pivot, second-longest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.rules import SIZE_LABELS, size_class
from martflow.functions.text import four_digit_year, part_at
from martflow.operators.clean import drop_outliers
from martflow.operators.picks import nth_per_group

MEASURES = ("length", "width")


def with_key_parts(products: DataFrame) -> DataFrame:
    """``product_number`` is ``<store>_<product>``; a missing part is NULL."""
    return products.withColumns(
        {
            "storeid": part_at("product_number", "_", 0),
            "productid": part_at("product_number", "_", 1),
        }
    )


def with_year(products: DataFrame, empty_as_null: bool = False) -> DataFrame:
    return products.withColumn("year", four_digit_year("product_name", empty_as_null))


def with_size(products: DataFrame) -> DataFrame:
    return products.withColumn("product_size", size_class("length"))


def cleaned_products(
    products: DataFrame, columns: Sequence[str] = MEASURES, k: float = 3
) -> DataFrame:
    """Products without outliers, with key parts, year and size class."""
    return with_size(with_year(with_key_parts(drop_outliers(products, columns, k))))


def size_pivot(cleaned: DataFrame) -> DataFrame:
    """Products per category and size class, one column per class; none is NULL."""
    return cleaned.groupBy("product_category").pivot("product_size", list(SIZE_LABELS)).count()


def nth_longest(cleaned: DataFrame, n: int = 2) -> DataFrame:
    """The n-th longest product per category; equal lengths go by product number and name."""
    order = [F.desc("length"), F.asc("product_number"), F.asc("product_name")]
    return nth_per_group(cleaned, ["product_category"], order, n).select(
        "product_category", "product_name", "length"
    )
