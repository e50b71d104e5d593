"""Sales reports over the star schema. Every result is small; facts never leave Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.rules import money

# The measures that sales are compared with.
DRIVERS = ("fuel_price", "cpi", "unemployment")


def _total():
    return F.sum(money("weekly_sales")).alias("total_sales")


def sales_over_time(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_id").agg(_total()).orderBy("date_id")


def sales_by_month(fact: DataFrame) -> DataFrame:
    by = (F.year("date_id").alias("year"), F.month("date_id").alias("month"))
    return fact.groupBy(*by).agg(_total()).orderBy("year", "month")


def holiday_sales(fact: DataFrame, holiday_dimension: DataFrame) -> DataFrame:
    """Totals per holiday flag. Facts are summed first; the dimension joins two rows."""
    totals = fact.groupBy("holiday_id").agg(_total())
    return totals.join(holiday_dimension.select("holiday_id"), "holiday_id")


def sales_with_drivers(
    fact: DataFrame, features_dimension: DataFrame, drivers: Sequence[str] = DRIVERS
) -> DataFrame:
    """Fact rows with the measures of their features row, lazily."""
    return fact.join(features_dimension.select("feature_id", *drivers), "feature_id")


def driver_correlations(joined: DataFrame, drivers: Sequence[str] = DRIVERS) -> DataFrame:
    """``(driver, pairs, correlation, slope)`` of weekly sales against each measure."""
    sales = F.col("weekly_sales").cast("double")
    row = joined.agg(
        *[
            F.struct(
                F.lit(d).alias("driver"),
                F.regr_count(sales, F.col(d)).alias("pairs"),
                _correlation(F.col(d).cast("double"), sales).alias("correlation"),
                F.regr_slope(sales, F.col(d)).alias("slope"),
            ).alias(d)
            for d in drivers
        ]
    )
    return row.select(F.inline(F.array(*drivers)))


def _correlation(x: Column, y: Column) -> Column:
    """Correlation of the complete pairs; NULL where one side does not vary."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def driver_bins(joined: DataFrame, driver: str, width: float) -> DataFrame:
    """Rows, mean and total of weekly sales per interval of a measure."""
    position = F.floor(F.col(driver) / F.lit(float(width)))
    return joined.groupBy(position.alias("bin")).agg(
        F.count("*").alias("sales_rows"),
        F.avg(money("weekly_sales")).alias("mean_sales"),
        F.sum(money("weekly_sales")).alias("total_sales"),
    )
