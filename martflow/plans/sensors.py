"""Sensor readings from text lines ``sensor_id,date,temperature``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.schemas import READINGS
from martflow.sources.files import accepted, parse_delimited

# Fixed value: readings above this temperature count as hot.
HOT_ABOVE = 50


def readings(lines: DataFrame, line: str = "value") -> DataFrame:
    """Typed readings; lines without exactly three fields or with a bad number are left out."""
    return accepted(parse_delimited(lines, READINGS, line))


def highest_reading(values: DataFrame) -> DataFrame:
    return values.agg(F.max("temperature").alias("max_temperature"))


def hot_counts(values: DataFrame, above: float = HOT_ABOVE) -> DataFrame:
    """Readings above the limit per sensor, most first."""
    counts = (
        values.filter(F.col("temperature") > above)
        .groupBy("sensor_id")
        .agg(F.count("*").alias("readings"))
    )
    return counts.orderBy(F.desc("readings"), F.asc("sensor_id"))
