"""What is loaded, known by sets of keys: late keys are found, whatever the greatest key is.

Keys fall into ranges of a fixed width. The ledger holds, for each range, how many keys are stored and
the exclusive or of two hashes of each. A source whose range has the same numbers has nothing new
there; only keys of the other ranges are compared one by one with the stored table. The ledger may
lag behind the table (a job died in between): its ranges then differ, and the comparison decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from martflow.operators.versions import latest_folder
from martflow.session import materialize

WIDTH = 1_000_000  # keys in a range
BUCKETS = 4_096  # ranges of keys that are no whole numbers
SCHEMA = "span bigint, keys bigint, a bigint, b bigint"
ISLANDS = 64  # runs of neighbouring ranges that a scan is cut down to by their bounds


def span_of(df: DataFrame, key: str, width: int = WIDTH) -> Column:
    """The range of a key: whole numbers by size, others by hash."""
    k = F.col(f"`{key}`")
    if isinstance(df.schema[key].dataType, IntegralType):
        return F.floor(k.cast("decimal(20,0)") / F.lit(width)).cast("bigint")
    return F.pmod(F.xxhash64(k), F.lit(BUCKETS))


def spans(df: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """One row for each range that ``df`` has keys in. NULL keys are no keys."""
    k = F.col(f"`{key}`")
    return (
        df.filter(k.isNotNull())
        .groupBy(span_of(df, key, width).alias("span"))
        .agg(
            F.count("*").alias("keys"),
            F.bit_xor(F.xxhash64(F.lit(1), k)).alias("a"),
            F.bit_xor(F.xxhash64(F.lit(2), k)).alias("b"),
        )
    )


class Ledger:
    """Key ranges of one stored table, as numbered folders below ``path``; the highest number counts.

    One row for each range that has keys: keys / width rows, written as one file so that a ledger is there as a
    whole or not at all.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, width: int = WIDTH):
        self.spark, self.path, self.key, self.width = spark, path.rstrip("/"), key, width

    def load(self) -> DataFrame:
        number = latest_folder(self.spark, self.path, SCHEMA)
        if number is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/version={number}")

    def open_spans(self, source: DataFrame) -> DataFrame:
        """Ranges (stored) in which ``source`` may have keys that the table does not."""
        found, known = spans(source, self.key, self.width), self.load()
        same = ["span", "keys", "a", "b"]
        return materialize(found.join(known, same, "left_anti").select("span"), "spans")

    def record(self, stored: DataFrame, opened: DataFrame) -> None:
        """Note what the table holds now in the ranges that were open."""
        within = in_spans(stored, self.key, opened, self.width)
        now = self.load().join(opened, "span", "left_anti").unionByName(spans(within, self.key, self.width))
        now = materialize(now, "ledger")
        number = latest_folder(self.spark, self.path, SCHEMA)
        folder = f"{self.path}/version={0 if number is None else number + 1}"
        now.coalesce(1).write.mode("overwrite").parquet(folder)


def in_spans(df: DataFrame, key: str, opened: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of ``df`` whose key lies in one of the ranges.

    Few runs of neighbouring ranges become bounds on the key, which reach the scan; the join sees to the rest.
    """
    if isinstance(df.schema[key].dataType, IntegralType):
        bounds = islands(opened)
        if bounds is not None:
            k, test = F.col(f"`{key}`"), F.lit(False)
            for low, high in bounds:
                test = test | k.between(F.lit(low * width), F.lit((high + 1) * width - 1))
            df = df.filter(test)
    name = "_span"
    return df.withColumn(name, span_of(df, key, width)).join(
        opened.withColumnRenamed("span", name), name, "left_semi"
    ).drop(name)


def islands(opened: DataFrame) -> list[tuple[int, int]] | None:
    """First and last range of each run of neighbouring ranges; None if there are more than ``ISLANDS``."""
    starts = opened.join(opened.select((F.col("span") + 1).alias("span")), "span", "left_anti")
    ends = opened.join(opened.select((F.col("span") - 1).alias("span")), "span", "left_anti")
    first = sorted(r[0] for r in starts.limit(ISLANDS + 1).collect())
    if len(first) > ISLANDS:
        return None
    return list(zip(first, sorted(r[0] for r in ends.collect())))


def not_loaded(source: DataFrame, stored: DataFrame, key: str, opened: DataFrame | None = None, width: int = WIDTH) -> DataFrame:
    """Rows of ``source`` whose key the stored table does not have. Rows without a key are left out.

    ``opened``: the ranges that are looked at, on both sides (all by default).
    """
    if opened is not None:
        source, stored = (in_spans(d, key, opened, width) for d in (source, stored))
    known = stored.select(F.col(f"`{key}`").alias("_stored_key"))
    return source.filter(F.col(f"`{key}`").isNotNull()).join(
        known, F.col(f"`{key}`") == F.col("_stored_key"), "left_anti"
    )
